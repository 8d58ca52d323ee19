"""Lines joined to texts, words that a line's end broke put together again, by what the corpus itself writes inside its lines.

A hyphen at a break stays if the corpus writes the pair with it inside a line; it goes if the joined word is attested; it stays if both halves are and
the whole isn't; else it goes. A word is attested if it, or what is left of it without an ending, stands somewhere inside a line. Only the words that breaks ask
for are looked up: a bitmap of their hashes, of a fixed size, sorts out nearly all other words of the corpus before any shuffle, and a join by equality
decides about the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexicon import stems
from .tables import keep

LETTERS = "A-Za-zÀ-ÿ’'"
# Endings that a word may lose.
ENDINGS = ("ar", "ir", "or", "as", "is", "os", "us", "o", "a", "e", "i")
#: The bitmap's size, as a power of two.
BITS = 20


def breaks(lines: Column) -> Column:
    """array<struct<at, left, right>> of the breaks: the number of the line behind, and the halves in lower case; at counts from one."""
    def one(i: Column) -> Column:
        a, b = F.trim(F.element_at(lines, i)), F.trim(F.element_at(lines, i + 1))
        left, right = F.regexp_extract(a, f"([{LETTERS}-]*[A-Za-zÀ-ÿ])-$", 1), F.regexp_extract(b, f"^[a-zà-ÿ][{LETTERS}]*", 0)
        return F.struct((i + 1).alias("at"), F.lower(left).alias("left"), F.lower(right).alias("right"))

    every = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1))), lambda i: F.when(i < F.size(lines), one(i)))
    return F.filter(every, lambda b: b.isNotNull() & (b["left"] != "") & (b["right"] != ""))


def inner_words(lines: Column) -> Column:
    """The words inside lines, in lower case, with their hyphens: those that no break cuts."""
    def of(s: Column) -> Column:
        whole = F.regexp_replace(F.trim(s), f"[{LETTERS}-]+-$", " ")
        return F.regexp_extract_all(F.lower(whole), F.lit(f"[{LETTERS}]+(?:-[{LETTERS}]+)*"), F.lit(0))

    return F.array_distinct(F.flatten(F.transform(lines, of)))


def bitmap(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """One row: longs whose bits are set for the hashes of the keys."""
    slot = F.pmod(F.xxhash64("key"), F.lit(1 << bits))
    words = keys.select(F.shiftright(slot, 6).alias("w"), slot.bitwiseAND(63).cast("int").alias("b")).groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v"))
    held = words.agg(F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))  # 2^bits / 64 entries at most
    return held.select(F.transform(F.sequence(F.lit(0), F.lit((1 << bits) // 64 - 1)), lambda i: F.coalesce(F.try_element_at("m", i.cast("long")), F.lit(0).cast("long"))).alias("_map"))


def passes(key: Column, longs: Column, bits: int = BITS) -> Column:
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    return F.call_function("getbit", F.element_at(longs, (F.shiftright(slot, 6) + 1).cast("int")), slot.bitwiseAND(63).cast("int")) == 1


def reglue(df: DataFrame, key: str, lines: str, name: str = "text", bits: int = BITS) -> DataFrame:
    """df with its lines (an array of strings) as one text: blanks between lines, broken words joined. The lexicon is that of all lines of df. A null array
    gives null, an empty one an empty text; empty lines add nothing. key must tell rows apart."""
    found = keep(df.select(F.col(key).alias("_k"), F.explode(breaks(F.col(lines))).alias("b")).select("_k", "b.*"), "breaks")
    pairs = found.select("left", "right").distinct()
    whole, both = F.concat("left", "right"), F.concat_ws("-", "left", "right")
    asked = lambda kind, c: pairs.select("left", "right", F.lit(kind).alias("kind"), F.explode(stems(c, ENDINGS)).alias("key"))
    asks = asked("whole", whole).unionByName(asked("left", F.col("left"))).unionByName(asked("right", F.col("right"))).unionByName(pairs.select("left", "right", F.lit("both").alias("kind"), both.alias("key")))
    keys = keep(asks, "asked")
    words = df.select(F.explode(inner_words(F.col(lines))).alias("key"))
    near = words.crossJoin(F.broadcast(keep(bitmap(keys.select("key").distinct(), bits), "bitmap"))).where(passes(F.col("key"), F.col("_map"), bits)).select("key").distinct()
    told = keys.join(near.withColumn("_known", F.lit(True)), "key", "left").groupBy("left", "right").agg(*(F.bool_or((F.col("kind") == k) & F.coalesce("_known", F.lit(False))).alias(f"_{k}") for k in ("whole", "left", "right", "both")))
    judged = told.select("left", "right", (F.col("_both") | (~F.col("_whole") & F.col("_left") & F.col("_right"))).alias("keep"))
    kept = found.join(judged, ["left", "right"]).groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("at", "keep"))).alias("_keep"))
    met = df.join(kept, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn("_keep", F.coalesce("_keep", F.array().cast("array<struct<at: int, keep: boolean>>")))

    def stretch(j: Column) -> Column:
        """The lines from one break to the next, without the next one's hyphen if it goes."""
        at = F.when(j == 0, 1).otherwise(F.try_element_at("_keep", F.greatest(j, F.lit(1)))["at"])
        after = F.try_element_at("_keep", j + 1)
        own = F.slice(F.col(lines), at, F.coalesce(after["at"], F.size(lines) + 1) - at)
        body = F.array_join(F.filter(F.transform(own, lambda s: F.trim(s)), lambda s: s != ""), " ")
        return F.when(after.isNotNull() & ~after["keep"], F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)

    text = F.array_join(F.transform(F.sequence(F.lit(0), F.size("_keep")), stretch), "")
    return met.withColumn(name, F.when(F.col(lines).isNotNull(), text)).drop("_k", "_keep")
