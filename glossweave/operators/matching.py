"""Joins beyond equality: containment, dictionary replacement, near strings, nearest vectors, shifts, overlaps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import udfs


def containing(df: DataFrame, doc: str, text: str, needles: DataFrame, needle_id: str, needle: str, gram: int = 4) -> DataFrame:
    """(doc, needle_id) where text contains needle; empty needles and null texts have no rows, and equal docs or needles give one.

    A needle's longest inner word stands between blanks wherever the needle occurs, so both sides meet on it; of a needle of fewer than three
    words its first characters, `gram` at most, must be among the text's runs of that many. Only (doc, key) travels to meet the needles; the
    texts join the pairs that met once, by doc, and the exact test follows.
    """
    need = needles.where(F.length(needle) > 0).select(needle_id, F.col(needle).alias("_n"))
    parts = F.split("_n", " ")
    inner = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda w: w != "")
    need = need.withColumn("_w", F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("l"), w.alias("w"))))["w"])
    hay = df.where(F.col(text).isNotNull()).select(doc, F.col(text).alias("_t"))
    keys = hay.select(doc, F.explode(F.array_distinct(F.split("_t", " "))).alias("_w"))
    met = keys.join(need.where("_w is not null").select("_w", needle_id), "_w").select(doc, needle_id)
    short = need.where("_w is null").select(needle_id, F.substring("_n", 1, gram).alias("_g"))
    for size in range(1, gram + 1):
        width = F.lit(size)
        runs = F.when(F.length("_t") >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_t") - size + 1), lambda i: F.substring(F.col("_t"), i, width))))
        met = met.unionByName(hay.select(doc, F.explode(runs).alias("_g")).join(short.where(F.length("_g") == size), "_g").select(doc, needle_id))
    return met.distinct().join(need.select(needle_id, "_n"), needle_id).join(hay, doc).where(F.contains("_t", "_n")).select(doc, needle_id).distinct()


def replace_words(c: Column, words: dict[str, str]) -> Column:
    """Whole blank-separated words replaced through a constant map, in one pass."""
    table = F.create_map(*(F.lit(x) for kv in sorted(words.items()) for x in kv))
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def replace_phrases(c: Column, phrases: dict[str, str]) -> Column:
    """Whole words and phrases replaced through a constant map, the longest first, in one pass: the text is cut into known phrases, other words, and what
    stands between, and put together again."""
    known = "|".join(re.escape(p) for p in sorted(phrases, key=lambda p: (-len(p), p)))
    table = F.create_map(*(F.lit(x) for kv in sorted(phrases.items()) for x in kv))
    pieces = F.regexp_extract_all(c, F.lit(f"(?U)(?:{known})(?!\\w)|\\w+|\\W"), F.lit(0))
    return F.when(c.isNotNull(), F.array_join(F.transform(pieces, lambda w: F.coalesce(F.try_element_at(table, w), w)), ""))


def sliding_hamming(text: Column, piece: str) -> Column:
    """Least number of differing characters of piece against any place in text; null if text is shorter."""
    n = len(piece)
    letters = F.array(*(F.lit(ch) for ch in piece))
    at = lambda i: F.size(F.filter(F.zip_with(F.split(F.substring(text, i, F.lit(n)), ""), letters, lambda a, b: a != b), lambda x: x))
    return F.when(F.length(text) >= n, F.array_min(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), at)))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, centre): unit-length mean vector by label, dimension by dimension, so that a large group is a partial aggregate."""
    parts = df.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg("x").alias("m"))
    whole = parts.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    norm = F.sqrt(F.aggregate("c", F.lit(0.0), lambda a, x: a + x * x))
    return whole.select(label, F.transform("c", lambda x: x / norm).alias("centre"))


CENTRES = 4096


def nearest(df: DataFrame, key: str, vector: str, centres: DataFrame, label: str, block: int = CENTRES) -> DataFrame:
    """(key, label, similarity): the centre with the largest dot product, ties to the smaller label; one row for each row of df, whose keys tell rows apart.

    The centres are counted first. Up to `block` of them come along as one row, so nothing is shuffled; more are taken in blocks of so many, and each
    key's best over the blocks is a partial aggregate.
    """
    dot = lambda c: F.aggregate(F.zip_with(F.col(vector), c["centre"], lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, x: a + x)
    blocks = max(1, -(-centres.count() // block))
    all_ = centres.groupBy(F.pmod(F.xxhash64(label), F.lit(blocks)).alias("_b")).agg(F.collect_list(F.struct(label, "centre")).alias("_all")).drop("_b")
    best = F.array_min(F.transform("_all", lambda c: F.struct((-F.round(dot(c), 9)).alias("s"), c[label].alias("l"))))
    named = df.select(key, vector).crossJoin(F.broadcast(all_) if blocks == 1 else all_).select(key, best.alias("b"))
    if blocks > 1:
        named = named.groupBy(key).agg(F.min("b").alias("b"))
    return named.select(key, F.col("b.l").alias(label), (-F.col("b.s")).alias("similarity"))


def similar_sets(df: DataFrame, key: str, items: str, least: int) -> DataFrame:
    """(a, b, na, nb, both): pairs of sets with `least` common items or more.

    Such pairs share one of their rarest |set| - least + 1 items, so only those meet: an item that most sets have joins nothing.
    """
    sets = df.where(F.size(items) >= least).select(key, F.col(items).alias("s"))
    freq = sets.select(F.explode("s").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    ranked = sets.select(key, F.explode("s").alias("w")).join(freq, "w").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("r"))
    ranked = ranked.select(key, F.transform("r", lambda x: x["w"]).alias("s"))
    heads = ranked.select(key, F.explode(F.slice("s", F.lit(1), F.size("s") - least + 1)).alias("w"))
    met = heads.select(F.col(key).alias("a"), "w").join(heads.select(F.col(key).alias("b"), "w"), "w").where("a < b").select("a", "b").distinct()
    out = met.join(ranked.select(F.col(key).alias("a"), F.col("s").alias("x")), "a").join(ranked.select(F.col(key).alias("b"), F.col("s").alias("y")), "b")
    return out.select("a", "b", F.size("x").alias("na"), F.size("y").alias("nb"), F.size(F.array_intersect("x", "y")).alias("both")).where(F.col("both") >= least)


def best_shift(left: DataFrame, right: DataFrame, part: str, pos: str, value: str, shifts: range, least: int = 1) -> DataFrame:
    """(part, shift, matches): the shift of left's positions that makes most values agree with right's; ties to the smaller shift."""
    l_, r_ = left.select(part, F.col(pos).alias("p"), F.col(value).alias("v")), right.select(part, F.col(pos).alias("p"), F.col(value).alias("v"))
    moved = l_.withColumn("shift", F.explode(F.sequence(F.lit(shifts[0]), F.lit(shifts[-1])))).withColumn("p", F.col("p") + F.col("shift"))
    hits = moved.join(r_, [part, "p", "v"]).groupBy(part, "shift").agg(F.count("*").alias("matches"))
    return hits.groupBy(part).agg(F.min(F.struct((-F.col("matches")).alias("m"), "shift")).alias("b")).select(part, F.col("b.shift").alias("shift"), (-F.col("b.m")).alias("matches")).where(F.col("matches") >= least)


def overlaps(left: DataFrame, right: DataFrame, part: str, lo: str, hi: str, width: int) -> DataFrame:
    """Pairs of ranges of one part that meet: both sides are cut at multiples of width and meet on (part, cell), each pair once."""
    def cells(df: DataFrame, tag: str) -> DataFrame:
        out = df.select(part, F.col(lo).alias(f"{tag}_lo"), F.col(hi).alias(f"{tag}_hi"))
        return out.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(f"{tag}_lo") / width), F.floor(F.col(f"{tag}_hi") / width))))

    both = cells(left, "a").join(cells(right, "b"), [part, "_cell"])
    first = F.col("_cell") == F.floor(F.greatest("a_lo", "b_lo") / width)
    return both.where(first & (F.col("a_lo") <= F.col("b_hi")) & (F.col("b_lo") <= F.col("a_hi"))).drop("_cell")


def letters(c: Column) -> Column:
    """The characters of a short string, equal ones told apart by number, so that what two strings have in common is a set."""
    cs = F.split(c, "")
    return F.transform(cs, lambda x, i: F.concat(x, F.size(F.filter(F.slice(cs, F.lit(1), i + 1), lambda y: y == x)).cast("string")))


def near_strings(df: DataFrame, key: str, text: str, least: float = 0.85) -> DataFrame:
    """(a, b, x, y), a < b: the pairs of short strings whose ratio of matching blocks may be least: all that reach it are among them.

    The ratio is at most twice the common characters over both lengths, so of two such strings each has least / (2 - least) of its characters
    in common with the other, and they share one of their rarest rest of characters, by which they meet.
    """
    share = least / (2 - least)
    named = df.select(key, F.col(text).alias("_t"), letters(F.col(text)).alias("_c")).where(F.length("_t") > 0)
    often = named.select(F.explode("_c").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    order = named.select(key, F.explode("_c").alias("w")).join(often, "w").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("_r"))
    take = F.size("_r") - F.ceil(F.lit(share) * F.size("_r") - 1e-9).cast("int") + 1
    heads = named.select(key, "_t").join(order, key).select(key, "_t", F.explode(F.slice("_r", F.lit(1), take)).alias("_h")).select(key, "_t", "_h.w")
    a, b = heads.select(F.col(key).alias("a"), F.col("_t").alias("x"), "w"), heads.select(F.col(key).alias("b"), F.col("_t").alias("y"), "w")
    close = 2 * F.least(F.length("x"), F.length("y")) >= least * (F.length("x") + F.length("y")) - 1e-9
    met = a.join(b, "w").where((F.col("a") < F.col("b")) & close).select("a", "b", "x", "y").distinct()
    both = F.size(F.array_intersect(letters(F.col("x")), letters(F.col("y"))))
    return met.where(2 * both >= least * (F.length("x") + F.length("y")) - 1e-9)


def agreeing(df: DataFrame, key: str, text: str, least: float = 0.85, start: int = 5) -> DataFrame:
    """(a, b), a < b: texts that may name the same phrase: equal but for case, outer marks and stars; of as many words and with a ratio of matching blocks of
    least; or the one the first words of the other, and of start characters."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"^[ .:]+|[ .:]+$", ""), r"^[*+]+", "")
    words = F.transform(F.split(F.trim("_t"), r"\s+"), lambda w: F.regexp_replace(w, "^[.,;:]+|[.,;:]+$", ""))
    named = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), plain.alias("_t")).withColumn("_w", F.when(F.trim("_t") == "", F.array().cast("array<string>")).otherwise(words))
    one, two = (named.select(F.col("k").alias(k), F.col("_t").alias(t), F.col("_w").alias(w)) for k, t, w in (("a", "x", "v"), ("b", "y", "z")))
    same = one.join(two, F.col("x") == F.col("y")).where("a < b").select("a", "b")
    near = near_strings(named.where(F.size("_w") > 0), "k", "_t", least).join(one.select("a", "v"), "a").join(two.select("b", "z"), "b").where(F.size("v") == F.size("z"))
    near = near.where(udfs.sequence_ratio()("x", "y") >= least).select("a", "b")
    heads = named.select("k", F.size("_w").alias("n"), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - 1, F.lit(1))), lambda i: F.array_join(F.slice("_w", F.lit(1), i), " "))).alias("h"), "_w")
    heads = heads.where((F.size("_w") > 1) & (F.length("h") >= start)).select(F.col("k").alias("l"), "h")
    short = named.where(F.size("_w") > 0).select(F.col("k").alias("s"), F.array_join("_w", " ").alias("h"))
    first = heads.join(short, "h").where("l <> s").select(F.least("l", "s").alias("a"), F.greatest("l", "s").alias("b"))
    return same.union(near).union(first).distinct()


def flat_tokens(c: Column) -> Column:
    return F.array_distinct(T.tokens(F.lower(c), "[a-z0-9]{2,}"))
