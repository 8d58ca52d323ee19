"""What people look at: faults by position, shifts between two readings, sheets of rare words with their contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lexicon


def faults(df: DataFrame, keys: list[str], truth: str, read: str) -> DataFrame:
    """(keys…, position, expected, found) for each position, from 0, at which two strings differ; the shorter is padded with blanks, nulls are empty."""
    t, r = F.coalesce(F.col(truth), F.lit("")), F.coalesce(F.col(read), F.lit(""))
    width = F.greatest(F.length(t), F.length(r))
    each = df.where(width > 0).select(*keys, F.split(F.rpad(t, F.greatest(width, F.lit(1)), " "), "").alias("_t"), F.split(F.rpad(r, F.greatest(width, F.lit(1)), " "), "").alias("_r"))
    both = each.select(*keys, F.posexplode(F.arrays_zip("_t", "_r")).alias("position", "_z"))
    return both.where(F.col("_z._t") != F.col("_z._r")).select(*keys, "position", F.col("_z._t").alias("expected"), F.col("_z._r").alias("found"))


def accuracy(df: DataFrame, keys: list[str], truth: str, read: str) -> DataFrame:
    """(keys…, good, total): positions that agree, of all up to the longer string's end; no row is exploded."""
    t, r = F.coalesce(F.col(truth), F.lit("")), F.coalesce(F.col(read), F.lit(""))
    width = F.greatest(F.length(t), F.length(r))
    wide = F.greatest(width, F.lit(1))
    same = F.size(F.filter(F.zip_with(F.split(F.rpad(t, wide, " "), ""), F.split(F.rpad(r, wide, " "), ""), lambda a, b: a == b), lambda x: x))
    return df.groupBy(*keys).agg(F.sum(F.when(width > 0, same).otherwise(0)).cast("long").alias("good"), F.sum(width).cast("long").alias("total"))


def similarity(a: Column, b: Column) -> Column:
    """1 less the edits between two strings over the longer one's length; 1 for two empty ones."""
    return F.when((F.length(a) == 0) & (F.length(b) == 0), 1.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def shift_by_similarity(old: DataFrame, new: DataFrame, part: str, line: str, text: str, shifts: range, least: int = 8) -> DataFrame:
    """(part, shift, mean, n): the shift of line numbers from old to new under which the lines that have a partner are most alike in the mean, of the shifts with
    least partners; ties go to the smaller. Blank lines of old have none. A line meets as many lines as there are shifts, by equality of (part, line)."""
    a = old.where(F.trim(F.col(text)) != "").select(part, F.col(line).alias("_k"), F.col(text).alias("_a"), F.explode(F.array(*(F.lit(d) for d in shifts))).alias("shift"))
    b = new.where(F.col(text).isNotNull()).select(F.col(part).alias("_p"), F.col(line).alias("_l"), F.col(text).alias("_b"))
    met = a.join(b, F.col(part).eqNullSafe(F.col("_p")) & (F.col("_k") + F.col("shift") == F.col("_l")))
    scored = met.groupBy(part, "shift").agg(F.avg(F.round(similarity(F.col("_a"), F.col("_b")), 9)).alias("mean"), F.count("*").alias("n")).where(F.col("n") >= least)
    best = scored.groupBy(part).agg(F.min(F.struct((-F.round("mean", 9)).alias("m"), "shift", "n")).alias("b"))
    return best.select(part, "b.shift", (-F.col("b.m")).alias("mean"), "b.n")


def variants(token: Column, pairs: tuple = lexicon.CONFUSABLE) -> Column:
    """All strings one confusable character away, without repeats."""
    swap: dict[str, str] = {}
    for a, b in pairs:
        swap[a] = swap.get(a, "") + b
        swap[b] = swap.get(b, "") + a
    table = F.create_map(*(F.lit(x) for kv in sorted(swap.items()) for x in kv))
    subs = lambda i: F.split(F.coalesce(F.try_element_at(table, F.substring(token, i, F.lit(1))), F.lit("")), "")
    put = lambda i: F.transform(F.filter(subs(i), lambda s: s != ""), lambda s: F.concat(F.substring(token, F.lit(1), i - 1), s, F.substring(token, i + 1, F.length(token))))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(token)), put)))


def rare_words(contexts: DataFrame, freq: DataFrame, words: DataFrame, word: str = "word", rare: int = 2, shown: int = 4) -> DataFrame:
    """(token, n, neighbours, sheet, place, context): rare tokens that the lexicon doesn't attest, each on the sheet it belongs to.

    contexts has token and context (see lexicon.first_context), freq token and n. Sheet `neighbour` has tokens one confusable character away from attested
    forms, shown of them by name; sheet `sense` the others, but for those beside a scientific name (L. and a word) and those that begin with a
    capital. Sheets go by number, then token; place counts from one within (sheet, first letter), which bounds what one window sorts.
    """
    low = freq.where(F.col("n") <= rare).select("token", "n")
    odd = lexicon.unknown(low, words, "token", word)
    known = lexicon.sized(words.select(F.col(word).alias("_s")).where("_s is not null").distinct().withColumn("_known", F.lit(True)), "_s")
    tried = odd.select("token", F.explode(variants(F.col("token"))).alias("variant")).select("token", "variant", F.explode(lexicon.stems(F.col("variant"))).alias("_s"))
    near = tried.join(known, "_s").groupBy("token").agg(F.slice(F.array_sort(F.collect_set("variant")), 1, shown).alias("neighbours"))
    met = odd.join(near, "token", "left").join(contexts.select("token", "context"), "token")
    sheet = F.when(F.col("neighbours").isNotNull(), "neighbour").when(F.col("context").rlike(r"\bL[.]\s*[A-Za-z]") | F.col("token").rlike("^[A-Z]"), None).otherwise("sense")
    place = F.row_number().over(Window.partitionBy("sheet", F.substring("token", 1, 1)).orderBy("n", "token"))
    return met.withColumn("sheet", sheet).where("sheet is not null").withColumn("place", place.cast("long")).select("token", "n", "neighbours", "sheet", "place", "context")
