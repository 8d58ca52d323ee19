"""Ordered rows: segments, islands, order breaks, frames, votes.

Running sums and lags over a key that may hold much of the table go in chunks of the order column: windows run within (key, chunk), and a
table of one row a chunk carries sums or last rows on. So a hot key is split over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CHUNK = 65_536


def chunked(df: DataFrame, order: str, size: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(order) / size))


def carried_on(d: DataFrame, part: list[str], local: str, carry, order: list[str]) -> DataFrame:
    """d, whose column local holds a running value within (part, _chunk), with _before: carry() of the last values of all chunks before. The last rows are
    taken from the windowed rows themselves, so both sides read one shuffle; they are one row a chunk."""
    here = Window.partitionBy(*part, "_chunk").orderBy(*order)
    ends = d.withColumn("_next", F.lead(F.lit(1)).over(here)).where("_next is null")
    before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*(F.col(p).alias(f"_p{i}") for i, p in enumerate(part)), F.col("_chunk").alias("_c"), carry(local).over(before).alias("_before"))
    on = F.col("_chunk").eqNullSafe(F.col("_c"))
    for i, p in enumerate(part):
        on = on & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return d.join(carried, on).drop("_c", *(f"_p{i}" for i in range(len(part))))


def running_sum(df: DataFrame, part: str, order: str, value: Column, name: str, size: int = CHUNK) -> DataFrame:
    """Sum of value over a key's rows up to each row, by a numeric order column without ties."""
    d = chunked(df.withColumn("_v", value), order, size)
    local = Window.partitionBy(part, "_chunk").orderBy(order)
    d = d.withColumn("_local", F.sum("_v").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    met = carried_on(d, [part], "_local", F.sum, [order])
    return met.withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_v", "_chunk", "_local", "_before")


def previous(df: DataFrame, part: str, order: str, columns: list[str], size: int = CHUNK) -> DataFrame:
    """Adds _prev, a struct of the columns of the key's row before (null for the first), by a numeric order column without ties."""
    d = chunked(df, order, size)
    row = F.struct(*columns)
    local = Window.partitionBy(part, "_chunk").orderBy(order)
    last = d.groupBy(part, "_chunk").agg(F.max_by(row, F.col(order)).alias("_row"))
    carried = last.select(F.col(part).alias("_p"), F.col("_chunk").alias("_c"), F.lag("_row").over(Window.partitionBy(part).orderBy("_chunk")).alias("_before"))
    met = d.withColumn("_local", F.lag(row).over(local)).join(carried, F.col(part).eqNullSafe(F.col("_p")) & F.col("_chunk").eqNullSafe(F.col("_c")))
    return met.withColumn("_prev", F.coalesce("_local", "_before")).drop("_chunk", "_local", "_p", "_c", "_before")


def running_last(df: DataFrame, part: str, order: str, value: Column, name: str, size: int = CHUNK) -> DataFrame:
    """The last value that isn't null over a key's rows up to each row, by a numeric order column without ties."""
    d = chunked(df.withColumn("_v", value), order, size)
    local = Window.partitionBy(part, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ends = d.groupBy(part, "_chunk").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_e"))
    before = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col(part).alias("_p"), F.col("_chunk").alias("_c"), F.last("_e", ignorenulls=True).over(before).alias("_before"))
    met = d.withColumn("_local", F.last("_v", ignorenulls=True).over(local)).join(carried, F.col(part).eqNullSafe(F.col("_p")) & F.col("_chunk").eqNullSafe(F.col("_c")))
    return met.withColumn(name, F.coalesce("_local", "_before")).drop("_v", "_chunk", "_local", "_p", "_c", "_before")


def neighbours(df: DataFrame, part: str, order: str, columns: list[str], before: int, after: int, size: int = CHUNK) -> DataFrame:
    """Adds _before and _after: arrays of the columns (as structs) of up to that many rows of the key before and after each row, nearest first.

    By a numeric order column without ties. A chunk's edge rows look on into what a table of one row a chunk carries: every chunk has a row, so as
    many chunks as neighbours are enough.
    """
    row = F.struct(F.col(order).alias("_o"), *columns)
    d = chunked(df, order, size).withColumn("_row", row)
    here = Window.partitionBy(part, "_chunk").orderBy(order)
    back, ahead = here.rowsBetween(-max(before, 1), -1), here.rowsBetween(1, max(after, 1))
    d = d.withColumn("_b", F.reverse(F.collect_list("_row").over(back))).withColumn("_a", F.collect_list("_row").over(ahead))
    edge = d.withColumn("_first", F.size("_b") < before).withColumn("_last", F.size("_a") < after)
    ends = edge.groupBy(part, "_chunk").agg(F.array_sort(F.collect_list(F.when(F.col("_last") | (F.size("_a") < before), F.col("_row")))).alias("_t"), F.array_sort(F.collect_list(F.when(F.col("_first") | (F.size("_b") < after), F.col("_row")))).alias("_h"))
    over = Window.partitionBy(part).orderBy("_chunk")
    tails = F.slice(F.reverse(F.flatten(F.collect_list("_t").over(over.rowsBetween(-max(before, 1), -1)))), 1, before)
    heads = F.slice(F.flatten(F.collect_list("_h").over(over.rowsBetween(1, max(after, 1)))), 1, after)
    carried = ends.select(F.col(part).alias("_p"), F.col("_chunk").alias("_c"), tails.alias("_tails"), heads.alias("_heads"))
    met = d.join(carried, F.col(part).eqNullSafe(F.col("_p")) & F.col("_chunk").eqNullSafe(F.col("_c")))
    out = met.withColumn("_before", F.slice(F.concat("_b", "_tails"), 1, before) if before else F.slice("_b", 1, 0))
    out = out.withColumn("_after", F.slice(F.concat("_a", "_heads"), 1, after) if after else F.slice("_a", 1, 0))
    return out.drop("_row", "_b", "_a", "_chunk", "_p", "_c", "_tails", "_heads")


def segment(df: DataFrame, part: str, order: str, start: Column, name: str = "segment") -> DataFrame:
    """Number of the record each row belongs to: a running count of starts; 0 before the first."""
    return running_sum(df, part, order, F.when(start, 1).otherwise(0), name)


def coalesce_ranges(df: DataFrame, part: list[str], lo: str, hi: str, gap: int = 0, size: int = CHUNK) -> DataFrame:
    """Ranges that overlap or leave at most gap between them, as one: (part…, lo, hi, n). lo is a number; a key's rows are taken in chunks of it, and the
    farthest end and the last beginning of an island are carried on."""

    def running_max(d: DataFrame, value: Column, name: str) -> DataFrame:
        local = Window.partitionBy(*part, "_chunk").orderBy(lo, hi).rowsBetween(Window.unboundedPreceding, 0)
        met = carried_on(d.withColumn("_local", F.max(value).over(local)), part, "_local", F.max, [lo, hi])
        return met.withColumn(name, F.greatest("_local", "_before")).drop("_local", "_before")

    # An island's beginning is where no range before reaches; the farthest end before a row is that of the row before, in its chunk or carried from others.
    d = chunked(df.select(*part, lo, hi), lo, size)
    here = Window.partitionBy(*part, "_chunk").orderBy(lo, hi)
    d = d.withColumn("_local", F.max(hi).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_own", F.max(hi).over(here.rowsBetween(Window.unboundedPreceding, -1)))
    d = carried_on(d, part, "_local", F.max, [lo, hi]).withColumn("_far", F.greatest("_own", "_before")).drop("_local", "_own", "_before")
    begins = F.when(F.col(lo) - F.col("_far") <= gap, None).otherwise(F.col(lo))
    d = running_max(d, begins, "_island")
    return d.groupBy(*part, "_island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count("*").alias("n")).drop("_island")


def order_breaks(df: DataFrame, part: str, order: str, keys: list[str], word: str) -> DataFrame:
    """Rows whose keys all go backwards against the row before; none where a key is empty or a word has a blank. Adds broken."""
    d = previous(df, part, order, [*keys, word])
    back = ~F.col(word).contains(" ") & ~F.col("_prev")[word].contains(" ")
    for k in keys:
        back = back & (F.col(k) < F.col("_prev")[k]) & (F.col(k) != "") & (F.col("_prev")[k] != "")
    return d.withColumn("broken", F.coalesce(back, F.lit(False))).drop("_prev")


def single_key_breaks(df: DataFrame, part: str, order: str, key: str) -> DataFrame:
    """Rows whose key goes backwards against the last row before that has one. Adds broken: false where the key is empty or the first."""
    named = previous(df.where(F.col(key) != ""), part, order, [key]).select(F.col(part).alias("_p"), F.col(order).alias("_o"), (F.col(key) < F.col("_prev")[key]).alias("_back"))
    met = df.join(named, F.col(part).eqNullSafe(F.col("_p")) & (F.col(order) == F.col("_o")), "left")
    return met.withColumn("broken", F.coalesce("_back", F.lit(False))).drop("_p", "_o", "_back")


def pieced_runs(c: Column, kind: str, least: int = 1, step: int = 64) -> Column:
    """array<struct<at, length, text>> of the runs of least characters or more of a class of characters, places from one. The pieces of a text are gone through
    in steps, whose places are summed up first, so that a very long one isn't quadratic; a run brings its own text, which needs no search for its place."""
    bound = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  x is computed once
    size = lambda ps: F.length(F.array_join(ps, ""))
    none = F.array().cast("array<struct<at:int,length:int,text:string>>")

    def begins(chunks: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(chunks, start, lambda a, ps: F.struct((a["at"] + size(ps)).alias("at"), F.array_append(a["all"], a["at"]).alias("all")))["all"]

    def inner(pieces: Column, begin: Column) -> Column:
        # Pieces are a run and what isn't one by turns; places are those behind each piece.
        ends = F.aggregate(pieces, F.array(begin), lambda a, p: F.array_append(a, F.element_at(a, -1) + F.length(p)))
        every = bound(ends, lambda e: F.zip_with(pieces, e, lambda p, at: F.struct(at.alias("at"), F.length(p).alias("length"), p.alias("text"))))
        odd = F.element_at(pieces, 1).rlike(f"^[{kind}]").cast("int")
        return bound(odd, lambda o: F.filter(every, lambda r, i: ((i + o) % 2 == 1) & (r["length"] >= least)))

    cut = lambda ps: F.transform(F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / step).cast("int")), lambda j: F.slice(ps, j * step + 1, F.lit(step)))
    parts = F.regexp_extract_all(c, F.lit(f"[{kind}]+|[^{kind}]+"), F.lit(0))
    every = bound(parts, lambda ps: F.when(F.size(ps) > 0, bound(cut(ps), lambda ch: F.flatten(F.zip_with(ch, begins(ch), inner)))).otherwise(none))
    return F.when(c.isNotNull(), every)


def binary_runs(c: Column, kind: str, least: int = 1, step: int = 64) -> Column:
    """array<struct<at, length>> of the runs of least characters or more of a class of characters, places from one."""
    return F.transform(pieced_runs(c, kind, least, step), lambda r: F.struct(r["at"].alias("at"), r["length"].alias("length")))


def islands(df: DataFrame, text: str, kind: str) -> DataFrame:
    """A row (all columns of df but text, first, last, word) for each run of a class of characters in text, places from one, ends inclusive. Rows don't carry
    the text, and no run is looked for in it again, so a text's work grows with its length."""
    rest = [c for c in df.columns if c != text]
    runs = df.select(*rest, F.explode(pieced_runs(F.col(text), kind)).alias("_r"))
    first = F.col("_r.at")
    return runs.select(*rest, first.cast("long").alias("first"), (first + F.col("_r.length") - 1).cast("long").alias("last"), F.col("_r.text").alias("word"))


def majority(df: DataFrame, key: list[str], value: str, least: int = 3, share: float = 0.6) -> DataFrame:
    """(key…, value, votes, total): each key's most frequent value if it has the votes and the share; ties go to the smaller value."""
    votes = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("votes"))
    best = votes.groupBy(*key).agg(F.min(F.struct((-F.col("votes")).alias("_less"), F.col(value).alias("_value"))).alias("_b"), F.sum("votes").alias("total"))
    out = best.select(*key, F.col("_b._value").alias(value), (-F.col("_b._less")).alias("votes"), "total")
    return out.where((F.col("votes") >= least) & (F.col("votes") >= share * F.col("total")))


def ranked(df: DataFrame, part: str, order: str, name: str = "rank") -> DataFrame:
    """One-based rank of each row within its key, by a numeric order column without ties."""
    return running_sum(df, part, order, F.lit(1), name)


def reservoir(df: DataFrame, part: str, keys: list[str], n: int, seed: int = 0, by: Column | None = None) -> DataFrame:
    """n rows of each part at most, chosen by a seeded hash of the keys: the same rows on every run and under every partitioning. The smallest hashes are
    found by a partial aggregate first, so a large part isn't sorted. by: a hash of 64 bits of one's own, where other engines must draw the same rows."""
    named = df.withColumn("_h", F.xxhash64(F.lit(seed), *keys) if by is None else by)
    share = named.groupBy(part).agg(F.count("*").alias("_m")).select(F.col(part).alias("_p"), "_m")
    # Of m rows with even hashes those under 4 n / m hold the n smallest but for odds of next to nothing; where they don't, all rows are looked at.
    low = F.lit(-(1 << 63)).cast("double") + F.least(F.lit(1.0), F.lit(4.0 * n + 64) / F.col("_m")) * F.lit(float(1 << 64))
    marked = named.join(share, F.col(part).eqNullSafe(F.col("_p"))).withColumn("_near", F.col("_h").cast("double") <= low)
    enough = marked.where("_near").groupBy("_p").agg(F.count("*").alias("_k")).withColumnRenamed("_p", "_q")
    able = marked.join(enough, F.col("_p").eqNullSafe(F.col("_q")), "left").where(F.col("_near") | (F.coalesce("_k", F.lit(0)) < F.least(F.lit(n), F.col("_m"))))
    return able.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy("_h", *keys))).where(F.col("_rn") <= n).drop("_h", "_p", "_m", "_near", "_q", "_k", "_rn")


def top_per_group(df: DataFrame, part: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(part).orderBy(*order))).where(F.col("rn") <= n)


def batches(df: DataFrame, part: str, order: str, size: int) -> DataFrame:
    """Batch number and place within it, by order within each part."""
    d = running_sum(df, part, order, F.lit(1), "_rn")
    return d.withColumn("batch", F.floor((F.col("_rn") - 1) / size).cast("long")).withColumn("place", ((F.col("_rn") - 1) % size).cast("long")).drop("_rn")


def most_common(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n most frequent keys with their number, by descending number, then by key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(n)
