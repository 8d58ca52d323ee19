"""Mixing sources to target weights by entropy balancing.

Every document gets the rate nearest to 1 in relative entropy such that the words a source gives meet its target and no rate exceeds CAP:
min(CAP, exp(lambda_source * size / mean size)). The multipliers solve the convex dual, one token constraint a source, by Newton iterations
with brackets, all sources side by side, over the counts of documents by source and size: a source has as many of them as it has different
sizes, however many documents. Rates are then rounded to whole copies: within a source's buckets, from long to short documents, each document takes the
whole number next to its rate that leaves the smaller error in words, and hands that error on.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

CAP = 3
BUCKET_ROWS = 2_000
WORDS = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: str | None = None) -> DataFrame:
    """(doc_id, source, size): words outside [\\x20\\x09-\\x0D] of each whole text. keep: docs and the size under that name instead."""
    n = F.regexp_count(F.col(text_col).cast("string"), F.lit(WORDS)).cast("long")
    if keep:
        return docs.withColumn(keep, F.coalesce(n, F.lit(0)))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(n, F.lit(0)).alias("size"))


def targets(counts: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """(source, source_size, docs, least, target) from (source, size, n).

    Sources by code point, null last, take the weights in turn and share all words; targets stop at cap times their source's size, and what
    is left over goes to the others by weight. With sources in the order of cap * size / weight, those before the first that its share
    doesn't fill are the ones that stop. The windows run over one row a source.
    """
    own = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    own = own.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int")))
    own = own.withColumn("limit", cap * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    own = own.withColumn("level", left / heavy).withColumn("fits", F.col("level") * F.col("weight") <= F.col("limit"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(every)["level"]
    own = own.withColumn("target", F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit"))))
    return own.select("source", "source_size", "docs", "least", "target")


def newton(size: np.ndarray, n: np.ndarray, mean: float, target: float, cap: float, rounds: int) -> float:
    """The dual's solution for one constraint: the multiplier of size over mean at which n documents of each size give target words, at rates that stop at cap.

    Words rise with the multiplier, so every step tightens a bracket, and a Newton step that leaves it is replaced by the middle.
    """
    x, words, top = size / mean, n * size.astype(np.float64), math.log(cap)
    own = float(words.sum())
    low = 0.0 if target >= own else None
    high = 0.0 if target <= own else top / float(x[x > 0].min())
    at = 0.0
    for _ in range(rounds):
        free = at * x < top
        got = words * np.exp(np.minimum(at * x, top))
        gap, slope = float(got.sum()) - target, float((got * x)[free].sum())
        low, high = at if gap <= 0 else low, at if gap >= 0 else high
        if abs(gap) <= 1e-9 * target or (low is not None and high is not None and abs(low - high) <= 1e-13 * abs(low + high)):
            return at
        step = at - gap / slope if slope > 0 else math.nan
        if (low is None or step >= low) and (high is None or step <= high):
            at = step
        else:
            at = 2 * high - 1 if low is None else 2 * low + 1 if high is None else (low + high) / 2
    raise ArithmeticError(f"no multiplier within {rounds} iterations: {gap} of {target} words are left")


def solve(counts: DataFrame, goals: DataFrame, cap: float = CAP, rounds: int = 300) -> DataFrame:
    """goals with mult: the multiplier of size in a document's log rate; null where all rates are at the cap.

    The dual has one term a source, so the sources' iterations run side by side, each over its counts, which are one row a size and in order of size, so that
    sums don't depend on how rows lie.
    """
    kind = pa.schema([("source", pa.string()), ("source_size", pa.int64()), ("docs", pa.int64()), ("target", pa.float64()), ("mult", pa.float64())])

    def one(own: pa.Table, goal: pa.Table) -> pa.Table:
        rows = goal.select(["source", "source_size", "docs", "target"]).to_pylist()
        for g in rows:
            full = g["target"] >= cap * g["source_size"] * (1 - 1e-12)
            if full or g["target"] == g["source_size"]:
                g["mult"] = None if full else 0.0
                continue
            own = own.sort_by("size")
            mean = g["source_size"] / g["docs"]
            at = newton(own["size"].to_numpy(), own["n"].to_numpy(), mean, g["target"], cap, rounds)
            # The order of sums leaves noise in the last digits, which must not decide a rounding.
            g["mult"] = round(at / mean, 12)
        return pa.Table.from_pylist(rows, kind)

    return counts.groupBy("source").cogroup(goals.groupBy("source")).applyInArrow(one, "source string, source_size long, docs long, target double, mult double")


def rounded(size: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Whole copies, each next to its rate, such that the words' running error stays small; sizes descend."""
    out, error = np.zeros(len(size), np.int64), 0.0
    down, up = np.floor(rate), np.ceil(rate)
    for i, (s, r, lo, hi) in enumerate(zip(size.tolist(), rate.tolist(), down.tolist(), up.tolist())):
        if not s:
            out[i] = round(r)
            continue
        want = error + r * s
        k = min(hi, max(lo, math.floor(want / s + 0.5)))
        out[i] = k
        error = want - k * s
    return out


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies): how often the mix takes each row of docs.

    A null text has no words; null is a source of its own, after all others. One row for each row of docs; repeated rows are rounded one by
    one. An empty table gives an empty result. Other columns aren't read.
    """
    table = stash(sized(docs, id_col, text_col, source_col), "sizes")
    counts = stash(table.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    goals = stash(solve(counts, stash(targets(counts, weights, cap), "targets"), cap), "dual")
    kind = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("source_size", pa.int64()), ("target", pa.float64()), ("rate", pa.float64()), ("copies", pa.int64())])

    def round_off(group):
        ids = group["doc_id"].fill_null((1 << 63) - 1).to_numpy()
        size, rate = group["size"].to_numpy(), group["rate"].to_numpy()
        order = np.lexsort((ids, -size))
        group = group.take(pa.array(order))
        return group.append_column("copies", pa.array(rounded(size[order], rate[order]))).select(kind.names).cast(kind)

    own = goals.select(F.col("source").alias("s"), "source_size", "docs", "target", "mult")
    met = table.join(own, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    met = met.withColumn("rate", F.when(F.col("mult").isNull(), F.lit(float(cap))).otherwise(F.least(F.exp(F.col("mult") * F.col("size")), F.lit(float(cap)))))
    met = met.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("docs") / BUCKET_ROWS)))
    met = met.select("doc_id", "source", "size", "source_size", "target", "rate", "bucket")
    ddl = "doc_id long, source string, size long, source_size long, target double, rate double, copies long"
    return met.groupBy("source", "bucket").applyInArrow(round_off, ddl)
