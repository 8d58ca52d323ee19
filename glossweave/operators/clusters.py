"""Clusters of vectors without a group in one task: leaders in rounds, and k-means by batches.

What every task holds is bounded by a parameter: a block of new leaders, or the centres.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranges
from .tables import keep

#: Vectors that a round settles in one task, whose leaders every part of the others holds.
BLOCK = 16384


def unit(rows) -> np.ndarray:
    """Vectors as rows of unit length; those of no length stay."""
    v = np.stack([np.asarray(x, np.float64) for x in rows])
    return v / np.maximum(1e-12, np.linalg.norm(v, axis=1, keepdims=True))


def first_near(v: np.ndarray, heads: np.ndarray, threshold: float, slab: int = 256) -> np.ndarray:
    """For each vector the first of heads with at least that cosine, or -1; both are of unit length and meet slab by slab."""
    at = np.full(len(v), -1)
    for a in range(0, len(v) if len(heads) else 0, slab):
        near = v[a : a + slab] @ heads.T >= threshold
        at[a : a + slab] = np.where(near.any(axis=1), near.argmax(axis=1), -1)
    return at


def settle(v: np.ndarray, threshold: float, slab: int = 256) -> np.ndarray:
    """For each vector in order the place of its leader: the first one before it that leads and has at least that cosine, or itself."""
    chosen, heads = np.full(len(v), -1), np.zeros(0, np.int64)
    for a in range(0, len(v), slab):
        own = v[a : a + slab]
        at, like, fresh = first_near(own, v[heads], threshold), own @ own.T >= threshold, []
        for i in range(len(own)):
            near = [h for h in fresh if like[h, i]] if at[i] < 0 else []
            if at[i] >= 0:
                chosen[a + i] = heads[at[i]]
            elif near:
                chosen[a + i] = a + near[0]
            else:
                fresh.append(i)
                chosen[a + i] = a + i
        heads = np.concatenate([heads, a + np.array(fresh, np.int64)])
    return chosen


def leaders(df: DataFrame, key: str, vector: str, order: list[str], threshold: float, block: int = BLOCK) -> DataFrame:
    """(key, leader, leads): in order, each vector joins the first leader with at least that cosine, or leads; leader is the key of its leader.

    The result is that of one pass in order. A round settles the first block of vectors that have no leader yet among themselves, in one task, which is all
    that can decide about them. Its leaders go by a shuffle, a copy a part, to the parts of the others and stream in before them: whom none of them takes waits for
    the next round. No vector passes the driver, which learns how many are left in each run of places, no pair of vectors is ever stored, and the rounds
    are as many as blocks of vectors that no earlier leader takes. Null vectors are left out; order must have no ties.
    """
    kinds, cores = dict(df.dtypes), df.sparkSession.sparkContext.defaultParallelism
    bits = max(0, (block // 16).bit_length() - 1)
    rows = df.where(F.col(vector).isNotNull()).select(key, vector, *[o for o in order if o not in (key, vector)])
    out, left = None, ranges.numbered(rows, [], order).select(key, vector, "_place")
    ddl = f"{key} {kinds[key]}, {vector} {kinds[vector]}, _place long, _leader {kinds[key]}"

    def first(batches):
        rows = pd.concat(batches, ignore_index=True)
        at = settle(unit(rows[vector]), threshold) if len(rows) else []
        yield rows.assign(_leader=pd.Series(rows[key].to_numpy()[at].tolist() if len(rows) else [], dtype=object))

    def join(batches):
        part, keys, heads = None, [], None
        for rows in batches:
            for p, own in rows.groupby("_part"):
                if p != part:
                    part, keys, heads = p, [], np.zeros((0, 0))
                leads = own["_head"].to_numpy(bool)
                if leads.any():
                    more = unit(own[vector][leads])
                    keys, heads = keys + own[key][leads].tolist(), np.concatenate([heads, more]) if len(keys) else more
                own = own[~leads]
                if len(own):
                    at = first_near(unit(own[vector]), heads, threshold)
                    yield own[[key, vector, "_place"]].assign(_leader=pd.Series([keys[i] if i >= 0 else None for i in at], index=own.index, dtype=object))

    while True:
        cells = left.groupBy(ranges.chunk_of("_place", bits).alias("c")).count().orderBy("c").collect()  # a row a cell, sixteen cells or more a block
        if not cells:
            return out if out is not None else left.select(key, F.col(key).alias("leader"), F.lit(True).alias("leads"))
        taken = np.searchsorted(np.cumsum([r["count"] for r in cells]), block, "right")
        end, more = (cells[max(taken, 1) - 1]["c"] + 1) << bits, sum(r["count"] for r in cells[max(taken, 1) :])
        ahead = left.where(F.col("_place") < end).repartition(1).sortWithinPartitions("_place")  # a block's rows
        settled = keep(ahead.mapInPandas(first, ddl), "leaders")
        step = settled
        if more:
            parts = max(-(-more // block), min(cores, -(-more // 1024)))
            heads = settled.where(F.col("_leader") == F.col(key)).select(key, vector, "_place", F.lit(True).alias("_head"), F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("_part"))
            others = left.where(F.col("_place") >= end).select(key, vector, "_place", F.lit(False).alias("_head"), (F.col("_place") % parts).alias("_part"))
            dealt = heads.unionByName(others).repartition(parts, "_part").sortWithinPartitions("_part", F.desc("_head"), "_place")
            left = keep(dealt.mapInPandas(join, ddl), "leaders")
            step = settled.unionByName(left)
        done = step.where("_leader is not null").select(key, F.col("_leader").alias("leader"), (F.col("_leader") == F.col(key)).alias("leads"))
        out = done if out is None else out.unionByName(done)
        if not more:
            return out
        left = left.where("_leader is null").drop("_leader")


def assign(df: DataFrame, vector: str, centres: np.ndarray, name: str = "cluster", slab: int = 4096) -> DataFrame:
    """df with the number of the nearest centre by cosine, ties to the smaller, and that cosine; vectors and centres meet slab by slab."""
    sent = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        centres = sent.value
        for rows in batches:
            if not len(rows):
                continue
            v = unit(rows[vector])
            best, at = np.full(len(v), -np.inf), np.zeros(len(v), np.int64)
            for a in range(0, len(centres), slab):
                like = v @ centres[a : a + slab].T
                top = like.argmax(axis=1)
                value = like[np.arange(len(v)), top]
                at, best = np.where(value > best, a + top, at), np.maximum(best, value)
            yield rows.assign(**{name: at.astype(np.int32), "cosine": best})

    return df.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in df.dtypes) + f", {name} int, cosine double")


def mini_batch(df: DataFrame, key: str, vector: str, k: int, batches: int = 8, passes: int = 3, memory: float = 0.85, seed: int = 0) -> np.ndarray:
    """k unit centres. Rows are dealt into batches by a hash of their key, so every run sees the same ones; the first centres are the k rows of the smallest
    hashes. A centre points along a running sum of what it has drawn, of which memory is kept from batch to batch. What reaches the driver is bounded by
    the number of centres."""
    rows = df.where(F.col(vector).isNotNull()).select(key, vector).withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    rows = keep(rows.withColumn("_batch", F.pmod("_h", F.lit(batches)).cast("int")), "vectors")
    centres = unit(rows.orderBy("_h", key).limit(k).toPandas()[vector])
    total = centres.copy()
    dim = centres.shape[1]

    def drawn(parts):
        sums = np.zeros((len(centres), dim))
        for r in parts:
            if len(r):
                np.add.at(sums, r["cluster"].to_numpy(), unit(r[vector]))
        hit = np.flatnonzero(sums.any(axis=1))
        yield pd.DataFrame({"cluster": hit.astype(np.int32), "total": list(sums[hit])})

    for _ in range(passes):
        for b in range(batches):
            met = assign(rows.where(F.col("_batch") == b), vector, centres)
            parts = met.mapInPandas(drawn, "cluster int, total array<double>")
            cells = parts.select("cluster", F.posexplode("total").alias("d", "x")).groupBy("cluster", "d").agg(F.sum(F.col("x").cast("decimal(38,12)")).alias("x"))
            got = np.zeros((len(centres), dim))
            for r in cells.collect():  # centres times dimensions
                got[r.cluster, r.d] = float(r.x)
            total = memory * total + got
            centres = unit(total)
    return centres
