"""Leaders in rounds against one pass; batches against full k-means."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossweave.functions import udfs
from glossweave.operators import clusters
from glossweave.plans import registry


def one_pass(rows, threshold):
    """rows (order, key, vector): key to the key of its leader."""
    rows = sorted(rows)
    at = udfs.leaders(np.array([v for _, _, v in rows], float), threshold)
    heads = []
    for (_, k, _), i in zip(rows, at):
        if i == len(heads):
            heads.append(k)
    return {k: heads[i] for (_, k, _), i in zip(rows, at)}


@pytest.mark.parametrize("block,threshold", [(1, 0.6), (7, 0.6), (1000, 0.9), (16, -1.0)])
def test_leaders_equal_one_pass(spark, block, threshold):
    rnd = np.random.default_rng(block)
    rows = [(int(o), f"k{i}", v.tolist()) for i, (o, v) in enumerate(zip(rnd.permutation(90 if block > 1 else 25), np.vstack([rnd.normal(size=(80, 4)), np.repeat(rnd.normal(size=(1, 4)), 10, 0)])))]
    df = spark.createDataFrame([*rows, (999, "null", None)], "o int, k string, v array<double>").repartition(3)
    got = clusters.leaders(df, "k", "v", ["o"], threshold, block).collect()
    assert {r.k: r.leader for r in got} == one_pass(rows, threshold) and all(r.leads == (r.k == r.leader) for r in got) and len(got) == len(rows)


def test_leaders_of_all_embeddings(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = {r.vec_id: r.leader for r in registry.QUERIES["leader_rounds"](spark, sf).collect()}
    assert got == one_pass([(r.vec_id, r.vec_id, list(r.embedding)) for r in emb], 0.5)


def test_no_vector_passes_the_driver(spark, monkeypatch):
    """A round took its first block from every partition through the driver, and sent its leaders from there."""
    def never(*args, **more):
        raise AssertionError("vectors in the driver")

    rnd = np.random.default_rng(5)
    rows = [(i, i, v) for i, v in enumerate(rnd.normal(size=(300, 8)).tolist())]
    df = spark.createDataFrame([(i, v) for i, _, v in rows], "k long, v array<double>")
    monkeypatch.setattr(type(df), "toPandas", never)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", never)
    assert {r.k: r.leader for r in clusters.leaders(df, "k", "v", ["k"], 0.6, 64).collect()} == one_pass(rows, 0.6)


def test_settled_in_slabs():
    v = clusters.unit(np.random.default_rng(4).normal(size=(120, 3)))
    at = udfs.leaders(v, 0.7)
    heads = [i for i, a in enumerate(at) if a not in at[:i]]
    for slab in (1, 7, 500):
        assert clusters.settle(v, 0.7, slab).tolist() == [heads[a] for a in at]


def test_empty(spark):
    none = spark.createDataFrame([], "k long, v array<double>")
    assert clusters.leaders(none, "k", "v", ["k"], 0.5).count() == 0


def test_batches_come_near_full_kmeans_and_rerun(spark, sf):
    """Mean distance to the nearest centre within 2 % of what Lloyd's iterations make of the same centres; the same centres however the rows lie."""
    emb = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    runs = [clusters.mini_batch(emb.repartition(n), "vec_id", "embedding", 10) for n in (2, 5)]
    assert np.allclose(runs[0], runs[1], atol=1e-9)
    v = clusters.unit([r.embedding for r in emb.collect()])
    full = runs[0]
    for _ in range(30):
        at = (v @ full.T).argmax(axis=1)
        full = np.stack([clusters.unit([v[at == i].sum(axis=0)])[0] if (at == i).any() else full[i] for i in range(10)])
    loss = lambda c: 1 - (v @ c.T).max(axis=1).mean()
    assert loss(runs[0]) <= 1.02 * loss(full)
    got = {r.vec_id: r.cluster for r in registry.QUERIES["minibatch_kmeans"](spark, sf).collect()}
    assert set(got) == {r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}


def test_assignment_in_slabs(spark):
    rnd = np.random.default_rng(3)
    centres, v = clusters.unit(rnd.normal(size=(23, 6))), rnd.normal(size=(50, 6))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "i int, v array<double>")
    for slab in (1, 5, 100):
        got = {r.i: r.cluster for r in clusters.assign(df, "v", centres, slab=slab).collect()}
        assert got == dict(enumerate((clusters.unit(v) @ centres.T).argmax(axis=1).tolist()))
