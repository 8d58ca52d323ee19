"""Learned labels on rows that were held out, and the book writer."""

import numpy as np
import pytest

from glossweave.operators import repair
from glossweave.plans import registry
from pyspark.sql import functions as F
from glossweave.sources import sinks


@pytest.fixture(scope="module")
def clouds(spark):
    """Three classes as overlapping clouds; a label is known for one row in ten."""
    rnd = np.random.default_rng(3)
    centres = rnd.normal(scale=2.5, size=(3, 6))
    rows = [(i, (centres[i % 3] + rnd.normal(size=6)).tolist(), i % 3, i % 3 if i % 10 == 0 else None, i % 30) for i in range(900)]
    return spark.createDataFrame(rows, "k long, v array<double>, truth int, known int, page int").cache()


def held_out(clouds, got):
    both = clouds.join(got.select("k", F.col("label").alias("said")), "k").where("known is null")
    return both.select(F.avg((F.col("said") == F.col("truth")).cast("double"))).first()[0]


def test_self_training_on_held_out_rows(clouds):
    got = repair.self_train(clouds, "k", "v", "known", confident=0.95)
    assert got.count() == 900 and held_out(clouds, got) > 0.93


def test_rounds_of_the_perceptron(clouds):
    one = repair.perceptron(clouds, "k", "v", "known")
    some = repair.perceptron_rounds(clouds, "k", "v", "known", rounds=2, group="page")
    a, b = held_out(clouds, one), held_out(clouds, some)
    assert a > 0.9 and b > a - 0.03 and some.count() == 900


def test_votes_agree_with_the_clusters_truth(clouds):
    """Rows gathered by their true class: the vote of each such cluster is that class."""
    got = repair.perceptron(clouds, "k", "v", "known").join(clouds.select("k", "truth"), "k")
    assert {r.truth: r.label for r in repair.cluster_votes(got, "truth", "posterior").collect()} == {0: 0, 1: 1, 2: 2}


def test_book(spark):
    df = spark.createDataFrame([("b", "du"), ("a", "una\nlinio")], "k string, t string").repartition(2)
    lines = [r[0] for r in sinks.book(df, ["k"], F.concat(F.lit("## "), "k", F.lit("\n"), "t"), "Libro").collect()]
    assert lines == ["# Libro\n", "## a\nuna\nlinio\n", "## b\ndu\n", "---"]


def test_rounds_query(spark, sf):
    rows = registry.QUERIES["perceptron_rounds_labels"](spark, sf).collect()
    assert {r.vec_id for r in rows} == {r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
