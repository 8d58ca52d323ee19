"""Chunked running sums and lags equal plain windows, whatever the chunks; similar sets equal brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from glossweave.operators import matching, quality, repair, sequence


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), i * rnd.choice([1, 1, 1]) + (i // 7) * 13, rnd.choice(["x", "yy", "z z", ""]), rnd.randint(0, 5)) for i in range(200)]
    return spark.createDataFrame(data, "k string, o long, w string, v int").cache()


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_running_sum_and_previous(rows, size):
    w = Window.partitionBy("k").orderBy("o")
    got = sequence.running_sum(rows, "k", "o", F.col("v"), "s", size)
    want = rows.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got = sequence.previous(rows, "k", "o", ["w", "v"], size)
    want = rows.withColumn("_prev", F.lag(F.struct("w", "v")).over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_similar_sets(spark):
    rnd = random.Random(2)
    sets = [(i, sorted(rnd.sample(range(30), rnd.randint(0, 12)))) for i in range(60)]
    df = spark.createDataFrame([(i, [str(x) for x in s]) for i, s in sets], "i int, s array<string>")
    want = {(a, b, len(set(x) & set(y))) for a, x in sets for b, y in sets if a < b and len(set(x) & set(y)) >= 5}
    assert {(r.a, r.b, r.both) for r in matching.similar_sets(df, "i", "s", 5).collect()} == want and want


def test_quality_families_report_one_of_three(spark):
    df = spark.createDataFrame([("a",), ("",), ("b  c-",)], "t string")
    checks = [("empty", F.col("t") == ""), quality.first_of(("hyphen", F.col("t").endswith("-")), ("blanks", F.col("t").contains("  ")))]
    assert sorted((r.t, r.family) for r in quality.families(df, checks).collect()) == [("", "empty"), ("b  c-", "hyphen")]


def test_fragments_are_found_in_order(spark):
    df = spark.createDataFrame([("an anan banan", ["an", "an", "ban", "x", "nan"])], "t string, f array<string>")
    assert df.select(repair.locate(F.col("t"), F.col("f")).alias("x")).first().x == [1, 4, 9, 0, 5]


def test_letter_islands_of_all_lines(spark, sf):
    """Every run of letters of every line, by brute force."""
    import re

    from glossweave.plans import registry

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, n, m.start() + 1, m.end(), m[0]) for d in docs for n, line in enumerate((d.text or "").split("\n"), 1) for m in re.finditer("[A-Za-zÀ-ÿ]+", line)}
    got = registry.QUERIES["letter_islands"](spark, sf).select("doc_id", "line", "first", "last", "word").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want and any(w[1] > 1 for w in want)


def test_runs_bring_their_own_text(spark):
    """Each run's row carried the whole text and looked for its place in it again, which is quadratic in the text's length."""
    texts = ["", "é", " aé-b", "1 2", "ab" * 40 + ("a1b " * 200), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = sequence.islands(df, "t", "A-Za-zÀ-ÿ")
    import re

    want = {(i, m.start() + 1, m.end(), m[0]) for i, t in enumerate(texts) for m in re.finditer("[A-Za-zÀ-ÿ]+", t or "")}
    assert {tuple(r) for r in got.collect()} == want
    # What comes out of the explosion holds no text of the row.
    lines = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate" in x]
    assert len(lines) == 1 and "[1]" in lines[0] and "substring(t" not in got._jdf.queryExecution().optimizedPlan().toString()
    runs = df.select("i", sequence.binary_runs(F.col("t"), "a-z", 2, 3).alias("r")).collect()
    assert {(r.i, x.at, x.length) for r in runs for x in r.r or []} == {(i, m.start() + 1, len(m[0])) for i, t in enumerate(texts) for m in re.finditer("[a-z]{2,}", t or "")}
