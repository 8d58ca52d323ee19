"""Searches over the index against the scan of `search`, and against plain rules."""

import random

from pyspark.sql import functions as F

from glossweave.operators import search, search_index


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def plain(q, forms, body):
    if not q:
        return 0
    ranks = [5] if body is not None and q in body.lower() else []
    for f in forms:
        if f is None:
            continue
        d = distance(f, q) if len(q) >= 4 and abs(len(f) - len(q)) <= 2 else 9
        ranks += [0] if f == q else [1] if f.startswith(q) else [2] if q in f else [d + 2] if d <= 2 else []
    return min(ranks, default=None)


def made_up(seed):
    rnd = random.Random(seed)
    word = lambda a, b: "".join(rnd.choice("abcé") for _ in range(rnd.randint(a, b)))
    records = [(i, [word(0, 9) for _ in range(rnd.randint(0, 3))] + [None] * (rnd.random() < 0.1), rnd.choice([None, "", word(3, 12).upper()])) for i in range(80)]
    queries = ["", " ", None, *(word(1, 8) for _ in range(120)), " ABC "]
    return records, queries


def test_equals_plain_rules(spark):
    records, queries = made_up(4)
    df = spark.createDataFrame(records, "i int, fs array<string>, b string").repartition(3)
    index = search_index.build(df, "i", F.col("fs"), F.col("b"))
    got = {(r.q, r.key): r["rank"] for r in search_index.search(index, spark.createDataFrame([(q,) for q in queries], "x string"), "x").collect()}
    want = {}
    for q in {q.strip(" ").lower() for q in queries if q is not None}:
        for i, fs, b in records:
            r = plain(q, fs, b)
            if r is not None and (q or [f for f in fs if f is not None] or b is not None):
                want[q, i] = r
    assert got == want


def test_equals_the_scan(spark, sf):
    """The same rows as the scanning search, with its order, from an index that was saved and opened again."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    forms, body = F.concat(F.array(F.lower("p_name")), F.split(F.lower("p_name"), " ")), F.concat_ws(" ", "p_type", "p_brand")
    search_index.build(part, "p_partkey", forms, body).save(f"{spark.conf.get('spark.checkpoint.dir')}/saved-index", 4, "saved_parts")
    index = search_index.Index.load(spark, "saved_parts")
    queries = ["rings", "gizmo", "smal", "brand#1", "e", "zzzz"]
    hits = search_index.top(search_index.search(index, spark.createDataFrame([(q,) for q in queries], "q string"), "q"), part.withColumnRenamed("p_partkey", "key"), "key", ["p_name", "key"], 400)
    for q in queries:
        want = [(r["rank"], r.p_partkey) for r in search.search(part, q, forms, body, ["p_name", "p_partkey"]).collect()]
        assert [(r["rank"], r.key) for r in hits.where(F.col("q") == q).orderBy("place").collect()] == want
    for f in ("forms", "bodies", "grams", "pieces", "counts"):
        spark.sql(f"drop table saved_parts_{f}")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "i int, fs array<string>, b string")
    index = search_index.build(none, "i", F.col("fs"), F.col("b"))
    assert search_index.search(index, spark.createDataFrame([("a",), ("",)], "q string"), "q").count() == 0
