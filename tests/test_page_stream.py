"""The stream of records against the batch cut."""

import datetime
import random

from pyspark.sql import functions as F

from glossweave.operators import records
from glossweave.streaming import pages

LINES = "page int, k int, text string, underlines array<struct<a: int, b: int>>, at timestamp"


def made_up(rnd, page):
    out, k = [], 0
    for _ in range(rnd.randint(3, 25)):
        text = rnd.choice(["", "  ", "amo. (fako) texto e plu", "rivo. Aquo qua flu-", "as e plu", "texto", "AB. texto", "*stelo. texto", "kurta"])
        out.append((page, k, text, [(0, 3)] if rnd.random() < 0.15 else [(2, 4)] if rnd.random() < 0.3 else []))
        k += 1
    return out


def test_stream_equals_batch(spark, tmp_path):
    """Lines of twelve pages, shuffled over four batches; what comes after a page is closed is late."""
    rnd = random.Random(8)
    lines = [x for p in range(12) for x in made_up(rnd, p)]
    t0 = datetime.datetime(2024, 1, 1)
    rnd.shuffle(lines)
    source, kept = tmp_path / "in", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    batches = [[(*x, t0 + datetime.timedelta(minutes=i)) for x in lines[i::3]] for i in range(3)]
    batches.append([(99, 0, "fino. texto", [], t0 + datetime.timedelta(days=1))])  # moves the watermark on
    batches.append([(3, 500, "tro tarda", [], t0 + datetime.timedelta(days=1)), (98, 0, "altra. texto", [], t0 + datetime.timedelta(days=2))])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for i, b in enumerate(batches):
            spark.createDataFrame(b, LINES).coalesce(1).write.mode("append").parquet(str(source))
            stream = spark.readStream.schema(LINES).parquet(str(source))
            q = pages.cut_stream(stream, "at").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
            q.awaitTermination(180)
            assert q.exception() is None
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    want = records.cut(spark.createDataFrame([(*x, t0) for x in lines], LINES)).collect()
    assert sorted((r.page, r.line, r.text) for r in got if r.kind == "record" and r.page < 98) == sorted((r.page, r.line, r.text) for r in want)
    assert [(r.page, r.line, r.text) for r in got if r.kind == "late"] == [(3, 500, "tro tarda")]
    above = {r.page: r.text for r in got if r.kind == "orphan"}
    for p in range(12):
        assert above.get(p, "") == pages.cut_page([(k, t, any(u[0] == 0 for u in us)) for q, k, t, us in lines if q == p])[0]


def test_cut_page():
    assert pages.cut_page([]) == ("", [])
    assert pages.cut_page([(2, "amo. una", False), (1, "", False), (0, "resto de-", False), (3, "du", False)]) == ("resto de-", [(2, "amo. una du")])
