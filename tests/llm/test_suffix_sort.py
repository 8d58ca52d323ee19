import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import brute
import numpy as np
import pytest

from glossweave.llm import suffix_sort

SCHEMA = "doc_id long, text string, g string, row int, keys int"


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("length", [50, 20])
def test_equals_brute_force(spark, length):
    docs = brute.corpus()
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(3)
    assert result(suffix_sort.dedup(df, length=length)) == brute.op2(docs, length)


def test_small_groups_and_hot_classes(spark, monkeypatch):
    """Many groups and ranges, classes that are dealt out window by window, few windows sorted at a time: the same result, however the rows lie."""
    for name, value in (("GROUP_DOCS", 9), ("GROUP_BYTES", 4000), ("PART_BYTES", 2000), ("HOT", 3), ("AT_ONCE", 50)):
        monkeypatch.setattr(suffix_sort, name, value)
    docs = brute.corpus(150, seed=5)
    for parts in (1, 4):
        df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(parts)
        assert result(suffix_sort.dedup(df)) == brute.op2(docs)


def test_radix_orders_bytes():
    rng = np.random.default_rng(1)
    rows = np.zeros((500, 24), np.uint8)
    rows[:, :21] = rng.integers(97, 99, (500, 21)) * (rng.random((500, 21)) < 0.9)
    order, new = suffix_sort.radix(rows)
    got = [bytes(r) for r in rows[order]]
    begin = [got[i] for i in np.flatnonzero(new)]
    assert sorted(set(got)) == sorted(begin) and len(begin) == new.sum()
    assert [x for i, x in enumerate(got) if not i or got[i - 1] != x] == begin == sorted(begin)


def test_kept_bytes_and_very_long_text(spark):
    """What is kept is the text without what is removed; a text of 3 MB, an overlapping part of it, nulls and an empty text."""
    rng = np.random.default_rng(2)
    long_ = "".join(map(chr, rng.integers(97, 123, 3_000_000)))
    docs = [(1, long_), (2, "head " + long_[1000:1200] + " tail"), (3, None), (4, ""), (5, long_), (None, "head " + long_[5:95])]
    rows = {r.doc_id: r for r in suffix_sort.dedup(spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA)).collect()}
    assert (rows[1].n_removed, rows[2].n_removed, rows[3].n_bytes, rows[4].n_bytes, rows[5].n_removed, rows[None].n_removed) == (0, 200, 0, 0, 3_000_000, 90)
    assert bytes(rows[2].kept) == b"head  tail" and bytes(rows[1].kept) == long_.encode() and rows[5].kept == b"" and bytes(rows[None].kept) == b"head "


def test_empty_table(spark):
    assert result(suffix_sort.dedup(spark.createDataFrame([], SCHEMA))) == []


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from glossweave.llm.queries import QUERIES

    got = sorted((tuple(r)[:5] for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()), key=str)
    assert got == brute.op2([(r.doc_id, r.text) for r in docs.collect()])
