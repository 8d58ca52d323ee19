import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import brute
import pytest

from glossweave.llm import automata

SCHEMA = "doc_id long, text string, g string, row int, keys int"


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("length", [13, 4])
def test_equals_brute_force(spark, length):
    docs = brute.corpus()
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(3)
    assert result(automata.dedup(df, length=length)) == brute.op7(docs, length)


def test_empty_table(spark):
    assert result(automata.dedup(spark.createDataFrame([], SCHEMA))) == []


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from glossweave.llm.queries import QUERIES

    got = sorted((tuple(r)[:4] for r in QUERIES["op7_substring_dedup"](spark, sf).collect()), key=str)
    assert got == brute.op7([(r.doc_id, r.text) for r in docs.collect()])


def test_matching_statistics():
    a = automata.automaton_of([__import__("numpy").array([1, 2, 3, 2, 3, 4]), __import__("numpy").array([5, 6])])
    assert a.matches([2, 3, 2, 3, 4, 5, 6, 7, 1, 2]) == [1, 2, 3, 4, 5, 1, 2, 0, 1, 2]


def test_shards_overlap(spark, monkeypatch):
    monkeypatch.setattr(automata, "SHARD_WORDS", 40)
    monkeypatch.setattr(automata, "BROADCAST_BYTES", 0)
    docs = brute.corpus(60, seed=5)
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(3)
    assert result(automata.dedup(df)) == brute.op7(docs)
