"""Dictionaries of phrases against one alternation, longest first."""

import random
import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from glossweave.operators import matching, phrases
from glossweave.plans import large, registry


def plain(text, table):
    """Text and number of replacements, by one pattern of all phrases sorted by length."""
    if text is None:
        return None, 0
    known, n = sorted((p for p in table if p and regex.match(phrases.WORD, p) and regex.match(phrases.WORD, p[-1])), key=len, reverse=True), 0
    if not known:
        return text, 0
    pattern, out = regex.compile(f"(?:{'|'.join(map(regex.escape, known))})(?!{phrases.WORD})|{phrases.TOKENS}"), []
    for m in pattern.findall(text):
        out.append(table.get(m, m) if m in known else m)
        n += m in known
    return "".join(out), n


@pytest.mark.parametrize("shard_bytes", [1 << 20, 200])
def test_equals_one_alternation(spark, shard_bytes):
    rnd = random.Random(7)
    words = ["in", "the", "house", "of", "ü", "a_b", "x2", "house's"]
    seps = [" ", " ", " ", "  ", "\n", ", ", "-"]
    say = lambda n: "".join(w + rnd.choice(seps) for w in rnd.choices(words, k=n))
    table = {rnd.choice(["", " ", "-"]) * (rnd.random() < 0.1) + " ".join(rnd.choices(words, k=rnd.randint(1, 4))): f"<{i}>" for i in range(40)}
    table["the house"] = ""
    texts = [None, "", "the", "the house", "thehouse the  house", *(say(rnd.randint(1, 60)) for _ in range(60)), say(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    dic = spark.createDataFrame([*table.items(), (None, "x"), ("in", None) if "in" not in table else ("", "y")], "p string, v string")
    if "in" not in table:
        table["in"] = ""
    got = {r.i: (r.replaced, r.replacements) for r in phrases.replace(df, "t", dic, "p", "v", shard_bytes=shard_bytes).collect()}
    assert got == {i: plain(t, table) for i, t in enumerate(texts)}


def test_equals_the_constant_map(spark):
    small = {"in the": "IN", "the": "T", "in": "I", "theory of": "TO"}
    texts = ["in the house, the in theory (in)\nthe", None, "", "the theory of in the"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    dic = spark.createDataFrame(list(small.items()), "p string, v string")
    a = [r.replaced for r in phrases.replace(df, "t", dic, "p", "v").orderBy("i").collect()]
    b = [r.x for r in df.select("i", matching.replace_phrases(F.col("t"), small).alias("x")).orderBy("i").collect()]
    assert a == b


def test_places_do_not_depend_on_stretches(monkeypatch):
    """Long texts and many short ones in one batch, phrases that cross the edges of stretches."""
    rnd = random.Random(9)
    dic = [rnd.choices("abc", k=rnd.randint(1, 6)) for _ in range(30)]
    auto = phrases.Automaton(dic)
    texts = [rnd.choices("abcd", k=rnd.choice([0, 1, 5, 900])) for _ in range(40)]
    tokens = np.array([auto.number.get(t, 0) for x in texts for t in x], np.int64)
    rows = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    want, base = [], 0
    for x in texts:
        for i in range(len(x)):
            sizes = [len(p) for p in dic if x[i : i + len(p)] == p]
            want.append(max(sizes, default=0))
    for stretch in (1, 3, 256):
        monkeypatch.setattr(phrases, "STRETCH", stretch)
        got = auto.starts(tokens, rows)
        assert [len(dic[k]) if k >= 0 else 0 for k in got] == want


def test_empty_dictionary(spark):
    df = spark.createDataFrame([(1, "a b")], "i int, t string")
    none = spark.createDataFrame([], "p string, v string")
    assert [tuple(r) for r in phrases.replace(df, "t", none, "p", "v").collect()] == [(1, "a b", "a b", 0)]
    assert phrases.replace(df.limit(0), "t", none, "p", "v").count() == 0


def test_query_over_benchmark_and_parts(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    table = {r.phrase: r.value for r in large.phrase_dictionary(spark, sf).groupBy("phrase").agg(F.min("value").alias("value")).collect()}
    assert len(table) > 500
    known = sorted(table, key=len, reverse=True)
    pattern = regex.compile(f"(?<!{phrases.WORD})(?:{'|'.join(map(regex.escape, known))})(?!{phrases.WORD})")
    want = {d: pattern.subn(lambda m: table[m[0]], t) for d, t in docs.items()}
    got = {r.doc_id: (r.replaced, r.replacements) for r in registry.QUERIES["dictionary_phrases"](spark, sf).collect()}
    assert got == want and sum(n for _, n in want.values()) > 0


def test_batches_are_bounded_by_bytes(spark):
    """Python gets at most some MB of long texts at once, not 10,000 rows of any length."""
    from glossweave.operators import lexicon, phrases

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    df, words = spark.createDataFrame([(1, "some word")], "i long, t string"), spark.createDataFrame([("word", "x")], "p string, v string")
    for made in (lambda: lexicon.first_context(df, "i", "t"), lambda: phrases.replace(df, "t", words, "p", "v")):
        spark.conf.unset(name)
        assert made().count() and int(spark.conf.get(name)) <= 8 << 20
