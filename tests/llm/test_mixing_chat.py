import re

import duckdb
import numpy as np
import pytest

from glossweave.llm import chat, mixing
from glossweave.llm.queries import QUERIES, SQL


def goals(sizes, weights=(1, 2, 3)):
    """Targets by resharing the excess until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, float(sum(sizes.values())), set(names)
    while True:
        unit = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if unit * weight[s] > 3 * sizes[s]}
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full


def check(rows, docs):
    sizes, taken = {}, {}
    for d, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    want = goals(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.copies <= 3 and abs(r.copies - r.rate) <= 1
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    return want, taken


def test_targets_and_rates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    want, taken = check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert sum(abs(taken[s] - want[s]) for s in want) < 0.05 * sum(want.values())
    # Rates solve the token constraints and are exponential in size.
    for s in want:
        mine = [r for r in rows if r.source == s]
        assert sum(r.rate * r["size"] for r in mine) == pytest.approx(want[s], rel=1e-5)
        free = [(np.log(r.rate) / r["size"]) for r in mine if 1e-200 < r.rate < 3 and r["size"]]
        assert np.ptp(free) < 1e-9 if free else True
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


def test_null_and_capped_sources(spark):
    docs = [(i, "w " * (i % 7 + 1), "a") for i in range(300)] + [(1000 + i, "x y", None) for i in range(5)] + [(2000, None, "b"), (2001, "", "b"), (None, "q", "c"), (None, "q", "c"), (7, "w " * 9000, "a")]
    df = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, source string, rate int, mult int")
    rows = mixing.mix(df).collect()
    want, taken = check(rows, docs)
    assert want[None] == 30 and taken[None] == 30
    assert mixing.mix(df.limit(0)).count() == 0


def test_chat_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op9_chat_rotation"](spark, sf)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    want = con.execute(SQL["op9_chat_rotation"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 50


def test_rotation_masks(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "late"), (2, 0, "system", "x"), (None, 3, "ann", "é")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, speaker int")
    rows = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(df).collect()}
    assert set(rows) == {(1, s, p) for s in ("ann", "bob", "unknown") for p in (0, None)} | {(None, "ann", 0)}
    r = rows[1, "bob", 0]
    assert r.text.count("<|im_start|>assistant\n<|im_end|>") == 2 and "user name=ann\nhi < |im_end|>" in r.text
    assert [r.text[m.start : m.end] for m in r["mask"]] == ["<|im_end|>"] * 2
    late = rows[1, "unknown", None]
    assert late.start == len(rows[1, "unknown", 0].text) and [late.text[m.start : m.end] for m in late["mask"]] == ["late<|im_end|>"]
    assert chat.rotate(df.limit(0)).count() == 0


def test_newton_meets_its_target():
    """Random sources, targets up to just under the cap and down to next to nothing; too few iterations are an error."""
    rnd = np.random.default_rng(6)
    for _ in range(200):
        size = np.unique(rnd.integers(0, rnd.choice([5, 300, 20_000]), rnd.integers(2, 60)))
        if size[-1] == 0:
            continue
        n = rnd.integers(1, 1000, len(size))
        own, mean = float((n * size).sum()), float((n * size).sum() / n.sum())
        for share in (0.001, 0.3, 0.999, 1.001, 1.7, 2.9, 2.9999):
            at = mixing.newton(size, n, mean, own * share, 3.0, 300)
            got = float((n * size * np.minimum(3.0, np.exp(np.minimum(at * size / mean, 50)))).sum())
            assert got == pytest.approx(own * share, rel=1e-6), (size, share)
    with pytest.raises(ArithmeticError):
        mixing.newton(np.array([1, 100]), np.array([5, 7]), 10.0, 1900.0, 3.0, 2)
