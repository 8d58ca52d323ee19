"""Places of rows, chunks by rows, and scans over chunks."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from glossweave.operators import lexicon, order, ranges, sequence


def sequential(words, swap, cap, cost):
    """One pass over a whole part, the first of the cheapest at each step."""
    layers = [order.candidates_of(w or "", swap, cap) for w in words]
    best, back = [c for c, _ in layers[0]], []
    for prev, here in zip(layers, layers[1:]):
        steps = [min(range(len(prev)), key=lambda j: best[j] + (cost if c.lower() < prev[j][1].lower() else 0)) for _, c in here]
        best = [e + best[j] + (cost if c.lower() < prev[j][1].lower() else 0) for (e, c), j in zip(here, steps)]
        back.append(steps)
    path = [min(range(len(best)), key=best.__getitem__)]
    for steps in reversed(back):
        path.append(steps[path[-1]])
    return [layer[i][1] for layer, i in zip(layers, reversed(path))]


@pytest.mark.parametrize("bits,fan", [(0, 2), (3, 3), (10, 64)])
def test_respelling_in_chunks_equals_one_pass(spark, monkeypatch, bits, fan):
    """Chunks of 1, 8 and 1,024 rows, with trees of several levels; dates as order, a null word, a part of one row."""
    monkeypatch.setattr(ranges, "scan", lambda *a, _scan=ranges.scan, **k: _scan(*a, **k, fan=fan))
    rnd = random.Random(bits)
    day = datetime.date(2020, 1, 1)
    rows = [("long", day + datetime.timedelta(i), rnd.choice([None, "arbo", "agro", "bela", "ceno", "cano", "oblo", "una", "nuda", "Hado"])) for i in range(60 if bits == 0 else 700)]
    rows += [("one", day, "lone"), (None, day, "xa"), (None, day + datetime.timedelta(1), "wa")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "p string, d date, w string").repartition(3)
    pairs = (("c", "o"), ("n", "u"), ("b", "h"), ("a", "o"))
    got = {(r.p, r.d): r.chosen for r in order.viterbi(df, "p", "d", "w", pairs, cap=20, bits=bits).collect()}
    swap = {}
    for a, b in pairs:
        swap.setdefault(a, set()).add(b)
        swap.setdefault(b, set()).add(a)
    for p in ("long", "one", None):
        mine = sorted((r for r in rows if r[0] == p), key=lambda r: r[1])
        assert [got[p, d] for _, d, _ in mine] == sequential([w for _, _, w in mine], swap, 20, order.BREAK_COST)


def test_short_parts_go_by_chunks(spark, monkeypatch):
    """Each part went through six groups of its own, however short; now those of a chunk are solved in one call, and nothing is scanned for them."""
    def never(*args, **more):
        raise AssertionError("scanned")

    rnd = random.Random(8)
    rows = [(rnd.choice([0.5, 1.5, float("nan"), None]), i, rnd.choice(["abel", "acel", "bo", "ba", "cab", "", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "p double, o int, w string").coalesce(1)
    monkeypatch.setattr(ranges, "scan", never)
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *by: self.coalesce(1))
    got = {r.o: r.chosen for r in order.viterbi(df, "p", "o", "w", (("a", "c"), ("b", "d")), cap=20).collect()}
    swap = {"a": {"c"}, "c": {"a"}, "b": {"d"}, "d": {"b"}}
    for p in ("0.5", "1.5", "nan", "None"):
        mine = [(o, w) for q, o, w in rows if str(q) == p]
        assert [got[o] for o, _ in mine] == sequential([w for _, w in mine], swap, 20, order.BREAK_COST)


def test_whole_table_as_one_part(spark, sf):
    """Names of all parts as one sequence, which lies in several ranges."""
    part = spark.read.parquet(f"{sf}/part.parquet").select(F.lit("all").alias("p"), "p_partkey", "p_name")
    got = [r.chosen for r in order.viterbi(part, "p", "p_partkey", "p_name", lexicon.CONFUSABLE, bits=4).orderBy("p_partkey").collect()]
    swap = {}
    for a, b in lexicon.CONFUSABLE:
        swap.setdefault(a, set()).add(b)
        swap.setdefault(b, set()).add(a)
    assert got == sequential([r.p_name for r in part.orderBy("p_partkey").collect()], swap, 48, order.BREAK_COST)


def test_places_follow_the_order(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice([None, *map(str, range(40))]), i) for i in range(500)]
    got = ranges.numbered(spark.createDataFrame(rows, "p string, k string, i int"), ["p"], ["k"]).orderBy("_place").collect()
    assert len({r._place for r in got}) == 500
    keys = [(r.p, r.k is not None, r.k or "") for r in got]
    assert keys == sorted(keys)


def test_sequences_over_strings_and_timestamps(spark):
    """Running sums, last values and neighbours by a timestamp and a string with ties, in chunks of four rows."""
    rnd = random.Random(3)
    t0 = datetime.datetime(2024, 1, 1)
    rows = [("a" if rnd.random() < 0.8 else "b", t0 + datetime.timedelta(microseconds=rnd.randrange(10**12)), rnd.choice("xyz"), rnd.randrange(100), rnd.choice([None, 1, 2])) for _ in range(300)]
    df = spark.createDataFrame(rows, "p string, t timestamp, s string, v int, o int")
    d = ranges.numbered(df, ["p"], ["t", "s"])
    d = sequence.running_sum(d, "p", "_place", F.col("v"), "total", size=4)
    d = sequence.running_last(d, "p", "_place", F.col("o"), "last", size=4)
    d = sequence.neighbours(d, "p", "_place", ["v"], 2, 1, size=4)
    got = d.orderBy("p", "_place").collect()
    at = 0
    for p in "ab":
        mine, total, last = sorted((r for r in rows if r[0] == p), key=lambda r: (r[1], r[2])), 0, None
        for i, r in enumerate(mine):
            g, at = got[at], at + 1
            total, last = total + r[3], r[4] if r[4] is not None else last
            assert (g.t, g.total, g["last"]) == (r[1], total, last)
            assert [x.v for x in g._before] == [x[3] for x in mine[max(0, i - 2) : i]][::-1] and [x.v for x in g._after] == [x[3] for x in mine[i + 1 : i + 2]]
