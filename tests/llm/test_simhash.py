import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import brute
import numpy as np
import pytest

from glossweave.llm import near, simhash
from glossweave.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, fp string, u int, root int"


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 20)
    docs = brute.corpus(200)
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(3)
    out = simhash.components(df, shingle=4)
    got = sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in out.collect()), key=str)
    assert got == brute.op6(docs)


def test_similar_sets(spark, monkeypatch):
    """The components are those of the sets compared one by one; copies of a text and near copies share a component."""
    monkeypatch.setattr(simhash, "LEAF", 20)
    docs = [d for d in brute.corpus(300, seed=8) if d[0] is not None]
    docs = list(dict(docs).items())
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs] + [(None, "stands alone", "x", 1, 2), (*docs[0], "x", 1, 2)], SCHEMA).repartition(3)
    want, pairs = brute.similar(docs)
    got = {r.doc_id: r.component_id for r in near.similar_components(df).collect()}
    assert len(pairs) > 30 and {d: c for d, c in got.items() if d is not None} == want
    kept = near.dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for c in got.values() if c is not None})


@pytest.mark.parametrize("small, each", [(24, 32), (1, 32), (1, 0)])
def test_exact_round_alone(spark, monkeypatch, small, each):
    """Without any candidate of the fingerprints the components are the same; so are they if all groups count as large, and if these meet in small cells."""
    monkeypatch.setattr(near, "RADIUS", -1)
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "EACH", each)
    monkeypatch.setattr(near, "BLOCK", 300)
    monkeypatch.setattr(near, "routed", lambda points, n, radius: simhash.routed(points, n, 4))
    docs = list(dict(d for d in brute.corpus(250, seed=11) if d[0] is not None).items())
    got = {r.doc_id: r.component_id for r in near.similar_components(spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(3)).collect()}
    assert got == brute.similar(docs)[0]


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted((tuple(r)[:3] for r in QUERIES["op6_simhash"](spark, sf).collect()), key=str)
    assert got == brute.op6([(r.doc_id, r.text) for r in docs])


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.components(df).count() == 0 and near.dedup(df).count() == 0


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_tree_search_is_exact(spark, monkeypatch, few):
    """Clusters and random points: the trees' links join exactly what brute force joins, by one task or by stars."""
    monkeypatch.setattr(simhash, "FEW_EDGES", few)
    monkeypatch.setattr(simhash, "LEAF", 30)
    rng = np.random.default_rng(1)
    points = [int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64) * 2]
    for p in points[:20]:
        for _ in range(20):
            q = p
            for b in rng.integers(0, 64, rng.integers(1, 7)):
                q ^= 1 << int(b)
            points.append(q)
    points = sorted(set(points))
    signed = [int(np.uint64(p).view(np.int64)) for p in points]
    got = simhash.stars(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), len(points), 4)).collect()
    root = dict(zip(signed, signed)) | {r.u: r.v for r in got}
    parent = np.arange(len(points))
    arr = np.array(points, np.uint64)
    a, b = np.nonzero(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 4)
    simhash.connect(parent, a, b)
    want = {}
    for s, p in zip(signed, parent):
        want.setdefault(int(p), set()).add(s)
    have = {}
    for s in signed:
        have.setdefault(root[s], set()).add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_components_of_chains_and_hubs(spark, monkeypatch):
    """Long chains, hubs, circles and repeated edges: stars find what one task finds."""
    rng = np.random.default_rng(8)
    edges = [(i + 1, i) for i in range(60)] + [(100 + i, 100) for i in range(1, 80)] + [(200 + (i + 1) % 9, 200 + i) for i in range(9)]
    edges += [(int(a), int(b)) for a, b in rng.integers(300, 420, (90, 2)) if a != b]
    edges = [(max(e), min(e)) for e in edges] + [(5, 4)] * 3
    df = spark.createDataFrame(edges, "u long, v long").repartition(3)
    one = sorted(map(tuple, simhash.stars(df).collect()))
    monkeypatch.setattr(simhash, "FEW_EDGES", 0)
    assert sorted(map(tuple, simhash.stars(df).collect())) == one and simhash.stars(df.limit(0)).count() == 0
    assert (60, 0) in one and (179, 100) in one and (208, 200) in one


def edits_of(rng, base, count, replaced):
    out = []
    for _ in range(count):
        words = list(base)
        for i in rng.choice(len(base), replaced, replace=False):
            words[i] = f"w{rng.integers(1 << 40)}"
        out.append(" ".join(words))
    return out


def test_edits_of_one_base(spark):
    """Edits with a similarity of 0.8 or more to their base, less to each other: all join it, in groups of 30 to 3,000."""
    rng, docs, groups = np.random.default_rng(3), [], []
    for count in (30, 100, 300, 3000):
        base = [f"w{x}" for x in rng.integers(1 << 40, size=200)]
        whole = shingles(base)
        texts = [" ".join(base)]
        for t in edits_of(rng, base, count, 4):
            x = shingles(t.split())
            both = len(x & whole)
            if both >= 0.8 * (len(x) + len(whole) - both):
                texts.append(t)
        assert len(texts) > 0.9 * count
        ids = [len(docs) + i for i in range(len(texts))]
        groups.append(ids)
        docs += [(i, t, "x", 1, 2) for i, t in zip(ids, texts)]
    got = {r.doc_id: r.component_id for r in near.similar_components(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()}
    for ids in groups:
        assert {got[i] for i in ids} == {ids[0]}


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(6)
    for _ in range(200):
        pool = rng.integers(1 << 62, size=400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        bound = near.share_at_most(*(near.sketch(x).astype(np.int64) for x in (a, b)))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_short_texts(spark):
    """One word appended to 8 to 30 words: similarity 0.8 or more, though the SimHashes of so few words are far apart. Every pair joins."""
    rng, docs = np.random.default_rng(4), []
    for words in (8, 10, 12, 15, 30):
        for _ in range(60):
            text = " ".join(f"w{x}" for x in rng.integers(1 << 40, size=words))
            docs += [(len(docs), text, "x", 1, 2), (len(docs) + 1, f"{text} more", "x", 1, 2)]
    got = {r.doc_id: r.component_id for r in near.similar_components(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()}
    assert got == {d[0]: d[0] // 2 * 2 for d in docs}
