import hashlib
import math
import random
import re
import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import zlib
from collections import Counter

import numpy as np
import brute

from glossweave.llm import importance
from glossweave.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
OUT = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return ws, [" ".join(ws[i : i + k]) for k in (1, 2, 3) for i in range(len(ws) - k + 1)]


def plain(docs, target):
    """The contract, feature by feature."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for c, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            c.update(bucket(f) for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)}
    rows, able = [], []
    for d, x in docs:
        ws, fs = features(x)
        w = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(ws) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1], r[2]))
    for i, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    docs = brute.corpus(400)
    docs += [(9000, "ONE two, Three\x00é9 x" + "ab" * 90), (9001, "ü" * 3000 + " tail"), (9002, "a " * 5000)]
    target = ["one two three é9 x", None, "", docs[0][1], "the end"]
    monkeypatch.setattr(importance, "PART_BYTES", 3000)
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, n_words int, place string").repartition(3)
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    assert result(importance.resample(df, bench)) == plain(docs, target)


def test_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, sf)
    assert [f.dataType.simpleString() for f in got.schema if f.name in OUT] == ["bigint"] * 5
    assert result(got) == plain(docs, target)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert result(importance.resample(none, none)) == []
    one = spark.createDataFrame([(1, None), (2, "word " * 30)], "doc_id long, text string")
    assert result(importance.resample(one, none)) == plain([(1, None), (2, "word " * 30)], [])


def test_crc_of_joined_strings():
    rnd, crc = random.Random(4), importance.Crc()
    parts = [bytes(rnd.randrange(256) for _ in range(rnd.choice([1, 2, 5, 63, 64, 65, 700, 5000]))) for _ in range(200)]
    body = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    got = crc.of(body, ends - [len(p) for p in parts], ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    both = crc.behind(got[:-1], np.array([len(p) for p in parts[1:]])) ^ got[1:]
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_keys_survive_packing():
    rnd = np.random.default_rng(2)
    keys, n = np.unique(rnd.integers(0, 1 << 48, 500)), rnd.integers(1, 1 << 40, 500)
    for k in (0, 1, 500):
        back = importance.unpacked(importance.packed(keys[:k], n[:k]))
        assert (back[0] == keys[:k]).all() and (back[1] == n[:k]).all()


def test_windows_and_slices_do_not_matter(spark, monkeypatch):
    docs = [(d, t) for d, t in brute.corpus(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    want = {r.bucket: r.n for r in importance.bucket_counts(df).collect()}
    monkeypatch.setattr(importance, "PART_BYTES", 500)
    assert {r.bucket: r.n for r in importance.bucket_counts(df).collect()} == want == {k: v for k, v in plain_counts(docs).items() if v}


def plain_counts(docs):
    return Counter(zlib.crc32(f.encode()) % 10_000 for _, t in docs for f in features(t)[1])
