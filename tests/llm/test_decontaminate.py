import re

import numpy as np

from glossweave.llm import decontaminate


def plain(x):
    return " ".join(re.findall(r"[^\W_]+", x.lower()))


def test_lcs():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        a, b = rnd.integers(0, 5, 30).tolist(), rnd.integers(0, 5, 40).tolist()
        t = np.zeros((31, 41), int)
        for i in range(30):
            for j in range(40):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert decontaminate.lcs(a, b) == t[30, 40]


def test_finds_every_exact_and_edited_leak(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # Leaks with one word in eight replaced, within other prose.
    edited = []
    for n, (i, text) in enumerate(sorted(items.items())[:20]):
        ws = text.split()
        for k in range(3, len(ws), 8):
            ws[k] = "changed"
        edited.append((10_000 + n, " ".join(rows[n][1].split()[:60] + ws + rows[n + 1][1].split()[:60])))
    df = spark.createDataFrame(rows + edited + [(20_000, None), (20_001, ""), (None, items[0])], "doc_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.search(df, bench).collect()}
    exact = {(d, i) for d, t in rows for i, x in items.items() if f" {plain(x)} " in f" {plain(t)} "}
    assert exact <= hits and (None, 0) in hits
    found = {d for d, _ in hits}
    assert {d for d, _ in edited} <= found and not {20_000, 20_001} & found
    assert len(hits - exact) <= len(edited) + 3
    kept = decontaminate.clean(df.withColumn("item_id", df.doc_id), bench)
    assert kept.columns == ["doc_id", "text", "item_id"] and kept.count() == df.count() - len(found)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.search(docs, bench).count() == 0 and decontaminate.clean(docs, bench).count() == 1
    assert decontaminate.search(docs.limit(0), spark.createDataFrame([(1, "a b c d"), (2, None)], "item_id long, text string")).count() == 0


def brute(docs, items, least, answer):
    """Pairs for which some window of a quarter more words than the item has holds enough of the item in order."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d, t in docs:
        ws = words(t)
        for i, x in items:
            own, last = words(x), words(decontaminate.last_sentence(x or ""))
            for s in range(0, max(1, len(ws))):
                window = ws[s : s + len(own) + max(2, len(own) // 4)]
                share = decontaminate.lcs(own, window) / len(own) if own else 0
                if own and (share >= least or (share >= 0.6 and last and decontaminate.lcs(last, window) / len(last) >= answer)):
                    out.add((d, i))
                    break
    return out


def test_equals_brute_force(spark):
    """Items of rare words, of common ones and of both, verbatim, with words replaced and with words put in; clean texts beside them."""
    rnd = np.random.default_rng(3)
    rare = [f"w{i}" for i in range(4000)]
    common = ["the", "of", "and", "to", "in"]
    say = lambda k: [str(rnd.choice(rare)) if rnd.random() < 0.7 else str(rnd.choice(common)) for _ in range(k)]
    items = [(i, " ".join(say(24)) + ". " + " ".join(say(6)) + ".") for i in range(12)]
    items += [(50, "the of and to in the and of in to the in of to and"), (51, "of the of the to to and in of the w1"), (52, None), (53, "")]
    docs = []
    for n in range(90):
        ws = say(int(rnd.integers(5, 120))) + common
        if n % 2:
            own = items[int(rnd.integers(0, 14))][1].replace(".", "").split()
            kind = n % 3
            if kind == 1:
                own = [w if rnd.random() > 0.1 else "changed" for w in own]
            if kind == 2:
                own = own[:7] + ["put"] + own[7:]
            at = int(rnd.integers(0, len(ws)))
            ws = ws[:at] + own + ws[at:]
        docs.append((n, " ".join(ws)))
    docs += [(900, None), (901, "")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.search(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items, 0.8, 0.9)


def test_item_that_stands_everywhere(spark):
    """A leak in every document has no rare word at all, and is found in every one."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [(i, f"doc{i} some words before {item} and some after doc{i}") for i in range(50)] + [(99, "alpha beta gamma only")]
    rows = decontaminate.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(50)) and {r.item_id for r in rows} == {7} and min(r.lcs for r in rows) == 1.0


def test_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(30))
    text = "word other " * 150_000 + item + " tail" * 1000
    rows = decontaminate.search(spark.createDataFrame([(1, text), (2, "word other " * 50)], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.lcs) for r in rows] == [(1, 1, 1.0)]


def test_axes_come_from_all_documents(spark):
    """The axes are those of the singular value decomposition of every document's passages and the items; a sample of 600 documents gave others."""
    rnd = np.random.default_rng(4)
    names = [f"w{i}" for i in range(40)]
    lexicon = decontaminate.Lexicon(np.concatenate(decontaminate.Tokens().of(names)))
    code = {w: int(lexicon(decontaminate.Tokens().of([w])[0])[0]) for w in names}
    texts = [" ".join(rnd.choice(names[10 * (k % 4) : 10 * (k % 4) + 10], 30 + 100 * (k % 2), p=np.arange(1, 11) / 55)) + " unknown" for k in range(1500)] + ["", None, "unknown"]
    items = [np.array([code["w0"], code["w11"]], np.int32), np.zeros(0, np.int32)]
    idf = np.linspace(0.5, 2, 40).astype(np.float32)
    rows = [ws[i : i + 64] for t in texts for ws in [(t or "").split()] for i in range(0, len(ws), 64)]
    rows = [[code[w] for w in r if w in code] for r in rows]
    x = np.array([np.bincount(r, minlength=40) * idf for r in rows if r])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    own = np.bincount(items[0], minlength=40) * idf
    own /= np.linalg.norm(own)
    gram = min(1, decontaminate.BALANCE * 9 / len(x)) * x.T @ x + 9 * np.outer(own, own)
    want = np.linalg.eigh(gram)[1][:, ::-1][:, :4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = decontaminate.latent(docs, lexicon, idf, items, 4)
    assert got.shape == (40, 4) and np.abs((got * want).sum(axis=0)).min() > 0.9999
