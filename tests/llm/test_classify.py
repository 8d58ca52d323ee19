import zlib

import numpy as np

from glossweave.llm import classify
from glossweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def quality_of(spark, query, label, threshold):
    rows = {r.doc_id: r for r in QUERIES[query](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold)
    test = [(rows[x.doc_id].score, x[label]) for x in labels if rows[x.doc_id].held_out]
    up, down = np.array([s for s, y in test if y]), np.array([s for s, y in test if not y])
    return (up[:, None] > down[None, :]).mean()


def test_quality_on_held_out_rows(spark):
    assert quality_of(spark, "op4_quality_classifier", "quality", 0.5) > 0.95


def test_toxicity_on_held_out_rows(spark):
    assert quality_of(spark, "op5_toxicity", "toxic", 0.7) > 0.85


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(300)]
    y = np.array([1 if (r < 20).sum() >= 4 else -1 for r in rows])
    w, b = classify.dual_descent(rows, np.ones(50), y, 50, 10.0, epochs=60)
    assert np.mean([np.sign(w[r].sum() / np.sqrt(8) + b) == k for r, k in zip(rows, y)]) > 0.97


def test_identity_mentions_stay_neutral(spark):
    """In biased labels a group's name goes with insults; the penalty takes its weight away."""
    rng = np.random.default_rng(4)
    base = ["the", "sun", "rose", "over", "old", "town", "walls", "and", "birds", "sang", "people", "came"]
    docs, labels = [], []
    for i in range(900):
        ws = rng.choice(base, 12).tolist()
        toxic = i % 3 == 0
        if toxic and rng.random() < 0.6:
            ws.insert(3, "vilescum")
        if rng.random() < (0.8 if toxic else 0.05):
            ws.insert(5, "muslims")
        docs.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = spark.createDataFrame([(1, "the sun rose over muslims and birds"), (2, "vilescum came over old town"), (3, None), (None, "")], "doc_id long, text string")

    def scores(penalty):
        model = classify.fit_toxicity(df, lab, penalty=penalty)
        return {(r.doc_id, r.text): r.score for r in classify.score_toxicity(neutral, model).collect()}

    loose, fair = scores(0.0), scores(3.0)
    mention, insult = (1, "the sun rose over muslims and birds"), (2, "vilescum came over old town")
    assert fair[mention] < loose[mention] and fair[mention] < 0.5 < fair[insult] and len(fair) == 4


def test_degenerate_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fit, score in ((classify.fit_quality, classify.score_quality), (classify.fit_toxicity, classify.score_toxicity)):
        rows = score(docs, fit(docs, none)).collect()
        assert len(rows) == 2 and {r.score for r in rows} == {0.5}
        assert score(docs.limit(0), fit(docs.limit(0), none)).count() == 0
    assert classify.keep_quality(docs, classify.fit_quality(docs, none)).count() == 2


def test_query_with_identity_terms(spark, tmp_path):
    """The registered query on documents whose labels are biased against a group: neutral sentences that name it aren't called toxic, insults are."""
    rng = np.random.default_rng(9)
    base = ["the", "sun", "rose", "over", "old", "town", "walls", "and", "birds", "sang", "people", "came", "home", "late"]
    docs, labels = [], []
    for i in range(1500):
        ws = rng.choice(base, 12).tolist()
        toxic = i % 3 == 0
        if toxic:
            ws.insert(3, "vilescum")
        if rng.random() < (0.7 if toxic else 0.05):
            ws.insert(5, "muslims")
        docs.append((i, " ".join(ws) + ". The day ended.", "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    docs += [(5000 + i, f"the sun rose over muslims and {w} sang", "en", "s", 1) for i, w in enumerate(base)]
    docs += [(6000 + i, f"vilescum came over the old {w}", "en", "s", 1) for i, w in enumerate(base)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, str(tmp_path)).collect()}
    assert not any(r.predicted for d, r in rows.items() if 5000 <= d < 6000) and all(r.predicted for d, r in rows.items() if d >= 6000)
    pattern, other = classify.swaps()
    text = "people came. muslims sang late! the end"
    assert [a for a, _ in classify.counterfactuals(text, pattern, other)] == ["muslims sang late!"] * 2 and classify.counterfactuals("no such word", pattern, other) == []
