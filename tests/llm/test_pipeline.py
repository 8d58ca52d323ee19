import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import brute

import corpus_pipeline
from glossweave.llm import classify, decontaminate, mixing, secret_scan
from glossweave.llm.common import table


def test_run_equals_the_stages_in_plain_form(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs = table(spark, sf, "documents")
    good = {r.doc_id for r in classify.score_quality(docs, classify.fit_quality(docs, table(spark, sf, "labels"))).collect() if r.predicted}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    groups, _ = brute.similar([(d, r.text) for d, r in rows.items()])
    rows = {d: rows[d] for d, c in groups.items() if d == c}
    leaks = {r.doc_id for r in decontaminate.search(docs.where(docs.doc_id.isin(list(rows))), table(spark, sf, "benchmark")).collect()}
    rows = {d: r for d, r in rows.items() if d not in leaks}
    scanned = {r.doc_id: r for r in secret_scan.redact(spark.createDataFrame(list(rows.values()), docs.schema)).collect()}
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(list(scanned.values()), docs.schema)).collect()}
    assert {d: (r.text, r.n_chars, r.copies) for d, r in got.items()} == {d: (scanned[d].text, scanned[d].n_chars, c) for d, c in copies.items() if c}
    assert set(docs.columns) | {"copies"} == set(next(iter(got.values())).asDict())


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    first = docs.orderBy("doc_id").limit(3).collect()
    odd = [(None, "null id text that is long enough to count", "en", "src0", 41), (1_000_001, None, None, None, None), (1_000_002, "", "en", None, 0), (1_000_003, "x " * 60_000, "en", "src1", 120_000)]
    rows = [tuple(r) for r in first] + [tuple(first[0])] + odd
    df = spark.createDataFrame(rows, docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, sf)
        assert set(docs.columns) <= set(out.columns), name
        got = out.collect()
        assert len(got) <= len(rows)
        assert stage(spark, df.limit(0), sf).count() == 0
    kept = corpus_pipeline.near_copies(spark, df, sf).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({r.doc_id for r in first} | {1_000_001, 1_000_003}) and sum(r.doc_id is None for r in kept) == 1


def test_mix_shares_copies_among_rows_of_one_id(spark):
    """Repeated ids, null ids and a column named copies: what is taken is what mixing takes."""
    rows = [(1, "a b c", "s", 7)] * 5 + [(1, "d e", "s", 7), (None, "q r s t", "s", 7), (None, "q r s t", "t", 7), (2, "x", "t", 7)] + [(10 + i, "u v w", "t", 7) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = corpus_pipeline.mix(spark, df, "")
    assert out.columns == ["doc_id", "text", "source", "copies"]
    want = {}
    for r in mixing.mix(df).collect():
        want[r.doc_id, r["size"]] = want.get((r.doc_id, r["size"]), 0) + r.copies
    got = {}
    for r in out.collect():
        got[r.doc_id, len(r.text.split())] = got.get((r.doc_id, len(r.text.split())), 0) + r.copies
    assert got == {k: v for k, v in want.items() if v}


def test_rows_with_one_id_and_several_texts(spark):
    """A text is what is linked, not an id, whatever the partitioning."""
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    rows = [(5, a, None), (5, b, None), (5, a, None), (9, b.replace("b50", "c"), None), (None, a, None)]
    for parts in (1, 2, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, whole string").repartition(parts)
        assert sorted((r.doc_id or 0, r.text[:2]) for r in corpus_pipeline.near_copies(spark, df, "").collect()) == [(0, "a0"), (5, "a0"), (5, "b0")]
