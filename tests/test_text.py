import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossweave.functions import text as T
from glossweave.functions import udfs
from glossweave.operators import parentheticals as P


def one(spark, values, column):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(column).collect()]


def test_slug_and_keys(spark):
    v = F.col("v")
    heads = ["ampère", "a(d)", "*golfo", "«brokoli»-kaulo", "-an-", "ah!", "a posteriori", None]
    assert one(spark, heads, T.slug(v)) == ["ampere", "ad", "golfo", "brokoli-kaulo", "-an-", "ah", "a-posteriori", None]
    assert one(spark, heads, T.order_key(v)) == ["ampere", "a(d)", "golfo", "brokoli-kaulo", "an", "ah", "aposteriori", None]
    assert one(spark, ["venerala", "inventariar", "metalo", "amar", "o"], T.root_key(v)) == ["veneral", "inventari", "metal", "am", ""]
    assert one(spark, ["venerala", "metalo", "histerio"], T.stem_key(v)) == ["vener", "metal", "histeri"]
    assert one(spark, ["amar", "to", "ido"], T.strip_ending(v, min_left=2)) == ["am", "to", "id"]


def test_forms_tags_codes(spark):
    v = F.col("v")
    assert one(spark, ["a(d)", "*Golfo", "+x"], T.search_forms(v)) == [["a", "ad"], ["golfo"], ["x"]]
    assert one(spark, ["a b::c", "--", "x:::y"], T.tagify(v)) == ["a-b:c", "?", "x:y"]
    assert one(spark, ["SIRF", "II", "DEX", ""], T.read_code(v, T.CODE_ORDER)) == ["FIRS", None, None, None]
    assert one(spark, ["a, b...", "x ;.", "e c.", "e…"], T.trim_end(v)) == ["a, b...", "x", "e c.", "e…"]
    assert one(spark, ["H2O"], T.subscript_digits(v)) == ["H₂O"]
    assert one(spark, ["(a)(b", "x"], T.balance(v)) == [1, 0]


def test_decompose(spark):
    d = P.decompose(F.col("v"))
    got = one(spark, ["trans.", "trans., ad", "trans.) (kirurg.", "trans.) e (netrans., pri, per", "pri rejo", "", None, "e", "trans., e netrans."], d)
    assert [(r.kind, r.governments, r.notes) for r in got] == [
        ("transitive", [], []), ("transitive", ["ad"], []), ("transitive", [], ["kirurg."]), ("both", ["pri, per"], []), (None, [], ["pri rejo"]),
        (None, [], []), (None, [], []), (None, [], ["e"]), ("both", [], [])]


def python_guid(text):
    import hashlib

    n, out = int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big"), ""
    while n:
        n, d = divmod(n, 91)
        out = T.BASE91[d] + out
    return out


def test_hashes(spark):
    texts = [f"wordbook\x1f{x}\x1f1" for x in ("amo", "é", "", "libro")]
    assert one(spark, texts, T.guid(F.col("v"))) == [python_guid(t) for t in texts]


words = st.text(alphabet="abcé (),.;:-!*ÀŁß", max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(words, min_size=1, max_size=20))
def test_properties(spark, values):
    v = F.col("v")
    tidy = one(spark, values, T.tidy(v))
    assert one(spark, tidy, T.tidy(v)) == tidy
    slugs = one(spark, values, T.slug(v))
    assert one(spark, slugs, T.slug(v)) == slugs and all(re.fullmatch("[a-z0-9-]*", s) for s in slugs)
    assert one(spark, values, T.fold(v)) == ["".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn") for x in values]
    for x in map(udfs.repair, values):
        depth = 0
        for c in x:
            depth += {"(": 1, ")": -1}.get(c, 0)
            assert depth >= 0
        assert depth == 0 and udfs.repair(x) == x


@pytest.mark.parametrize("lines, want", [(["foro-", "tifiko"], "forotifiko"), (["a", "b"], "a b"), (["nord-", "sudo x"], "nord-sudo x"), (["X-", "Ray"], "X- Ray")])
def test_reglue(lines, want):
    assert udfs.reglue(lines, {"nord-sudo"}, {"foro"}) == want


def test_marks_and_leaders():
    import numpy as np

    assert udfs.mark("in the sea the end", ["the", "in the"]) == "*in the* sea *the* end"
    assert udfs.leaders(np.array([[1.0, 0], [0.99, 0.1], [0, 1], [0.1, 1]]), 0.9).tolist() == [0, 0, 1, 1]
