"""Regluing, table functions, sketches, the page source: against plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from glossweave.functions import tabular
from glossweave.operators import regluing, sketches
from glossweave.plans import large, registry
from glossweave.sources import files, grid

L = "A-Za-zÀ-ÿ’'"


def plain_reglue(docs):
    """docs: lists of lines; with sets of what stands inside lines."""
    known = set()
    for lines in docs:
        for s in lines or []:
            known |= set(re.findall(f"[{L}]+(?:-[{L}]+)*", re.sub(f"[{L}-]+-$", " ", (s or "").strip(" ")).lower()))

    def attested(w):
        return w in known or any(w.endswith(e) and len(w) - len(e) >= 2 and w[: -len(e)] in known for e in regluing.ENDINGS)

    out = []
    for lines in docs:
        if lines is None:
            out.append(None)
            continue
        text, prev = "", None
        for s in (x.strip(" ") for x in lines):
            left = re.search(f"([{L}-]*[A-Za-zÀ-ÿ])-$", prev or "")
            right = re.match(f"[a-zà-ÿ][{L}]*", s)
            if left and right:
                a, b = left[1].lower(), right[0].lower()
                keep = f"{a}-{b}" in known or (not attested(a + b) and attested(a) and attested(b))
                text = (text if keep else text[:-1]) + s
            else:
                text += (" " if s else "") + s
            prev = s
        out.append(text.lstrip(" "))
    return out


@pytest.mark.parametrize("bits", [20, 6])
def test_regluing_equals_plain(spark, bits):
    rnd = random.Random(5)
    words = ["rivo", "lago", "lago-rivo", "fluar", "flu", "rezistar", "homo", "Korpo", "korpo", "l'aquo", "é", "ido"]
    docs = [None, [], [""], ["re-"], ["-", "a"], ["homo-", "korpo"], ["lago-", "rivo e", "rezis-", "tar"], ["  a ", "", "b-", "c"]]
    for _ in range(60):
        text = " ".join(rnd.choices(words, k=rnd.randint(1, 40)))
        docs.append(re.sub("([a-z]{2,3})([a-z]{2,})", lambda m: f"{m[1]}-\n{m[2]}" if rnd.random() < 0.3 else m[0], text).split("\n"))
    df = spark.createDataFrame(list(enumerate(docs)), "i int, lines array<string>").repartition(3)
    got = {r.i: r.text for r in regluing.reglue(df, "i", "lines", bits=bits).collect()}
    assert got == dict(enumerate(plain_reglue(docs)))


def test_reglued_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", large.broken_lines().alias("lines")).collect()
    got = {r.doc_id: r.text for r in registry.QUERIES["reglued_documents"](spark, sf).collect()}
    assert got == dict(zip([r.doc_id for r in docs], plain_reglue([r.lines for r in docs])))


def test_table_functions(spark):
    tabular.register(spark)
    rows = spark.sql("""select x.* from values (cast('f' as string), array('a (b) c', 'd'), array('(e)')), (null, null, null) a(fako, senci, noti), lateral parentheticals(a.fako, a.senci, a.noti) x""").collect()
    assert sorted(map(tuple, rows)) == [(0, "e"), (0, "f"), (1, "b")]
    votes = [("k", "x")] * 3 + [("k", "y")] * 3 + [("k", None)] * 9 + [("l", "z"), ("m", None)]
    spark.createDataFrame(votes, "key string, value string").repartition(3).createOrReplaceTempView("votes_here")
    got = spark.sql("select * from vote_final(table(select * from vote_partial(table(select key, value from votes_here))) partition by key)").collect()
    assert sorted(map(tuple, got)) == [("k", "x", 3, 6), ("l", "z", 1, 1)]
    held = tabular.VotePartial()
    assert list(held.eval(("a", "b"))) == [] and list(held.terminate()) == [("a", "b", 1)]


def test_sketches_merge_like_one(spark):
    """Merged days give what one sketch of all rows would, within the bounds; sets in common too."""
    df = spark.range(40_000).select((F.col("id") % 10).alias("d"), (F.col("id") * 7919 % 9000).alias("u"), (F.col("id") % 1000).cast("double").alias("v"))
    days = sketches.daily(df, F.col("d"), "u", "v")
    halves = sketches.merged(days, (F.col("day") % 2).cast("int"))
    exact = {r.p: r.n for r in df.groupBy((F.col("d") % 2).cast("int").alias("p")).agg(F.countDistinct("u").alias("n")).collect()}
    for r in sketches.read(halves).collect():
        assert r.n == 20_000 and abs(r.distinct - exact[r.period]) < 0.05 * exact[r.period] and abs(r.members - exact[r.period]) < 0.05 * exact[r.period]
        assert abs(r.q50 - 500) < 40 and abs(r.q99 - 990) < 20
    one = sketches.merged(days.where("day < 5"), F.lit(0))
    two = sketches.merged(days.where("day >= 5"), F.lit(0))
    both = len({i * 7919 % 9000 for i in range(40_000) if i % 10 < 5} & {i * 7919 % 9000 for i in range(40_000) if i % 10 >= 5})
    assert abs(sketches.shared(one, two).first().shared - both) <= max(20, 0.05 * both)


def page(n):
    return "\n".join(["\\begin{x}", f"\\l{{{n}}}", "\\l{}", f"\\l{{  \\sou{{vorto}}. texto {n} \\& plu}}", "\\end{x}"])


def test_page_source_reads_what_the_reader_reads(spark, tmp_path):
    grid.register(spark)
    for n in (3, 17, 18, 240):
        (tmp_path / f"p{n:03d}.tex").write_text(page(n), encoding="utf-8")
    (tmp_path / "_log").write_text("x")
    key = lambda rows: sorted((r.page, r.k, r.text, [(u.a, u.b) for u in r.underlines], r.ornament) for r in rows)
    want = key(files.read_pages(spark, str(tmp_path / "p*.tex")).collect())
    whole = spark.read.format("grid").option("partition_bytes", 100).load(str(tmp_path))
    assert key(whole.collect()) == want and whole.rdd.getNumPartitions() == 4
    some = whole.where("page >= 17 and page < 200 and k = 2")
    assert key(some.collect()) == [r for r in want if 17 <= r[0] < 200 and r[1] == 2]
    reader = grid.Reader(str(tmp_path), 100)
    assert list(reader.pushFilters([grid.GreaterThan(("page",), 17), grid.EqualTo(("k",), 2)])) == [grid.EqualTo(("k",), 2)] and len(reader.partitions()) == 2


def test_page_stream_reads_new_files(spark, tmp_path):
    grid.register(spark)
    pages, marks = tmp_path / "pages", str(tmp_path / "marks")
    pages.mkdir()
    (pages / "p001.tex").write_text(page(1), encoding="utf-8")

    def run():
        q = spark.readStream.format("grid").load(str(pages)).writeStream.format("parquet").option("checkpointLocation", marks).option("path", str(tmp_path / "out")).trigger(once=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted({r.page for r in spark.read.parquet(str(tmp_path / "out")).collect()})

    assert run() == [1]
    (pages / "p002.tex").write_text(page(2), encoding="utf-8")
    assert run() == [1, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_rare_word_sheets(spark, sf):
    """Against plain sets: which words are on which sheet, with which neighbours, and in which order."""
    from collections import Counter

    from glossweave.functions.text import ENDINGS
    from glossweave.operators import lexicon

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = {w for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in re.findall("[A-Za-z]{4,}", r.text)}
    freq, first = Counter(), {}
    for d in sorted(docs):
        for m in re.finditer("[A-Za-z]{4,}", docs[d]):
            freq[m[0]] += 1
            first.setdefault(m[0], (d, m.start()))
    attested = lambda w: w in known or any(w.endswith(e) and len(w) - len(e) >= 2 and w[: -len(e)] in known for e in ENDINGS)
    swap = {}
    for a, b in lexicon.CONFUSABLE:
        swap.setdefault(a, set()).add(b)
        swap.setdefault(b, set()).add(a)
    want = {}
    for w, n in freq.items():
        if n <= 2 and not attested(w):
            near = sorted({v for i, c in enumerate(w) for s in swap.get(c, ()) for v in [w[:i] + s + w[i + 1 :]] if attested(v)})[:4]
            d, at = first[w]
            a = max(0, at - 42)
            context = ("…" if a else "") + docs[d][a : a + 84] + ("…" if a + 84 < len(docs[d]) else "")
            if near or not (re.search(r"\bL[.]\s*[A-Za-z]", context, re.A) or w[0].isupper()):
                want[w] = (n, near or None, "neighbour" if near else "sense", context)
    got = registry.QUERIES["rare_word_sheets"](spark, sf).collect()
    assert {r.token: (r.n, r.neighbours, r.sheet, r.context) for r in got} == want
    for sheet in ("neighbour", "sense"):
        for c in {w[0] for w in want}:
            order = [r.token for r in sorted((r for r in got if r.sheet == sheet and r.token[0] == c), key=lambda r: r.place)]
            assert order == sorted(order, key=lambda w: (freq[w], w))


def test_sandwich_with_two_changes(spark):
    """Every row against all changes of one and two letters."""
    from glossweave.operators import order

    rnd = random.Random(12)
    words = ["".join(rnd.choice("abco") for _ in range(rnd.randint(1, 5))) for _ in range(120)]
    df = spark.createDataFrame([("p", i, w) for i, w in enumerate(words)], "p string, o long, w string")
    for most in (1, 2):
        want = {}
        for i in range(1, len(words) - 1):
            b, w, a = words[i - 1], words[i], words[i + 1]
            if b <= a and not b <= w <= a:
                ones = [w[:k] + s + w[k + 1 :] for k in range(len(w)) for s in "co"]
                twos = [w[:j] + s + w[j + 1 : k] + t + w[k + 1 :] for j in range(len(w)) for k in range(j + 1, len(w)) for s in "co" for t in "co"]
                good = [x for x in ones + (twos if most == 2 else []) if b <= x <= a and x != w]
                if good:
                    want[i] = good[0]
        got = {r.o: r.fixed for r in order.sandwich(df, "p", "o", "w", ("c", "o"), changes=most).collect()}
        assert got == want and want
