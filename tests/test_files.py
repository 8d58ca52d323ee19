import hashlib
import json
import time

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from glossweave import schema
from glossweave.operators import grammar, matching, order, overlay, records, search, sequence
from glossweave.sources import files, sinks
from glossweave.streaming import overlays

PAGE = r"""% page 1
\l{\cel{12}93}
\l{}
\l{\sou{amiko}. (\sou{soc.}) Ta qua amas; for-}
\l{\cel{3}tika. - DEFIS.}
\l{}
\l{\sou{«amen»}. I. Fino di prego. - II. Tale esez \& \textquotedbl{}yes\textquotedbl{} - L.}
"""


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_grid_to_records(spark, tmp_path):
    lines = files.read_pages(spark, put(tmp_path / "p017.tex", PAGE))
    rows = lines.orderBy("k").collect()
    assert {len(r.text) for r in rows} == {max(len(r.text) for r in rows)} and rows[0].text.strip() == "93" and rows[0].page == 17
    assert [(u.a, u.b) for u in rows[2].underlines] == [(0, 4), (8, 11)]
    parsed = grammar.parse(records.cut(lines)).orderBy("line").collect()
    assert [(r.vedetto, r.fako, r.senci, r.kodo, r.citita) for r in parsed] == [
        ("amiko", "soc.", ["Ta qua amas; fortika"], "DEFIS", False), ("amen", None, ["Fino di prego", 'Tale esez & "yes"'], "L", True)]
    assert parsed[0].lingui == ["Germana", "Angla", "Franca", "Italiana", "Hispana"] and parsed[1].drapeli == []
    sinks.write_jsonl(records.compact(grammar.parse(records.cut(lines))), str(tmp_path / "out"))
    back = files.read_records(spark, str(tmp_path / "out"), schema.COMPACT).orderBy("v").collect()
    assert [r.v for r in back] == ["amen", "amiko"] and back[1].f == "soc." and back[1].c is None


def test_overstrikes_and_nesting():
    assert files.parse_line(r"a\sur{\textasciicircum{}}{e}b") == ("aeb", [])
    assert files.parse_line(r"\cel{3}x\sou{ y z }") == ("   x y z ", [{"a": 5, "b": 7}])


def test_adopt(spark):
    rec = spark.createDataFrame([(1, 3, "Amo. Longa texto"), (2, 1, "Dek. Nombro - DEF.")], "page int, line int, text string")
    orphans = spark.createDataFrame([(2, "qua duras plu"), (3, "qua ne apartenas")], "page int, text string")
    assert sorted(r.text for r in records.adopt(rec, orphans).collect()) == ["Amo. Longa texto qua duras plu", "Dek. Nombro - DEF."]


def test_keyed_tables(spark, tmp_path):
    a = put(tmp_path / "a.txt", "# c\n1\t2\t3\tx\n\n1\t2\t4\t \n1\t-1\t0\t\"\n")
    b = put(tmp_path / "b.txt", "1\t2\t3\ty\nbad\t1\t1\tz\n")
    layers = files.read_corrections(spark, [a, b])
    assert {(r.line, r.col, r.content, r.layer) for r in layers.collect()} == {(2, 3, "x", 0), (2, 4, " ", 0), (-1, 0, '"', 0), (2, 3, "y", 1)}
    last = overlay.last_wins(layers, ["page", "line", "col"], "content", ["layer", "seq"])
    cells = spark.createDataFrame([(1, 2, 3, "o"), (1, 2, 2, "p")], "page int, line int, col int, content string")
    laid = overlay.lay_over(cells, last, ["page", "line", "col"], "content")
    assert {(r.line, r.col): (r.content, r.changed) for r in laid.collect()} == {(2, 3): ("y", True), (2, 2): ("p", False), (2, 4): (" ", True), (-1, 0): ('"', True)}
    assert {r.k: r.text for r in files.page_text(laid).collect()} == {2: "  py ", -1: '"'}
    keys = files.read_natural_keys(spark, put(tmp_path / "k.txt", "amo@17:-3\t>v\tn\n18:4\t{w}\nide@9:1\tz\n")).orderBy("image").collect()
    assert [(r.headword, r.image, r.line, r.value, r.note, r.kind) for r in keys] == [("ide", 9, 1, "z", None, "plain"), ("amo", 17, -3, "v", "n", "rendered"), (None, 18, 4, "w", None, "placed")]
    assert [tuple(r) for r in files.read_ranges(spark, put(tmp_path / "r.txt", "1\t2\t3-5,-1-7\n")).orderBy("a").collect()] == [(1, 2, -1, 7), (1, 2, 3, 5)]
    answers = files.read_answers(spark, put(tmp_path / "b1.txt", "1\tabc\tabd\n2\tx\tabc\tRIEN\n3\tlonga\to\n4\tw\tff\tfg\n5\tx\n"))
    assert {(r.id, r.faulty, r.correct) for r in answers.collect()} == {(1, "abc", "abd"), (4, "ff", "fg")}
    assert [(r.k, r.text) for r in files.read_numbered(spark, put(tmp_path / "n.txt", "== p\n-1|a|b\n2|c\n# end\n3|d\n")).orderBy("k").collect()] == [(-1, "a|b"), (2, "c")]


def test_embedded_json(spark):
    html = "<html><script>\nconst DATA = [{\"v\":\"amo\",\"p\":3}];\n</script>"
    df = spark.createDataFrame([(html,), ("<p>none",)], "html string")
    got = [r.DATA for r in files.embedded_json(df, "html", "DATA", ArrayType(schema.struct(v=schema.TEXT, p=schema.INT))).collect()]
    assert got[0][0].v == "amo" and got[1] is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Amo", 1, ["a\tb", "c"]), ("amo", 2, []), ("-an", 3, None)], "v string, o int, s array<string>")
    assert [tuple(r) for r in sinks.flat(df, ["v"], {"s": " ¶ "}).collect()] == [("Amo", "a b ¶ c"), ("amo", ""), ("-an", "")]
    n = sinks.notes(df, "v", "o", "deck", F.array(F.lit("t")), [F.col("v"), F.col("o").cast("string")])
    rows = n.orderBy("slug", "rank").collect()
    assert [(r.slug, r["rank"]) for r in rows] == [("-an", 1), ("amo", 1), ("amo", 2)] and len({r.guid for r in rows}) == 3
    c = sinks.cards(n, ~F.col("slug").startswith("-"))
    assert c.count() == 5
    for p in ("a.db", "b.db"):
        sinks.write_sqlite(n, c, str(tmp_path / p))
    assert hashlib.sha1((tmp_path / "a.db").read_bytes()).digest() == hashlib.sha1((tmp_path / "b.db").read_bytes()).digest()
    keyed = sinks.per_key(df, F.lower("v"), "o", F.col("v"))
    assert {r.key: (r.text, r.n) for r in keyed.collect()} == {"amo": ("Amo\n\n---\n\namo", 2), "-an": ("-an", 1)}
    sinks.write_per_key(keyed, str(tmp_path / "keys"))
    assert spark.read.text(str(tmp_path / "keys"), wholetext=True).count() == 2
    assert sinks.html_page(df.select("v", "o"), ["o"], "%COUNT%:%DATA%").startswith('3:[{"v":"Amo"')
    assert [r.sense for r in sinks.word_list(df.withColumn("s", F.coalesce("s", F.array(F.lit(" "), F.lit("x")))), "v", "s").collect()] == ["a\tb", None, "x"]


def test_search_ranks(spark):
    df = spark.createDataFrame([("libro",), ("libreto",), ("kalibro",), ("lobra",), ("zzz",)], "v string")
    ranks = {r.v: r["rank"] for r in search.search(df, " Libro ", F.array("v"), F.lit("tale libro"), ["v"], None).collect()}
    assert ranks == {"libro": 0, "kalibro": 2, "libreto": 4, "lobra": 4, "zzz": 5} or ranks["libro"] == 0
    assert search.search(df, "", F.array("v"), F.lit(""), ["v"]).count() == 5
    assert {r.v for r in search.search(df, "lib", F.array("v"), F.lit(""), ["v"]).collect()} == {"libro", "libreto", "kalibro"}


def test_ranges_votes_orders(spark):
    r = spark.createDataFrame([(1, 0, 2), (1, 3, 4), (1, 7, 8), (1, 1, 1), (2, 0, 0)], "g int, lo int, hi int")
    assert {(x.g, x.lo, x.hi, x.n) for x in sequence.coalesce_ranges(r, ["g"], "lo", "hi", 1).collect()} == {(1, 0, 4, 3), (1, 7, 8, 1), (2, 0, 0, 1)}
    met = matching.overlaps(r, r, "g", "lo", "hi", 3)
    assert met.count() == sum(a.g == b.g and a.lo <= b.hi and b.lo <= a.hi for a in r.collect() for b in r.collect())
    v = spark.createDataFrame([("k", x) for x in "bbaa"] + [("m", x) for x in "aaab"] + [("n", None)], "k string, v string")
    assert [tuple(x) for x in sequence.majority(v, ["k"], "v", 2, 0.5).orderBy("k").collect()] == [("k", "a", 2, 4), ("m", "a", 3, 4)]
    w = spark.createDataFrame([(1, 1, "abc"), (1, 2, "cbd"), (1, 3, "abe")], "p int, o int, w string")
    assert [x.chosen for x in order.viterbi(w, "p", "o", "w", (("a", "c"),)).orderBy("o").collect()] == ["abc", "abd", "abe"]


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "k int, v string, seq long, ts timestamp"
    for i, rows in enumerate(([(1, "a", 1), (2, "b", 2)], [(1, "c", 3), (3, "d", 4)])):
        spark.createDataFrame([(*r, None) for r in rows], kind).coalesce(1).write.mode("append").parquet(src)
        q = overlays.upsert_stream(spark.readStream.schema(kind).parquet(src), out, ["k"], "v", ["seq"], str(tmp_path / "cp"))
        q.awaitTermination(60)
        time.sleep(0.1)
    assert {r.k: r.v for r in overlays.current(spark, out).collect()} == {1: "c", 2: "b", 3: "d"}
    ev = spark.createDataFrame([(1, f"2024-01-0{d} 00:10:00") for d in (1, 1, 2)], "u int, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    ev.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    for name, df in (("win", overlays.windowed_counts(stream, "ts", ["u"])), ("ses", overlays.sessions(stream, "ts", ["u"]))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append" if name == "ses" else "update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(90)
    assert {r.n for r in spark.table("win").collect()} == {2, 1}


def test_ornaments_offsets_and_settled_text(spark, tmp_path):
    (tmp_path / "p007.tex").write_text("\\l{\\marge[2]{a{b}}{c}ab\\sou{cd}}\n\\l{x}\n")
    pages = files.read_pages(spark, str(tmp_path), spark.createDataFrame([(7, -1)], "page int, first int"))
    rows = {r.k: r for r in pages.collect()}
    assert set(rows) == {-1, 0} and rows[-1].ornament == "\\marge[2]{a{b}}{c}" and rows[-1].text == "abcd" and rows[0].text == "x   " and rows[0].ornament == ""
    fixed = files.settled_text(pages, spark.createDataFrame([(7, 1)], "page int, d int"), spark.createDataFrame([(7, 0, 4, "z"), (7, -1, 0, "B")], "page int, line int, col int, content string"))
    assert {r.k: r.text for r in fixed.collect()} == {-1: "Bcd", 0: "    z"}
    (tmp_path / "lost.txt").write_text("# head\n7\t3\tone\ttwo\n7\t3\tlast\nx\ty\tz\n")
    assert [(r.page, r.line, r.text) for r in files.read_positions(spark, str(tmp_path / "lost.txt")).collect()] == [(7, 3, "last")]


def test_embedded_json_is_decoded_to_its_own_end(spark):
    page = "<script>var DATA = [{\"a\": \"x]; }\", \"b\": [1, 2]}]; more = {}</script>"
    df = spark.createDataFrame([(page,), ("DATA = [broken",), ("none",), (None,)], "html string")
    got = [r.DATA for r in files.embedded_json(df, "html", "DATA", ArrayType(StructType.fromDDL("a string, b array<int>"))).collect()]
    assert [(x.a, x.b) for x in got[0]] == [("x]; }", [1, 2])] and got[1:] == [None, None, None]


def test_documents_of_lines(spark, tmp_path):
    df = spark.createDataFrame([(2, "b|c"), (1, "a"), (3, None)], "k int, v string")
    lines = [r.value for r in sinks.json_array(df, ["k"]).collect()]
    assert json.loads("\n".join(lines)) == [{"k": 1, "v": "a"}, {"k": 2, "v": "b|c"}, {"k": 3}]
    page = sinks.html_page(df, ["k"], "<p>%COUNT%</p><script>D=%DATA%;</script>")
    assert page.startswith("<p>3</p><script>D=[{") and page.endswith("}];</script>")
    assert [r.value for r in sinks.report(df, "Odd", ["k", "v"], ["k"]).collect()] == ["# Odd\n\n3 cases.\n\n| k | v |\n|---|---|", "| 1 | a |", "| 2 | b\\|c |", "| 3 |  |", ""]
    assert json.loads("".join(r.value for r in sinks.json_array(df.limit(0), ["k"]).collect())) == []
    verbs = spark.createDataFrame([("amar", {1: "transitiva"}, ["ad"]), ("irar", {1: "transitiva", 2: "amba"}, [])], "v string, k map<int,string>, g array<string>")
    assert [r.line for r in sinks.verb_lines(verbs, "v", "k", "g").collect()] == ["amar — transitiva — ad", "irar — transitiva (senco 1), amba (senco 2)"]
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z\tz")], "k int, v string")
    sinks.write_log(old, new, str(tmp_path / "log"), ["k"], ["k", "v"])
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "log")).collect() if x.value != "k\tv") == ["1\tx", "2\tz z"]


def test_deck_tables(spark, tmp_path):
    import sqlite3

    df = spark.createDataFrame([("amo", 1, "x"), ("Amo", 2, "y")], "v string, o int, t string")
    made = [str(tmp_path / f"{i}.db") for i in range(2)]
    for path in made:
        notes = sinks.notes(df, "v", "o", "deck", F.array(F.lit("tag")), [F.col("v"), F.col("t")])
        sinks.write_sqlite(notes, sinks.cards(notes, F.col("rank") == 1), path, 5)
    assert open(made[0], "rb").read() == open(made[1], "rb").read()
    con = sqlite3.connect(made[0])
    names = [r[0] for r in con.execute("select name from sqlite_master where name not like 'sqlite%' order by type desc, name")]
    assert set(sinks.DECK_TABLES) | set(sinks.DECK_INDEXES) == set(names)
    assert con.execute("select nid, ord, due from cards order by id").fetchall() == [(1, 0, 1), (1, 1, 1), (2, 0, 2)] and con.execute("select count(*) from notes").fetchone() == (2,)


def test_more_centres_than_a_block(spark):
    from glossweave.operators import matching

    rows = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(20)], "k int, v array<double>")
    centres = matching.centroids(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(7)], "l int, v array<double>"), "l", "v")
    one, many = ({tuple(r) for r in matching.nearest(rows, "k", "v", centres, "l", n).collect()} for n in (100, 2))
    assert one == many and len(one) == 20
