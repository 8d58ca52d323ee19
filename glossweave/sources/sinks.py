"""Writers: JSON lines, flat tables, one file a key, Markdown, notes and cards."""

from __future__ import annotations

import json
import sqlite3

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ranges, sequence


def write_jsonl(df: DataFrame, path: str, without: tuple[str, ...] = ()) -> None:
    """Records as JSON lines, empty fields left out."""
    df.drop(*without).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def flat(df: DataFrame, scalars: list[str], arrays: dict[str, str]) -> DataFrame:
    """One string column a field: line ends to blanks, arrays joined by their separators."""
    one = lambda c: F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\\r\\n\\t]+", " ")
    return df.select(*(one(F.col(c)).alias(c) for c in scalars), *(one(F.array_join(F.coalesce(c, F.array().cast("array<string>")), sep)).alias(c) for c, sep in arrays.items()))


def write_tsv(df: DataFrame, path: str, scalars: list[str], arrays: dict[str, str]) -> None:
    flat(df, scalars, arrays).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "\u0000").csv(path)


def markdown(head: Column, note: Column, body: Column, tail: Column) -> Column:
    return F.concat(F.lit("## "), head, F.coalesce(F.concat(F.lit(" *("), note, F.lit(")*")), F.lit("")), F.lit("\n"), body, F.coalesce(F.concat(F.lit("\n<!-- "), tail, F.lit(" -->")), F.lit("")))


def per_key(df: DataFrame, key: Column, order: str, text: Column, sep: str = "\n\n---\n\n") -> DataFrame:
    """(key, text, n): the texts of a key in order, joined; n over 1 marks a shared key."""
    g = df.select(key.alias("key"), F.struct(F.col(order).alias("o"), text.alias("t")).alias("s")).groupBy("key").agg(F.array_sort(F.collect_list("s")).alias("s"), F.count("*").alias("n"))
    return g.select("key", F.array_join(F.transform("s", lambda s: s["t"]), sep).alias("text"), "n")


def write_per_key(df: DataFrame, path: str) -> None:
    """(key, text) as one folder a key, written by the executors; what was there before goes."""
    df.select("key", "text").write.mode("overwrite").partitionBy("key").text(path)


def write_batches(df: DataFrame, path: str, part: str, order: list[str], size: int, text: Column) -> None:
    """Text files of so many rows each, by part and batch. Rows get their places by a sort over the cluster, so a part may be of any size."""
    placed = sequence.batches(ranges.numbered(df.withColumn("_text", text), [part], order), part, "_place", size)
    placed.select(part, F.col("batch").cast("int").alias("batch"), F.col("_text").alias("text")).write.mode("overwrite").partitionBy(part, "batch").text(path)


def enclosed(df: DataFrame, order: list[str], text: Column, first: str, last: str, between: str = ",") -> DataFrame:
    """(value): the lines of one document in order: first, a line for each row with between behind all but the last, and last. Sorted over all tasks, so the
    parts that a text writer makes of it, one after the other, are the document."""
    key = F.struct(*order)
    end = df.agg(F.max(key).alias("_end"))  # one row
    rows = df.crossJoin(F.broadcast(end)).select(F.lit(1).alias("_part"), key.alias("_key"), F.concat(text, F.when(key == F.col("_end"), "").otherwise(between)).alias("value"))
    edges = df.sparkSession.createDataFrame([(0, first), (2, last)], "_part int, value string").select("_part", F.lit(None).cast(rows.schema["_key"].dataType).alias("_key"), "value")
    return rows.unionByName(edges).orderBy("_part", "_key").select("value")


def json_array(df: DataFrame, order: list[str]) -> DataFrame:
    """(value): the lines of a JSON array of the records, empty fields left out. order tells all rows apart."""
    return enclosed(df, order, F.to_json(F.struct(*df.columns)), "[", "]")


def html_lines(df: DataFrame, order: list[str], template: str) -> DataFrame:
    """(value): the lines of a page with the records as a JSON array in place of %DATA% and their number in place of %COUNT%, made by the executors."""
    before, after = template.replace("%COUNT%", str(df.count())).split("%DATA%", 1)
    return enclosed(df, order, F.to_json(F.struct(*df.columns)), before + "[", "]" + after)


def html_page(df: DataFrame, order: list[str], template: str) -> str:
    """The page of html_lines() as one string, for editions that a browser, and so a driver, can hold."""
    rows = [r[0] for r in html_lines(df, order, template).toLocalIterator()]
    return rows[0] + "\n".join(rows[1:-1]) + rows[-1]


def entry(head: Column, note: Column, senses: Column, remarks: Column, latin: Column, symbol: Column, place: Column, quoted: Column | None = None) -> Column:
    """An article in Markdown: headword with its domain, senses numbered if there are several, remarks behind a dash, scientific names, symbol, place."""
    none = F.array().cast("array<string>")
    named = F.concat(F.lit("« "), head, F.lit(" »")) if quoted is None else F.when(F.coalesce(quoted, F.lit(False)), F.concat(F.lit("« "), head, F.lit(" »"))).otherwise(head)
    every = F.coalesce(senses, none)
    body = F.transform(every, lambda s, i: F.concat(F.when(F.size(every) > 1, F.concat((i + 1).cast("string"), F.lit(". "))).otherwise(""), s))
    parts = F.concat(
        F.array(F.concat(F.lit("## "), named, F.coalesce(F.concat(F.lit(" *("), note, F.lit(")*")), F.lit("")))), body, F.transform(F.coalesce(remarks, none), lambda r: F.concat(F.lit("— "), r)),
        F.when(F.size(F.coalesce(latin, none)) > 0, F.array(F.concat(F.lit("L. "), F.array_join(latin, "; ")))).otherwise(none),
        F.when(symbol.isNotNull(), F.array(F.concat(F.lit("*Simb. kem.* **"), symbol, F.lit("**")))).otherwise(none), F.array(F.concat(F.lit("<!-- "), place, F.lit(" -->"))))
    return F.array_join(parts, "\n")


def book(df: DataFrame, order: list[str], text: Column, title: str) -> DataFrame:
    """(value): one Markdown book of all articles in order, a blank line after each."""
    return enclosed(df, order, F.concat(text, F.lit("\n")), f"# {title}\n", "---", "")


def address_index(df: DataFrame, head: str, order: str) -> DataFrame:
    """(slug, line, n): a line for each address, with the headwords it holds where they differ from it; n over 1 marks a shared one."""
    g = df.select(T.slug(F.col(head)).alias("slug"), F.struct(F.col(order).alias("o"), F.col(head).alias("v")).alias("s")).groupBy("slug").agg(F.array_sort(F.collect_list("s")).alias("s"), F.count("*").alias("n"))
    words = F.array_join(F.transform("s", lambda x: x["v"]), ", ")
    line = F.concat(F.lit("- ["), "slug", F.lit("]("), "slug", F.lit(".md)"), F.when(words == F.col("slug"), "").otherwise(F.concat(F.lit(" — "), words)))
    return g.select("slug", line.alias("line"), "n")


def field_lines(index: DataFrame, floor: int = 5) -> DataFrame:
    """(part, place, line) of a table of fields from an inverted index (key, items, n): those of floor items or more by descending number, then name; the rest
    by name. place orders the lines of a part."""
    line = F.concat(F.lit("**"), "key", F.lit("** ("), F.col("n").cast("string"), F.lit(") — "), F.array_join("items", ", "))
    big = F.col("n") >= floor
    return index.select(F.when(big, 0).otherwise(1).alias("part"), F.struct(F.when(big, -F.col("n")).otherwise(F.lit(0)).alias("n"), "key").alias("place"), line.alias("line"))


def verb_lines(verbs: DataFrame, head: str, kinds: str, governs: str) -> DataFrame:
    """(head, line) of a table of verbs: kinds is a map of sense to kind, governs an array; several kinds are told by sense."""
    pairs = F.array_sort(F.map_entries(F.col(kinds)))
    several = F.size(F.array_distinct(F.map_values(F.col(kinds)))) > 1
    said = F.when(several, F.array_join(F.transform(pairs, lambda e: F.concat(e["value"], F.lit(" (senco "), e["key"].cast("string"), F.lit(")"))), ", ")).otherwise(F.array_join(F.array_distinct(F.map_values(F.col(kinds))), ", "))
    ruled = F.when(F.size(governs) > 0, F.concat(F.lit(" — "), F.array_join(governs, "; "))).otherwise("")
    return verbs.select(head, F.concat(F.col(head), F.lit(" — "), said, ruled).alias("line"))


def verb_counts(verbs: DataFrame, kinds: str, governs: str) -> DataFrame:
    """(name, n): how many verbs there are of each class, several kinds being a class of their own, and how many govern something. kinds is a map of sense to
    kind, governs an array."""
    every = F.array_sort(F.array_distinct(F.map_values(F.col(kinds))))
    name = F.when(F.size(every) > 1, "by sense").when(F.size(every) == 1, F.element_at(every, 1)).otherwise("none")
    rows = verbs.select(F.explode(F.array_compact(F.array(name, F.when(F.size(governs) > 0, "governing"), F.lit("verbs")))).alias("name"))
    return rows.groupBy("name").agg(F.count("*").alias("n"))


def preposition_lines(verbs: DataFrame, head: str, governs: str) -> DataFrame:
    """(preposition, n, line): an index of prepositions with the verbs that govern through them, by name."""
    words = F.flatten(F.transform(F.coalesce(F.col(governs), F.array().cast("array<string>")), lambda g: F.split(F.lower(g), "[^a-z]+")))
    found = F.array_intersect(words, F.array(*(F.lit(p) for p in T.PREPOSITIONS)))
    each = verbs.select(F.explode(found).alias("preposition"), head).groupBy("preposition").agg(F.array_sort(F.collect_set(head)).alias("heads"))
    n = F.size("heads")
    return each.select("preposition", n.cast("long").alias("n"), F.concat(F.lit("**"), "preposition", F.lit("** ("), n.cast("string"), F.lit(") — "), F.array_join("heads", ", ")).alias("line"))


def report(df: DataFrame, title: str, columns: list[str], order: list[str]) -> DataFrame:
    """(value): a Markdown report: title, number of rows, and a table of them in order; marks of tables inside values are escaped."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns)), F.lit(" |"))
    head = f"# {title}\n\n{df.count()} cases.\n\n| {' | '.join(columns)} |\n|{'---|' * len(columns)}"
    return enclosed(df, order, cells, head, "", "")


def write_log(old: DataFrame, new: DataFrame, path: str, keys: list[str], columns: list[str]) -> None:
    """A correction layer: what new rewrites goes from old, and both are written as tab-separated rows. path must not be what old is read from."""
    both = old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
    both.select(*(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\\r\\n\\t]+", " ").alias(c) for c in columns)).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "\u0000").csv(path)


def word_list(df: DataFrame, head: str, senses: str) -> DataFrame:
    """(head, sense): each headword with its first sense that isn't empty."""
    return df.select(head, F.try_element_at(F.filter(senses, lambda s: F.trim(s) != ""), F.lit(1)).alias("sense"))


def notes(df: DataFrame, head: str, order: str, deck: str, tags: Column, fields: list[Column]) -> DataFrame:
    """(guid, slug, rank, tags, fields, csum): rank tells apart records that share an address, in order."""
    s = df.withColumn("slug", T.slug(F.col(head)))
    s = s.withColumn("rank", F.row_number().over(Window.partitionBy("slug").orderBy(order)))
    guid = T.guid(F.concat_ws("\x1f", F.lit(deck), "slug", F.col("rank").cast("string")))
    return s.select(guid.alias("guid"), "slug", "rank", tags.alias("tags"), F.array_join(F.array(*fields), "\x1f").alias("fields"), T.csum(fields[0]).alias("csum"))


def cards(note: DataFrame, reverse: Column) -> DataFrame:
    """(guid, ord): a card each, and a second one where reverse holds."""
    return note.select("guid", F.explode(F.when(reverse, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("ord"))


# The tables and indexes of a deck, as readers of decks expect them.
DECK_TABLES = {
    "col": "id integer primary key, crt integer not null, mod integer not null, scm integer not null, ver integer not null, dty integer not null, usn integer not null, ls integer not null, conf text not null, models text not null, decks text not null, dconf text not null, tags text not null",
    "notes": "id integer primary key, guid text not null, mid integer not null, mod integer not null, usn integer not null, tags text not null, flds text not null, sfld integer not null, csum integer not null, flags integer not null, data text not null",
    "cards": "id integer primary key, nid integer not null, did integer not null, ord integer not null, mod integer not null, usn integer not null, type integer not null, queue integer not null, due integer not null, ivl integer not null, factor integer not null, reps integer not null, lapses integer not null, left integer not null, odue integer not null, odid integer not null, flags integer not null, data text not null",
    "revlog": "id integer primary key, cid integer not null, usn integer not null, ease integer not null, ivl integer not null, lastIvl integer not null, factor integer not null, time integer not null, type integer not null",
    "graves": "usn integer not null, oid integer not null, type integer not null",
}
DECK_INDEXES = {
    "ix_notes_usn": "notes (usn)", "ix_cards_usn": "cards (usn)", "ix_revlog_usn": "revlog (usn)", "ix_cards_nid": "cards (nid)", "ix_cards_sched": "cards (did, queue, due)",
    "ix_revlog_cid": "revlog (cid)", "ix_notes_csum": "notes (csum)",
}


def write_sqlite(note: DataFrame, card: DataFrame, path: str, stamp: int = 0, deck: int = 1, model: int = 1, conf: dict | None = None) -> None:
    """Notes and cards as a deck's five tables and seven indexes, with fixed times and ordered rows, so equal input gives equal bytes. Cards come up in the
    order of their notes. One file is written by one process: the driver, row by row; what it holds at a time is a partition."""
    con = sqlite3.connect(path)
    con.execute("pragma page_size = 4096")
    for name, columns in DECK_TABLES.items():
        con.execute(f"create table {name} ({columns})")
    for name, on in DECK_INDEXES.items():
        con.execute(f"create index {name} on {on}")
    said = json.dumps(conf or {}, ensure_ascii=False, sort_keys=True)
    con.execute("insert into col values (1, ?, ?, ?, 11, 0, 0, 0, ?, ?, ?, ?, '{}')", (stamp, stamp, stamp, said, json.dumps({str(model): {}}), json.dumps({str(deck): {}}), "{}"))
    ordered = card.select("guid", "ord").join(note.select("guid", "slug", "rank"), "guid").groupBy("guid", "slug", "rank").agg(F.array_sort(F.collect_set("ord")).alias("ords"))
    rows = note.join(ordered.select("guid", "ords"), "guid", "left").orderBy("slug", "rank", "guid")
    made = 0
    for i, r in enumerate(rows.toLocalIterator(), 1):
        tags = r["tags"] if isinstance(r["tags"], list) else ([r["tags"]] if r["tags"] else [])
        con.execute("insert into notes values (?, ?, ?, ?, -1, ?, ?, ?, ?, 0, '')", (i, r["guid"], model, stamp, f" {' '.join(tags)} " if tags else "", r["fields"], r["fields"].split("\x1f")[0], r["csum"]))
        for o in r["ords"] or []:
            made += 1
            con.execute("insert into cards values (?, ?, ?, ?, ?, -1, 0, 0, ?, 0, 0, 0, 0, 0, 0, 0, 0, '')", (made, i, deck, o, stamp, i))
    con.commit()
    con.close()
