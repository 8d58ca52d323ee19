"""Readers: grid markup, keyed and natural-key tables, answer batches, numbered lines, records, values embedded in HTML."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from ..schema import RECORD, SPAN

# Escapes of the markup that stand for one cell.
ESCAPES = {"\\textquotedbl{}": '"', "\\textbackslash{}": "\\", "\\textasciicircum{}": "^", "\\textasciitilde{}": "~", "\\&": "&", "\\%": "%", "\\$": "$", "\\#": "#", "\\_": "_", "\\{": "{", "\\}": "}"}


def parse_line(body: str) -> tuple[str, list[dict]]:
    """Cells of one line of markup and its underlined ranges, ends inclusive.

    \\cel{n} is n blanks, \\sou{…} underlines a run, \\sur{a}{b} puts a over b in b's cell; a blank at either end of a run isn't underlined.
    """
    cells: list[str] = []
    spans: list[dict] = []

    def group(i: int) -> tuple[str, int]:
        depth, j = 0, i
        while j < len(body):
            if body[j] == "\\" and body[j + 1 : j + 2] in "{}":
                j += 2
                continue
            depth += {"{": 1, "}": -1}.get(body[j], 0)
            j += 1
            if not depth:
                break
        return body[i + 1 : j - 1], j

    i = 0
    while i < len(body):
        for name in ("\\cel", "\\sou", "\\sur"):
            if body.startswith(name + "{", i):
                arg, i = group(i + len(name))
                if name == "\\cel":
                    cells += [" "] * int(arg or 0)
                elif name == "\\sou":
                    inner, nested = parse_line(arg)
                    text = inner.strip(" ")
                    start = len(cells) + len(inner) - len(inner.lstrip(" "))
                    cells += inner
                    spans += [{"a": start, "b": start + len(text) - 1}] if text else []
                    spans += [{"a": s["a"] + start, "b": s["b"] + start} for s in nested]
                else:
                    over, i = group(i)
                    cells += (parse_line(over)[0] or parse_line(arg)[0] or " ")[:1]
                break
        else:
            for k, v in ESCAPES.items():
                if body.startswith(k, i):
                    cells.append(v)
                    i += len(k)
                    break
            else:
                if body[i] not in "{}":
                    cells.append(body[i])
                i += 1
    return "".join(cells), spans


def split_ornament(body: str) -> tuple[str, str]:
    """The margin commands at the head of a line, \\marge[…]{…}{…}, which take no cell, and what follows them."""
    at = 0
    while body.startswith("\\marge[", at):
        end = body.find("]", at) + 1
        for _ in range(2):
            depth = 0
            while end < len(body):
                if body[end] == "\\" and body[end + 1 : end + 2] in ("{", "}"):
                    end += 2
                    continue
                depth += {"{": 1, "}": -1}.get(body[end], 0)
                end += 1
                if not depth:
                    break
        at = end
    return body[:at], body[at:]


def read_pages(spark: SparkSession, path: str, first_lines: DataFrame | None = None) -> DataFrame:
    """(page, k, text, underlines, ornament) from files whose names hold the page number; lines are \\l{…}, padded to the widest of their page.

    first_lines: (page, first) where a page's lines don't start at 0; first may be negative."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), "([0-9]+)", 1).cast("int").alias("page"), "value")
    lines = whole.select("page", F.posexplode(F.filter(F.split("value", "\n"), lambda x: x.startswith("\\l{"))).alias("k", "raw"))

    def run(raw: pd.Series) -> pd.DataFrame:
        parts = [split_ornament(re.sub(r"\}\s*$", "", x[3:])) for x in raw]
        got = [parse_line(rest) for _, rest in parts]
        return pd.DataFrame({"text": [t for t, _ in got], "underlines": [s for _, s in got], "ornament": [o for o, _ in parts]})

    kind = StructType([StructField("text", StringType()), StructField("underlines", ArrayType(SPAN)), StructField("ornament", StringType())])
    parsed = lines.withColumn("p", F.pandas_udf(run, kind)("raw")).select("page", "k", "p.*")
    if first_lines is not None:
        parsed = parsed.join(first_lines.select("page", F.col("first").alias("_first")), "page", "left").withColumn("k", F.col("k") + F.coalesce("_first", F.lit(0))).drop("_first")
    widest = F.max(F.length("text")).over(Window.partitionBy("page"))
    return parsed.withColumn("w", widest).withColumn("text", F.rpad("text", F.greatest(F.col("w"), F.lit(1)), " ")).drop("w")


def page_text(cells: DataFrame) -> DataFrame:
    """(page, k, text) from cells (page, line, col, content); holes are blanks."""
    g = cells.groupBy("page", F.col("line").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("col", "content"))).alias("m"), F.max("col").alias("w"))
    return g.select("page", "k", F.array_join(F.transform(F.sequence(F.lit(0), F.col("w")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(" "))), "").alias("text"))


def settled_text(lines: DataFrame, shifts: DataFrame, repairs: DataFrame) -> DataFrame:
    """(page, k, text) of lines moved back by their page's shift (page, d) and mended by repairs (page, line, col, content), which may stand past the end;
    trailing blanks go."""
    cells = repairs.groupBy("page", F.col("line").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("col", "content"))).alias("_m"), F.max("col").alias("_w"))
    moved = lines.join(shifts.select("page", F.col("d").alias("_d")), "page", "left").withColumn("_t", F.expr("substring(text, coalesce(_d, 0) + 1)"))
    met = moved.join(cells, ["page", "k"], "left")
    wide = F.greatest(F.length("_t"), F.col("_w") + 1)
    mended = F.array_join(F.transform(F.sequence(F.lit(0), wide - 1), lambda i: F.coalesce(F.try_element_at("_m", i), F.nullif(F.substring(F.col("_t"), i + 1, F.lit(1)), F.lit("")), F.lit(" "))), "")
    return met.select("page", "k", F.regexp_replace(F.when(F.col("_m").isNull(), F.col("_t")).otherwise(mended), " +$", "").alias("text"))


def data_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are neither blank nor comments, with their file and their place in it."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("seq", "value"))
    return whole.where(~F.col("value").rlike("^\\s*(#|$)"))


def read_corrections(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(page, line, col, content, layer, seq): keyed tables, later paths being later layers. Content may be a blank or a quote, so no CSV reader."""
    layers = F.create_map(*(F.lit(x) for i, p in enumerate(paths) for x in (p.rsplit("/", 1)[-1], i)))
    f = F.split("value", "\t")
    lines = data_lines(spark, paths).where(F.size(f) >= 4)
    at = [F.element_at(f, i + 1).try_cast("int").alias(n) for i, n in enumerate(("page", "line", "col"))]
    return lines.select(*at, F.element_at(f, 4).alias("content"), F.element_at(layers, F.col("file")).alias("layer"), F.col("seq").cast("long").alias("seq")).where("page is not null and line is not null and col is not null")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(page, line, a, b) from rows page, line, "a-b,c-d"."""
    f = F.split("value", "\t")
    r = data_lines(spark, path).select(F.element_at(f, 1).try_cast("int").alias("page"), F.element_at(f, 2).try_cast("int").alias("line"), F.explode(F.split(F.element_at(f, 3), ",")).alias("r"))
    return r.select("page", "line", F.regexp_extract("r", "^(-?[0-9]+)", 1).cast("int").alias("a"), F.regexp_extract("r", "^-?[0-9]+-(-?[0-9]+)$", 1).cast("int").alias("b"))


def read_natural_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, headword, image, line, value, note, kind) from rows "headword@image:line", value, note; kind is rendered (>…), placed ({…}) or plain."""
    f = F.split("value", "\t")
    key = F.element_at(f, 1)
    value = F.try_element_at(f, F.lit(2))
    kind = F.when(value.startswith(">"), "rendered").when(value.rlike("^\\{.*\\}$"), "placed").otherwise("plain")
    return data_lines(spark, path).select(
        key.alias("key"), F.nullif(F.regexp_extract(key, "^(.*)@", 1), F.lit("")).alias("headword"), F.regexp_extract(key, "([0-9]+):-?[0-9]+$", 1).try_cast("int").alias("image"),
        F.regexp_extract(key, ":(-?[0-9]+)$", 1).try_cast("int").alias("line"), F.regexp_replace(value, "^>|^\\{|\\}$", "").alias("value"), F.try_element_at(f, F.lit(3)).alias("note"), kind.alias("kind"))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """(id, faulty, correct, batch): the last two of three columns or more; declined and too short rows are dropped."""
    f = F.split("value", "\t")
    rows = data_lines(spark, path).where(F.size(f) >= 3).select(F.element_at(f, 1).try_cast("int").alias("id"), F.element_at(f, -2).alias("faulty"), F.element_at(f, -1).alias("correct"), F.col("file").alias("batch"))
    return rows.where(sound_correction(F.col("faulty"), F.col("correct")))


def sound_correction(faulty: Column, correct: Column) -> Column:
    """Not empty, not declined, not the same, without an ellipsis, and at least half as long."""
    return (correct != "") & (correct != "RIEN") & (correct != faulty) & ~correct.contains("...") & ~correct.contains("…") & (F.length(correct) * 2 >= F.length(faulty))


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """(file, k, text) of lines "k|text" before the first comment of their file; == headers are skipped."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "(?sm)^#.*$", "").alias("v"))
    rows = whole.select("file", F.explode(F.split("v", "\n")).alias("l")).where(F.col("l").rlike("^-?[0-9]+\\|"))
    return rows.select("file", F.regexp_extract("l", "^(-?[0-9]+)\\|", 1).cast("int").alias("k"), F.regexp_extract("l", "^-?[0-9]+\\|(.*)$", 1).alias("text"))


def read_records(spark: SparkSession, path: str, schema: StructType = RECORD) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """(page, line, text, seq) from rows page, line, text: lines that a page lost, or anything else that stands at a place. Of equal places the last row counts."""
    f = F.split("value", "\t", 3)
    rows = data_lines(spark, path).select(F.element_at(f, 1).try_cast("int").alias("page"), F.try_element_at(f, F.lit(2)).try_cast("int").alias("line"), F.try_element_at(f, F.lit(3)).alias("text"), F.col("seq").cast("long").alias("seq"))
    return rows.where("page is not null and line is not null").groupBy("page", "line").agg(F.max_by("text", "seq").alias("text"), F.max("seq").alias("seq"))


def embedded_json(df: DataFrame, html: str, name: str, schema: DataType) -> DataFrame:
    """df with the JSON assigned to name within a script, parsed into column name; null where there is none. The value is decoded to its own end, whatever
    brackets and quotes stand inside; pages without the name never leave the JVM."""
    start = re.compile(rf"\b{re.escape(name)}\s*=\s*(?=[\[{{])")

    def cut(pages: pd.Series) -> pd.Series:
        decoder, out = json.JSONDecoder(), []
        for page in pages:
            found = None
            for m in start.finditer(page or ""):
                try:
                    found = page[m.end() : decoder.raw_decode(page, m.end())[1]]
                    break
                except ValueError:
                    continue
            out.append(found)
        return pd.Series(out, dtype=object)

    raw = F.when(F.col(html).contains(name), F.pandas_udf(cut, "string")(F.when(F.col(html).contains(name), F.col(html))))
    return df.withColumn(name, F.from_json(raw, schema))
