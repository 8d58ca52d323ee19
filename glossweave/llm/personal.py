"""Personal data by bootstrapped contextual extraction.

 1. Four fixed forms give the seeds: emails, addresses of machines, card and phone numbers. In the same pass every other string that could be an identifier (a token
    with digits, or an @) is noted as a mention, with the patterns it stands in: the word before it, the two words before it, and its own shape.
 2. Mentions make a graph of patterns and instances. A pattern is worth the share of known ones among all that stands in it, an instance is as
    likely as its patterns say together; both are scored in turns, so that what was found vouches for further patterns.
 3. A word is a pattern only by what else follows it, so occurrences of the words of promising patterns are counted over the whole corpus.
 4. Mentions in a pattern that many known instances vouch for are reported as further spans, kind ctx.

The graph holds hashes of 64 bits; one row of it stands for all repetitions of an instance in a pattern.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, narrow, stash, thrifty, utf8
from .hashing import Prefixes, mix

# Fixed forms of the base scan, as they are searched here: from the @ of an email, and with possessive runs, so that long texts take linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND = "ctx"

#: What parts tokens, and what else parts the words of a context.
PARTING = "\\x20\\x09-\\x0D\"'<>=,;()\\[\\]{}|"
WORD_PARTING = PARTING + ".:!?"
TOKEN = re.compile(f"(?<![^{PARTING}])(?=[^{PARTING}0-9@]*[0-9@])[^{PARTING}]++")
CONTEXT = re.compile(f"[^{WORD_PARTING}]+")
REACH = 256
RUN = 4
GAP = re.compile(r"[\x20().]{1,2}")
BITS = 20

SPANS = "array<struct<kind string, start long, end long>>"
MENTION = "start long, end long, instance long, patterns array<long>"
SCAN_DDL = f"key long, doc_id long, spans {SPANS}, mentions array<struct<seed boolean, start long, end long, instance long, patterns array<long>>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_MENTIONS = pa.list_(pa.struct([("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
#: Kinds of patterns, as the two low bits of their hashes.
SHAPE, ONE, TWO = 1, 2, 3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    out, done = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            # The local part is what stands before the @ in one piece, behind the last match.
            s = m.start()
            while s > done and not LOCAL.match(text, s - 1):
                s -= 1
            if s < m.start():
                out.append((0, s, m.end()))
                done = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return [(BASE_KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in out)]


def others(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans of what could be an identifier and touches no base span: tokens, and a few tokens in a row that begin like a number or a code."""
    tokens = []
    for m in TOKEN.finditer(text):
        s, e = m.span()
        piece = m[0].rstrip(".:!?-")
        name = re.match(r"[A-Za-z_][A-Za-z_-]*:(?=.)", piece)
        if name:
            s += name.end()
        tokens.append((s, m.start() + len(piece), e))
    marks = sorted((s, e) for _, s, e in taken)
    out, at = [], 0
    for i, (s, e, _) in enumerate(tokens):
        for k in range(RUN):
            if k:
                if i + k >= len(tokens) or tokens[i + k - 1][1] != tokens[i + k - 1][2] or not GAP.fullmatch(text, tokens[i + k - 1][2], tokens[i + k][0]) or not (text[s] in "+" or text[s].isalpha()):
                    break
                e = tokens[i + k][1]
            piece = text[s:e]
            if len(piece) > 64 * (k + 1) or len(piece) < 5 or not (sum(c.isdigit() for c in piece) >= 3 or "@" in piece[1:] or piece[0] == "@"):
                continue
            while at < len(marks) and marks[at][1] <= s:
                at += 1
            if not any(a < e and s < b for a, b in marks[at : at + 8]):
                out.append((s, e))
    return out


def shape(piece: str) -> str:
    """Digits as 9, a run of letters as one a or A; empty where only digits are left, which says nothing."""
    s = re.sub("[0-9]", "9", re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", piece))
    return "" if set(s) <= {"9"} else s


def stable(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def plain_words(text: str) -> bytes:
    """Context words in the form in which they are counted."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN)


_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def pattern(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h & np.uint64(0xFFFFFFFFFFFFFFFC)) | np.uint64(kind)).view(np.int64)


def two_words(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def scan_batches(batches):
    """Base spans and mentions with their patterns: one row a document, under a key of its own."""
    prefixes, key = Prefixes(), (TaskContext.get().partitionId() << 33) - 1
    for batch in batches:
        ids_, spans, found, buffer, at = batch.column("doc_id"), [], [], bytearray(), []
        keys = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            key += 1
            keys.append(key)
            base = base_spans(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            mentions = []
            for seed, s, e in [(True, s, e) for _, s, e in base] + [(False, s, e) for s, e in others(text, base)]:
                piece = text[s:e]
                own, before = shape(piece), CONTEXT.findall(text, max(0, s - REACH), s)[-2:]
                words = []
                for w in before:
                    b = plain_words(w)
                    words.append((len(buffer), len(buffer) + len(b)))
                    buffer += b
                at += words
                mentions.append([seed, s, e, stable(piece.lower()), [stable(own) & ~3 | SHAPE] if own else [], len(words)])
            found.append(mentions)
        hashes = prefixes.load(np.frombuffer(bytes(buffer), np.uint8)).of(np.array([a for a, _ in at], np.int64), np.array([b for _, b in at], np.int64)) if at else np.zeros(0, np.uint64)
        ones = pattern(hashes, ONE).tolist()
        twos = pattern(two_words(hashes[:-1], hashes[1:]), TWO).tolist() if len(hashes) > 1 else []
        i, rows = 0, []
        for mentions in found:
            row = []
            for seed, s, e, instance, patterns, n in mentions:
                i += n
                patterns = patterns + ([ones[i - 1]] if n else []) + ([twos[i - 2]] if n == 2 else [])
                row.append({"seed": seed, "start": s, "end": e, "instance": instance, "patterns": patterns})
            rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids_, pa.array(spans, _SPAN), pa.array(rows, _MENTIONS)], ["key", "doc_id", "spans", "mentions"])


def occurrences(bitmap: np.ndarray):
    """How often the words and pairs of words whose pattern's bit is set stand in a batch: (pattern, n)."""
    parting = np.zeros(256, bool)
    parting[[*range(9, 14), *map(ord, " \"'<>=,;()[]{}|.:!?")]] = True
    plain = np.frombuffer(_PLAIN, np.uint8)

    def run(batches):
        prefixes = Prefixes()
        for batch in batches:
            body, offsets = utf8(batch.column("text"))
            if not len(body):
                continue
            inside = np.zeros(len(body) + 2, bool)
            inside[1:-1] = ~parting[body]
            edge = np.zeros(len(body) + 1, bool)
            edge[offsets] = True
            starts, ends = np.flatnonzero(inside[1:] & (~inside[:-1] | edge)), np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
            starts = starts[: len(ends)]
            if not len(starts):
                continue
            h = prefixes.load(plain[body]).of(starts, ends)
            row = np.searchsorted(offsets, starts, "right")
            p = [pattern(h, ONE), pattern(two_words(h[:-1], h[1:]), TWO)[row[:-1] == row[1:]]]
            p = np.concatenate(p)
            slot = p.view(np.uint64) >> np.uint64(64 - BITS)
            kinds, n = np.unique(p[bitmap[slot.astype(np.int64)]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(n, pa.int64())], ["pattern", "n"])

    return run


def trusted(edges: DataFrame, beside: DataFrame | None, rounds: int, least: float, support: float) -> DataFrame:
    """(pattern, worth) of the patterns to trust, from edges (pattern, instance, seed, n): worth is the sum of its instances' likelihoods over their number,
    plus what else follows its words (beside: pattern, n), plus 1. Patterns and instances are scored in turns."""
    likely = None
    for i in range(rounds):
        known = edges if likely is None else edges.join(likely, "instance", "left")
        r = F.when(F.col("seed"), 1.0) if likely is None else F.when(F.col("seed"), 1.0).otherwise(F.col("likelihood"))
        scored = known.groupBy("pattern").agg(F.sum(F.coalesce(r, F.lit(0.0))).alias("known"), F.count("*").alias("all"), F.sum("n").alias("mentions"))
        if beside is None:
            other = F.lit(0)
        else:
            scored = scored.join(beside.withColumnRenamed("n", "total"), "pattern", "left")
            other = F.when(F.col("pattern").bitwiseAND(3) == SHAPE, 0).otherwise(F.greatest(F.col("total") - F.col("mentions"), F.lit(0)))
        worth = F.col("known") / (F.col("all") + F.coalesce(other, F.lit(0)) + 1)
        good = stash(scored.where(F.col("known") >= support).withColumn("worth", worth).where(F.col("worth") >= least).select("pattern", "worth"), "patterns")
        if i + 1 < rounds:
            doubt = F.sum(F.log(1 - F.least(F.col("worth"), F.lit(0.99))))
            likely = stash(edges.where("not seed").join(good, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("likelihood")), "instances")
    return good


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, least: float = 0.5, support: float = 3.0) -> DataFrame:
    """Personal data of every whole text: (doc_id, spans array<struct<kind, start, end>>), one row for each row of docs.

    Offsets are code points, end exclusive; spans are sorted by start, then kind (email, ip, card, phone, ctx). Found spans overlap no others; of those that overlap
    each other the first, then the longest stays. A pattern is trusted from a worth of least on, with instances known for support in sum.
    A null or empty text has no spans; repeated rows each get a row, and vouch for a pattern once; a null id stays null; other columns are not read.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    texts = narrow(docs, id_col, text_col)
    scanned = stash(texts.mapInArrow(thrifty(scan_batches), SCAN_DDL), "mentions")
    mentions = scanned.where(F.size("mentions") > 0).select("key", F.explode("mentions").alias("m")).select("key", "m.*")
    each = mentions.select(F.explode("patterns").alias("pattern"), "instance", "seed")
    pairs = each.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    # Patterns of fewer instances than the support can't be trusted; one count a pattern tells which are left.
    wide = pairs.groupBy("pattern").agg(F.count("*").alias("c")).where(F.col("c") >= support).select("pattern")
    edges = stash(pairs.join(wide, "pattern", "left_semi"), "pattern-graph")
    good = trusted(edges, None, rounds, least, support)
    words = good.where(F.col("pattern").bitwiseAND(3) != SHAPE)
    bitmap = np.zeros(1 << BITS, bool)
    slots = words.select(F.shiftrightunsigned("pattern", 64 - BITS).alias("slot"))
    for word, bits in slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).collect():  # 16,384 rows at most
        bitmap[word * 64 : word * 64 + 64] = [bits >> i & 1 for i in range(64)]
    if bitmap.any():
        counted = texts.select("text").mapInArrow(thrifty(occurrences(bitmap)), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
        beside = stash(counted.join(words.select("pattern"), "pattern", "left_semi"), "occurrences")
        good = trusted(edges.join(good.select("pattern"), "pattern", "left_semi"), beside, rounds, least, support)
    hits = mentions.where("not seed").select("key", "start", "end", F.explode("patterns").alias("pattern")).join(good.select("pattern"), "pattern", "left_semi")
    found = hits.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("found"))

    def settle(batches):
        order = {k: i for i, k in enumerate((*BASE_KINDS, FOUND))}
        for b in batches:
            rows = []
            for spans, more in zip(b.column("spans").to_pylist(), b.column("found").to_pylist()):
                end = -1
                for x in sorted(more or [], key=lambda x: (x["start"], -x["end"])):
                    if x["start"] >= end:
                        spans.append({"kind": FOUND, **x})
                        end = x["end"]
                rows.append(sorted(spans, key=lambda x: (x["start"], order[x["kind"]], x["end"])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, _SPAN)], ["doc_id", "spans"])

    # Most documents have nothing that was found, and no row to meet.
    return scanned.select("key", "doc_id", "spans").join(found, "key", "left").select("doc_id", "spans", "found").mapInArrow(settle, f"doc_id long, spans {SPANS}")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of scan()'s spans."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    many = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != FOUND)
    return scanned.select("doc_id", *(many(k) for k in BASE_KINDS), F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", name), ",").alias("spans"))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "[PRIVATE]") -> DataFrame:
    """(doc_id, text) with every span replaced by mark; one id must stand for one text. Null texts stay null."""
    spans = scan(docs, id_col=id_col, text_col=text_col)
    both = narrow(docs, id_col, text_col).join(spans.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")), "left").drop("id")
    cut = F.aggregate(
        F.coalesce("spans", F.array().cast(SPANS)), F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(s["start"] >= a["at"], F.struct(F.concat(a["out"], F.substr(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)).alias("out"), s["end"].alias("at")))
        .otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))),
    )
    return both.withColumn("c", cut).select("doc_id", F.when(F.col("text").isNotNull(), F.concat("c.out", F.substr(F.col("text"), (F.col("c.at") + 1).cast("int")))).alias("text"))
