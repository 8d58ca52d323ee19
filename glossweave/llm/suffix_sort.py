"""Exact-substring dedup by a depth-limited radix sort of suffixes.

A byte is removed if it lies in a window of `length` bytes that also starts in a document with a smaller id. Suffixes are ordered by their bytes,
most significant digits first, and only through `length` of them; a suffix that is alone in its class drops out before the next pass. The
groups that are equal at full depth are exactly the repeated windows. No hash decides anything but copies of whole texts (by 128 bits).

Of every window one suffix inside it stands for it, at a place that the window's content chooses (the smallest hash of 8 bytes, the first of equals), so
equal windows have equal anchors at equal places, and about one suffix in 16 has to travel.

 0. Copies of whole texts, and texts under `length`, are settled by an aggregate. The others are dealt out in groups.
 1. First digit: the first DIGIT bytes of the anchors' suffixes. Each group sorts its own and sends every digit once, with how often it has it, to the
    partition whose range of digits it falls in (the ranges are laid out by a sample). A partition merges the sorted digits and answers each group
    which of its digits other documents have too.
 2. Last digit: for what is left, a group sends the stretch of the windows around each anchor, equal ones once with their smallest id, to the
    partition of its class. There the windows are ordered through `length` bytes in passes of 8, and each is answered with its smallest id.
    A class of more than HOT suffixes isn't gathered in one place: its windows go one by one, to partitions chosen by their content.
 3. Each group marks the windows that a smaller id owns.

Between the passes only tables of answers stay; texts are dealt out again for each.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, arrow_limits, drop_stash, give_back, ids, narrow, stash, utf8
from .hashing import chunks, mix, sliding_min
from .winnow import POS_BITS, cover, inside, to_batch

#: A group's documents and bytes, a partition's bytes of text, and the documents and their suffixes that lay out the ranges.
GROUP_DOCS, GROUP_BYTES, PART_BYTES, SAMPLE_DOCS, SAMPLE_EACH = 2048, 8 << 20, 12 << 20, 512, 128
#: Suffixes of a class that are gathered in one place, and windows sorted at a time.
HOT, AT_ONCE = 100_000, 400_000

RESULT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
ENTRY_DDL = "p int, g long, n int, a binary, b binary, c binary"
ENTRY = pa.schema([("p", pa.int32()), ("g", pa.int64()), ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
SIDE_DDL = "g long, kind int, p int, a binary, b binary, doc long, h long"
SIDE = pa.schema([("g", pa.int64()), ("kind", pa.int32()), ("p", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("doc", pa.int64()), ("h", pa.int64())])
COPY, DIGITS, WINDOWS = 0, 1, 2


def squeeze(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True)


def widen(blob, kind, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, count * np.dtype(kind).itemsize, "zstd"), kind)


def eights(n: int) -> int:
    return -(-n // 8) * 8


def radix(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of bytes, and where in that order a new value begins: passes over digits of 8 bytes, the most significant first, of those
    rows that still share their class with others. rows: n by a multiple of 8."""
    digits = rows.view(">u8")
    first = digits[:, 0].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    new = np.ones(len(rows), bool)
    new[1:] = np.diff(first[order]) != 0
    for j in range(1, digits.shape[1]):
        live = np.flatnonzero(~(new & np.append(new[1:], True))) if len(new) else np.zeros(0, int)
        if not len(live):
            break
        kind, at = np.cumsum(new)[live], order[live]
        digit = digits[at, j].astype(np.uint64)
        sub = np.lexsort((digit, kind))
        order[live], digit = at[sub], digit[sub]
        new[live] = np.append(True, (digit[1:] != digit[:-1]) | (kind[1:] != kind[:-1]))
    return order, new


def stretches(body: np.ndarray, start: np.ndarray, width: int, wide: int) -> np.ndarray:
    """The width bytes from each start (0 beyond the end), as rows of wide bytes."""
    out = np.zeros((len(start), wide), np.uint8)
    padded = np.append(body, np.zeros(width, np.uint8))
    out[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[start]
    return out


def anchors(body: np.ndarray, at: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the rows: row, place of the anchor, start of its first window, and how many windows in a row have it."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
    low = np.uint64((1 << POS_BITS) - 1)
    for a, b in chunks(at, 1 << 18):
        part, edges = body[at[a] : at[b]], at[a : b + 1] - at[a]
        ok = inside(edges, length, len(part))
        if not ok.any():
            continue
        n = len(part) - 7
        h = np.empty(n, np.uint64)
        for i in range(8):
            own = part[i : i + (len(part) - i) // 8 * 8].view("<u8")
            h[i::8] = own[: len(range(i, n, 8))]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h &= ~low
        h |= np.arange(n, dtype=np.uint64)
        start = np.flatnonzero(ok)
        place = (sliding_min(h, length - k + 1)[start] & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        many, place, start = np.diff(np.append(first, len(place))), place[first], start[first]
        row = np.searchsorted(edges, place, "right") - 1
        for o, x in zip(out, (row + a, place + at[a], start + at[a], many)):
            o.append(x)
    return tuple(map(np.concatenate, out))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary): what is left of each text, as UTF-8 bytes.

    Matches never cross documents; overlaps count; windows are judged on the input. A null text is empty. A null id counts as larger than
    any other, and rows with equal (or null) ids don't remove from each other. One row for each row of docs; other columns aren't read.
    """
    if length < 8:
        raise ValueError("length is 8 at least")
    k = max(8, length * 2 // 5)
    around, head = 2 * length - k, eights(k)
    spark = docs.sparkSession
    arrow_limits(spark)
    plain = narrow(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    plain = plain.withColumn("n", F.octet_length("text").cast("long")).withColumn("h", F.xxhash64("text"))
    real = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")

    long_ = plain.where(F.col("n") >= length)
    rows, size = long_.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups, parts = max(1, math.ceil(rows / GROUP_DOCS), math.ceil(size / GROUP_BYTES)), min(1 << 16, max(16, math.ceil(size / PART_BYTES)))
    long_ = long_.withColumn("g", F.pmod(F.xxhash64("doc_id", "h"), F.lit(groups)))
    marks = long_.select("doc_id", "g", "n", "h", F.xxhash64(F.lit(1), "text").alias("h2"))
    least = stash(marks.groupBy("h", "h2").agg(F.min("doc_id").alias("least"), F.count("*").alias("many")).where("many > 1").select("h", "h2", "least"), "texts")
    copies = stash(marks.join(least, ["h", "h2"]).where("doc_id > least").select("g", "doc_id", "n", "h"), "copies")
    drop_stash(least)
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("p", "int"), ("a", "binary"), ("b", "binary"))}
    copied = copies.select("g", F.lit(COPY).alias("kind"), *none.values(), F.col("doc_id").alias("doc"), "h")
    dealt = long_.select("g", "doc_id", "text", "h").repartition(groups, "g")  # a task holds a few groups at any size of the input

    def rows_of(left, right):
        """Bytes, offsets and ids of a group's texts, without copies."""
        mine = right.filter(pa.compute.equal(right["kind"], COPY))
        if mine.num_rows:
            known = set(zip(mine["doc"].to_pylist(), mine["h"].to_pylist()))
            left = left.filter(pa.array([x not in known for x in zip(left["doc_id"].to_pylist(), left["h"].to_pylist())]))
        body, at = utf8(left["text"])
        return body, at, ids(left["doc_id"])

    def first_of(body, place):
        """The first digits of suffixes: their order and where a new one begins."""
        return stretches(body, place, k, head)

    share = (1 << 20) * SAMPLE_DOCS // max(1, rows)

    def sampled(batches):
        for b in batches:
            body, at = utf8(b.column("text"))
            row, place, _, _ = anchors(body, at, length, k)
            own = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) < SAMPLE_EACH)
            yield pa.RecordBatch.from_arrays([pa.array(list(map(bytes, first_of(body, place[own]))), pa.binary())], ["digit"])

    some = long_.where(F.pmod(F.xxhash64("doc_id", "h", F.lit(3)), F.lit(1 << 20)) < share).select("text")
    sample = sorted(r["digit"] for r in some.mapInArrow(sampled, "digit binary").collect())  # SAMPLE_DOCS * SAMPLE_EACH are expected
    bounds = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    bounds = np.frombuffer(b"".join(bounds), np.uint8).reshape(len(bounds), head) if bounds else np.zeros((0, head), np.uint8)

    def cut(digits: np.ndarray) -> np.ndarray:
        """Where in sorted distinct digits the partitions begin and end."""
        both = np.concatenate([digits, bounds])
        order, _ = radix(both)  # stable: a bound comes after an equal digit
        place = np.flatnonzero(order >= len(digits))
        return np.concatenate([[0], place - np.arange(len(place)), [len(digits)]])

    def first_pass(key, left, right):
        out = []
        if left.num_rows:
            body, at, doc = rows_of(left, right)
            row, place, _, _ = anchors(body, at, length, k)
            digits = first_of(body, place)
            order, new = radix(digits)
            begin = np.flatnonzero(new)
            if len(begin):
                own = doc[row[order]]
                often = np.minimum(np.diff(np.append(begin, len(order))), 65535)
                often[np.minimum.reduceat(own, begin) == np.maximum.reduceat(own, begin)] *= -1  # of one document
                digits, often = digits[order[begin], :k], often.astype(np.int32)
                wide = np.zeros((len(digits), head), np.uint8)
                wide[:, :k] = digits
                ends = cut(wide)
                for p in np.flatnonzero(np.diff(ends)):
                    s, e = ends[p], ends[p + 1]
                    out.append((int(p), key[0].as_py(), int(e - s), squeeze(digits[s:e].T), squeeze(often[s:e]), None))
        give_back()
        return pa.Table.from_batches([to_batch(out, ENTRY)])

    def merge(key, table):
        """Answers to the groups: 0 for a digit of one document only, 1 for one of several, 2 if there are very many suffixes of it."""
        n = table["n"].to_numpy()
        digits = np.zeros((int(n.sum()), head), np.uint8)
        ends = np.append(0, np.cumsum(n))
        for i, x in enumerate(table["a"]):
            digits[ends[i] : ends[i + 1], :k] = widen(x.as_buffer(), np.uint8, n[i] * k).reshape(k, n[i]).T
        often = np.concatenate([widen(x.as_buffer(), np.int32, m) for x, m in zip(table["b"], n)]).astype(np.int64)
        order, new = radix(digits)
        begin = np.flatnonzero(new)
        several = (np.diff(np.append(begin, len(order))) > 1) | (np.maximum.reduceat(often[order], begin) > 0)
        code = several.astype(np.uint8) + (several & (np.add.reduceat(np.abs(often[order]), begin) > HOT))
        told = np.empty(len(order), np.uint8)
        told[order] = code[np.cumsum(new) - 1]
        out = [(g, DIGITS, key[0].as_py(), squeeze(told[ends[i] : ends[i + 1]]), np.int64(n[i]).tobytes(), None, None) for i, g in enumerate(table["g"].to_pylist())]
        give_back()
        return pa.Table.from_batches([to_batch(out, SIDE)])

    pass1 = dealt.groupBy("g").cogroup(copied.groupBy("g")).applyInArrow(first_pass, ENTRY_DDL)
    digits1 = stash(pass1.groupBy("p").applyInArrow(merge, SIDE_DDL), "digits")

    def items(left, right):
        """What of a group is left after the first digit: per item its row, start and number of windows; the rows' radix order, where a new one begins,
        and the stretches themselves: partition, digit, place of the anchor and number of windows, bytes."""
        body, at, doc = rows_of(left, right)
        row, place, start, many = anchors(body, at, length, k)
        digits = first_of(body, place)
        order, new = radix(digits)
        mine = right.filter(pa.compute.equal(right["kind"], DIGITS)).sort_by("p")
        told = [widen(a.as_buffer(), np.uint8, int(np.frombuffer(b.as_buffer(), np.int64)[0])) for a, b in zip(mine["a"], mine["b"])]
        code = np.concatenate([np.zeros(0, np.uint8), *told])
        kind, part = np.empty(len(order), np.uint8), np.empty(len(order), np.int64)
        if len(order):
            kind[order] = code[np.cumsum(new) - 1]
            part[order] = np.repeat(mine["p"].to_numpy(), [len(x) for x in told])[np.cumsum(new) - 1]
        pick = np.flatnonzero(kind == 1)
        row_, start_, many_, off_, part_ = row[pick], start[pick], many[pick], (place - start)[pick], part[pick]
        hot = np.flatnonzero(kind == 2)
        if len(hot):  # window by window
            each = np.repeat(hot, many[hot])
            step = np.arange(len(each)) - np.repeat(np.cumsum(many[hot]) - many[hot], many[hot])
            s = start[each] + step
            cells = stretches(body, s, length, eights(length)).view(np.uint64)
            h = np.zeros(len(s), np.uint64)
            for j in range(cells.shape[1]):
                h = mix(h ^ cells[:, j])
            row_, start_, many_ = np.append(row_, row[each]), np.append(start_, s), np.append(many_, np.ones(len(s), np.int64))
            off_, part_ = np.append(off_, place[each] - s), np.append(part_, parts + (h % np.uint64(parts)).astype(np.int64))
        wide = np.zeros((len(row_), 16 + head + eights(around)), np.uint8)
        wide[:, 0:8] = part_.astype(">u8").view(np.uint8).reshape(-1, 8)
        wide[:, 8 : 8 + head] = first_of(body, start_ + off_)
        wide[:, 8 + head : 16 + head] = (off_ << 32 | many_).astype(">u8").view(np.uint8).reshape(-1, 8)
        text = stretches(body, start_, around, eights(around))
        text[np.arange(text.shape[1]) >= (many_ - 1 + length)[:, None]] = 0
        wide[:, 16 + head :] = text
        return body, at, doc, row_, start_, many_, *radix(wide), wide

    def second_pass(key, left, right):
        out = []
        if left.num_rows:
            _, _, doc, row, _, _, order, new, wide = items(left, right)
            begin = np.flatnonzero(new)
            if len(begin):
                own, wide = np.minimum.reduceat(doc[row[order]], begin), wide[order[begin]]
                part = wide[:, :8].copy().view(">u8")[:, 0].astype(np.int64)
                ends = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
                for s, e in zip(ends[:-1], ends[1:]):
                    out.append((int(part[s]), key[0].as_py(), int(e - s), squeeze(wide[s:e, 16 + head :]), squeeze(wide[s:e, 8 + head : 16 + head].T), squeeze(own[s:e])))
        give_back()
        return pa.Table.from_batches([to_batch(out, ENTRY)])

    def settle(key, table):
        """Answers to the groups: for each stretch the smallest id of its windows; one number if all have the same, else one for each."""
        n = table["n"].to_numpy()
        ends = np.append(0, np.cumsum(n))
        wide = np.zeros((int(ends[-1]), 8 + head + eights(around)), np.uint8)
        for i, (a, b) in enumerate(zip(table["a"], table["b"])):
            wide[ends[i] : ends[i + 1], 8 + head :] = widen(a.as_buffer(), np.uint8, n[i] * eights(around)).reshape(n[i], -1)
            wide[ends[i] : ends[i + 1], head : 8 + head] = widen(b.as_buffer(), np.uint8, n[i] * 8).reshape(8, n[i]).T
        doc = np.concatenate([widen(x.as_buffer(), np.int64, m) for x, m in zip(table["c"], n)])
        both = wide[:, head : 8 + head].copy().view(">u8")[:, 0].astype(np.int64)
        off, many = both >> 32, both & 0xFFFFFFFF
        wide[:, :k] = wide[np.arange(len(wide))[:, None], 8 + head + off[:, None] + np.arange(k)]
        order, new = radix(wide)
        begin = np.flatnonzero(new)
        own, kind = np.minimum.reduceat(doc[order], begin), np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        reps = order[begin]  # distinct stretches, in order of their classes
        lead = wide[reps, :head].copy().view(">u8").astype(np.uint64)
        fresh = np.append(True, (lead[1:] != lead[:-1]).any(axis=1))
        mates = np.repeat(np.diff(np.append(np.flatnonzero(fresh), len(reps))), np.diff(np.append(np.flatnonzero(fresh), len(reps))))
        count = many[reps]
        first = np.append(0, np.cumsum(count))
        owner = np.repeat(own, count)  # of every window of the distinct stretches
        open_ = np.flatnonzero(mates > 1)
        each = np.repeat(open_, count[open_])
        step = np.arange(len(each)) - np.repeat(np.cumsum(count[open_]) - count[open_], count[open_])
        spot = np.cumsum(fresh)[each] * around + off[reps[each]] - step  # equal windows have their anchor at one place
        by = np.argsort(spot, kind="stable")
        each, step, spot = each[by], step[by], spot[by]
        edge = np.append(np.flatnonzero(np.append(True, spot[1:] != spot[:-1])), len(spot)) if len(spot) else np.zeros(1, int)
        s = 0
        while s < len(spot):
            e = int(edge[min(len(edge) - 1, max(np.searchsorted(edge, s + AT_ONCE, "right") - 1, np.searchsorted(edge, s, "right")))])
            windows = np.zeros((e - s, 8 + eights(length)), np.uint8)
            windows[:, :8] = spot[s:e].astype(">u8").view(np.uint8).reshape(-1, 8)
            windows[:, 8 : 8 + length] = wide[reps[each[s:e]][:, None], 8 + head + step[s:e, None] + np.arange(length)]
            at, fresh_ = radix(windows)
            at0 = np.flatnonzero(fresh_)
            slot = first[each[s:e]] + step[s:e]
            low = np.minimum.reduceat(owner[slot[at]], at0)
            owner[slot[at]] = low[np.cumsum(fresh_) - 1]
            s = e
        one = np.minimum.reduceat(owner, first[:-1]) == np.maximum.reduceat(owner, first[:-1]) if len(reps) else np.zeros(0, bool)
        out = []
        for i, g in enumerate(table["g"].to_pylist()):
            mine = kind[ends[i] : ends[i + 1]]
            size = np.where(one[mine], 1, count[mine])
            at = np.repeat(first[mine], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            out.append((g, WINDOWS, key[0].as_py(), squeeze(owner[at]), np.append(len(at), size).astype(np.int64).tobytes(), None, None))
        give_back()
        return pa.Table.from_batches([to_batch(out, SIDE)])

    pass2 = dealt.groupBy("g").cogroup(copied.unionByName(digits1).groupBy("g")).applyInArrow(second_pass, ENTRY_DDL)
    windows2 = stash(pass2.groupBy("p").applyInArrow(settle, SIDE_DDL), "windows")

    def mark(_, left, right):
        out = []
        if left.num_rows:
            body, at, doc, row, start, many, order, new, _ = items(left, right)
            begin = np.zeros(0, np.int64)
            end = begin
            if len(order):
                mine = right.filter(pa.compute.equal(right["kind"], WINDOWS)).sort_by("p")
                size = [np.frombuffer(x.as_buffer(), np.int64) for x in mine["b"]]
                owner = np.concatenate([widen(x.as_buffer(), np.int64, int(s[0])) for x, s in zip(mine["a"], size)])
                size = np.concatenate([s[1:] for s in size])
                kind = np.empty(len(order), np.int64)
                kind[order] = np.cumsum(new) - 1
                first, size = (np.cumsum(size) - size)[kind], size[kind]
                each = np.repeat(np.arange(len(kind)), size)
                step = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
                gone = owner[first[each] + step] < doc[row[each]]
                each, step = each[gone], step[gone]
                begin = start[each] + step
                end = begin + length + np.where(size[each] == 1, many[each] - 1, 0)
            mask = cover(begin, end, len(body))
            out = [outcome(int(d) if d != NO_ID else None, body[s:e].tobytes(), mask[s:e]) for d, s, e in zip(doc, at[:-1], at[1:])]
        give_back()
        return pa.Table.from_batches([to_batch(out, pa.schema(RESULT))])

    rest = dealt.groupBy("g").cogroup(copied.unionByName(digits1).unionByName(windows2).groupBy("g")).applyInArrow(mark, RESULT_DDL)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = copies.select(real, F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), nothing.alias("kept_sha256"), F.lit(b"").alias("kept"))
    short = plain.where(F.col("n") < length)
    short = short.select(real, F.col("n").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.col("text").cast("binary").alias("kept"))
    return rest.unionByName(whole).unionByName(short)


def outcome(doc: int | None, text: bytes, gone: np.ndarray) -> tuple:
    """A row of RESULT; gone: the bytes to remove."""
    removed = int(gone.sum())
    kept = text if not removed else np.frombuffer(text, np.uint8)[~gone].tobytes()
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if removed else 0
    return doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept
