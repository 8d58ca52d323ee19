"""Importance resampling towards a target distribution, by a dictionary of distinct features.

 1. Features are all runs of one to three words. A batch's distinct features are hashed once each, to the CRC that decides their bucket: that of a run of
    words follows from those of its words, as CRCs are linear. With their counts they are dealt out to the parts of one dictionary. A string travels as a key
    of 48 bits, its CRC and 16 bits of another hash, since strings would be six times the text; keys go sorted, as differences.
 2. A part of the dictionary merges its entries, so each distinct feature is there once with its count in the corpus; counts are added up by
    bucket. Strings that had one key in common would have one bucket in common too, so sums are exact whatever the keys.
 3. Log ratios of bucket counts are the gains; the table of buckets has a fixed number of rows, so it goes to every task, where it joins the counts of
    features of each document. Gumbel noise on top makes the best scores a draw without replacement in proportion to the importance weights.
 4. Ranks come from a range-partitioned sort: place in the range plus the rows of all ranges before.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, give_back, narrow, stash, thrifty, utf8
from .hashing import Prefixes, chunks, mix

BUCKETS = 10_000
#: Bytes of text a part of the dictionary is laid out for, the most parts, and the entries a part merges at once. More entries go in turn, which
#: gives the same sums, only some features are there once for each turn.
PART_BYTES, MOST_PARTS, WINDOW = 8 << 20, 4096, 4_000_000
SLICE = 1_000_000
#: Bits of a key beside the CRC, and bytes of text that are worked on at once.
MORE_BITS = 16
CHUNK_BYTES = 2 << 20
LONG_WORD = 64
POLY = 0xEDB88320


def byte_crcs() -> np.ndarray:
    """The CRC-32 step of each byte value."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = (x >> np.uint32(1)) ^ np.where(x & np.uint32(1), np.uint32(POLY), np.uint32(0))
    return x


class Crc:
    """CRC-32 of joined strings: behind n more bytes a CRC is a linear image of itself, which four lookups of its bytes give."""

    def __init__(self) -> None:
        self.step = byte_crcs()
        unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
        one = (unit >> np.uint32(8)) ^ self.step[unit & np.uint32(255)]
        images = [unit]  # images[n]: what becomes of each bit behind n zero bytes
        for _ in range(LONG_WORD):
            images.append(self.linear(self.lookup(one), images[-1]))
        self.short = np.stack([self.lookup(i) for i in images])
        doubled = [images[LONG_WORD]]
        for _ in range(26):
            doubled.append(self.linear(self.lookup(doubled[-1]), doubled[-1]))
        self.far = [self.lookup(i) for i in doubled]

    @staticmethod
    def lookup(images: np.ndarray) -> np.ndarray:
        """Tables by byte place of the linear map with these images of the bits."""
        out = np.zeros((4, 256), np.uint32)
        for k in range(4):
            for bit in range(8):
                out[k] ^= np.where(np.arange(256) >> bit & 1, images[8 * k + bit], np.uint32(0)).astype(np.uint32)
        return out

    @staticmethod
    def linear(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        return table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]

    def behind(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The part that a string's CRC has in that of the string and n more bytes."""
        blocks, rest = n // LONG_WORD, n % LONG_WORD
        flat = self.short.reshape(-1, 256)
        at = rest * 4
        out = flat[at, crc & 255] ^ flat[at + 1, crc >> 8 & 255] ^ flat[at + 2, crc >> 16 & 255] ^ flat[at + 3, crc >> 24]
        for k, table in enumerate(self.far):
            hit = np.flatnonzero(blocks >> k & 1)
            if len(hit):
                out[hit] = self.linear(table, out[hit])
            if not (blocks >> k).any():
                break
        return out

    def of(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRCs of slices of a buffer."""
        size = ends - starts
        out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        left = np.flatnonzero((size > 0) & (size <= LONG_WORD))
        for i in range(int(size[left].max()) if len(left) else 0):
            left = left[size[left] > i]
            c = out[left]
            out[left] = self.step[(c ^ body[starts[left] + i]) & np.uint32(255)] ^ (c >> np.uint32(8))
        out ^= np.uint32(0xFFFFFFFF)
        for i in np.flatnonzero(size > LONG_WORD):
            out[i] = zlib.crc32(body[starts[i] : ends[i]].tobytes())
        return out


def tokens(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text with A-Z lower-cased, starts and ends of its words, and the n + 1 word offsets of the rows."""
    body = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body).astype(np.uint8)
    kind = np.zeros(256, bool)
    kind[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    inside = np.zeros(len(body) + 2, bool)
    inside[1:-1] = kind[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    starts = starts[starts < len(body)]
    return body, starts, ends, np.searchsorted(starts, offsets)


def pieces(texts):
    """Rows of a text column, about CHUNK_BYTES at once, one row at least: (first row, row behind the last, and what tokens() gives)."""
    body, offsets = utf8(texts)
    for a, b in chunks(offsets, CHUNK_BYTES):
        yield a, b, *tokens(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def following(ids: np.ndarray, rows: np.ndarray, x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
    """For places x to y, the numbers of the next word and the next but one plus 1, 0 where the row has ended; ids and rows go from x on, two further than y if they can."""
    n, out = y - x, []
    for k in (1, 2):
        nxt = np.zeros(n, np.int64)
        m = min(n, len(ids) - k)
        if m > 0:
            same = rows[:m] == rows[k : k + m]
            nxt[:m] = np.where(same, ids[k : k + m] + 1, 0)
        out.append(nxt)
    return out[0], out[1]


def packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted keys with their counts as one blob: differences and counts by byte places, which compress well."""
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in (np.diff(keys, prepend=0), n)]
    raw = b"".join(planes)
    return len(raw).to_bytes(4, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[4:], decompressed_size=size, asbytes=True), np.uint8)
    gaps, n = (x.reshape(8, -1).T.copy().view("<i8").ravel() for x in (raw[: size // 2], raw[size // 2 :]))
    return np.cumsum(gaps), n


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at], np.add.reduceat(n, at) if len(at) else n


class Features:
    """The runs of one to three words that begin at the places of a slice, each distinct word hashed once and all runs from the words' CRCs."""

    def __init__(self, crc: Crc, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, rows: np.ndarray, x: int, y: int) -> None:
        z = min(y + 2, len(starts))
        self.kinds, first, ids = np.unique(hashes[x:z], return_index=True, return_inverse=True)
        self.crc, self.size = crc, (ends - starts)[x + first]
        self.word = crc.of(body, starts[x + first], ends[x + first])
        self.spaced = crc.behind(self.word, np.ones(len(self.word), np.int64)) ^ np.uint32(zlib.crc32(b" "))
        self.a = ids[: y - x].astype(np.int64)
        self.b, self.c = following(ids, rows[x:z], x, y)

    def two(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """CRCs of pairs; b counts from 1."""
        return self.crc.behind(self.spaced[a], self.size[b - 1]) ^ self.word[b - 1]

    def three(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        stem = self.crc.behind(self.spaced[a], self.size[b - 1] + 1) ^ self.spaced[b - 1]
        return self.crc.behind(stem, self.size[c - 1]) ^ self.word[c - 1]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the distinct features, in order, and their counts."""
        pairs, pair, many = np.unique(self.a << 32 | self.b, return_inverse=True, return_counts=True)
        triples, n3 = np.unique(pair.astype(np.int64) << 32 | self.c, return_counts=True)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        p, c = triples >> 32, triples & 0xFFFFFFFF
        n1 = np.bincount(self.a, minlength=len(self.kinds))
        one, two, three = np.flatnonzero(n1), np.flatnonzero(b), np.flatnonzero(c)
        p, c = p[three], c[three]
        follow = lambda h, k: mix(h * np.uint64(0x9E3779B97F4A7C15) + self.kinds[k - 1])
        h2 = follow(self.kinds[a], np.maximum(b, 1))
        crcs = np.concatenate([self.word[one], self.two(a[two], b[two]), self.three(a[p], b[p], c)])
        more = np.concatenate([self.kinds[one], h2[two], follow(h2[p], c)])
        return summed(crcs.astype(np.int64) << MORE_BITS | (more >> np.uint64(64 - MORE_BITS)).astype(np.int64), np.concatenate([n1[one], many[two], n3[three]]))


def entries(parts: int):
    """The distinct features of a batch by part of the dictionary: (part, blob). A part is a range of CRCs."""

    def run(batches):
        prefixes, crc = Prefixes(), Crc()
        for batch in batches:
            for _, _, body, starts, ends, at in pieces(batch.column("text")):
                hashes = prefixes.load(body).of(starts, ends)
                rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
                for x in range(0, len(starts), SLICE):
                    keys, n = Features(crc, body, starts, ends, hashes, rows, x, min(x + SLICE, len(starts))).distinct()
                    part = (keys >> MORE_BITS) * parts >> 32
                    cut = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
                    blobs = [packed(keys[s:e], n[s:e]) for s, e in zip(cut[:-1], cut[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]], pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])
            give_back()

    return run


def bucket_sums(buckets: int):
    """Bucket counts of the dictionary's parts as their entries stream in."""

    def run(batches):
        sums, part, window, held = np.zeros(buckets, np.int64), None, [], 0

        def merge() -> None:
            keys, n = summed(*(np.concatenate(x) for x in zip(*window)))
            np.add.at(sums, (keys >> MORE_BITS) % buckets, n)

        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob")):
                entry = unpacked(blob.as_py())
                if window and (p != part or held + len(entry[0]) > WINDOW):
                    merge()
                    window, held = [], 0
                part = p
                window.append(entry)
                held += len(entry[0])
        if window:
            merge()
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(sums[hit], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, *, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often the corpus holds features of each bucket, by way of the dictionary of distinct features."""
    arrow_limits(texts.sparkSession)
    text = texts.select(F.col(text_col).cast("string").alias("text"))
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, max(1, size // PART_BYTES))
    dealt = text.mapInArrow(thrifty(entries(parts)), "part int, blob binary").repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(thrifty(bucket_sums(buckets)), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, *, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: a thousand times the log ratio of its smoothed shares in target and docs, rounded down. One number a bucket reaches the driver."""
    both = []
    for df, col in ((docs, text_col), (target, target_col)):
        own = np.zeros(buckets, np.int64)
        for r in bucket_counts(df, text_col=col, buckets=buckets).collect():
            own[r.bucket] = r.n
        both.append(own)
    s, t = ([int(x) for x in c] for c in both)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((y + 1.0) * all_s / ((x + 1.0) * all_t))) for x, y in zip(s, t)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths; a null id has that of an empty id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row for each row of docs."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        crc, prefixes, buckets = Crc(), Prefixes(), np.uint32(len(gain))
        for batch in batches:
            n = batch.num_rows
            words, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for first, last, body, starts, ends, at in pieces(batch.column("text")):
                words[first:last] = np.diff(at)
                rows = np.repeat(np.arange(last - first), np.diff(at))
                hashes = prefixes.load(body).of(starts, ends)
                for x in range(0, len(starts), SLICE):
                    y = min(x + SLICE, len(starts))
                    f = Features(crc, body, starts, ends, hashes, rows, x, y)
                    score = gain[f.word % buckets][f.a]
                    two, three = np.flatnonzero(f.b), np.flatnonzero(f.c)
                    score[two] += gain[f.two(f.a[two], f.b[two]) % buckets]
                    score[three] += gain[f.three(f.a[three], f.b[three], f.c[three]) % buckets]
                    np.add.at(weight[first:last], rows[x:y], score)
            give_back()
            ids_ = batch.column("doc_id").to_pylist()
            score = [int(w) + noise(i, seed) for i, w in zip(ids_, weight)]
            features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in (words, features, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return narrow(docs, id_col, text_col).mapInArrow(thrifty(run), "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, draw: int) -> DataFrame:
    """rows with rank: 1 to draw by score, highest first, ties to the smaller doc_id, then to fewer features; null beyond."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = stash(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    before = {}
    done = 0
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a range
        before[r.part], done = done, done + r["count"]
    if not before:
        return placed.drop("place").withColumn("rank", F.lit(None).cast("long"))
    offsets = F.broadcast(rows.sparkSession.createDataFrame(list(before.items()), "part long, before long"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("part", part).join(offsets, "part").withColumn("rank", F.when(rank <= draw, rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", share: tuple[int, int] = (5, 100), least_words: int = 20, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row for each row of docs: rank is 1, 2, 3... for the share of documents with least_words or more
    that is drawn, null for the others.

    A null or empty text has no features and weight 0; repeated rows are weighed and drawn each for itself; a null id has the noise of an empty one and
    comes last among ties. Other columns are not read. With an empty target every gain speaks for rare features only; an empty docs gives no rows.
    """
    gain = gains(docs, target, text_col=text_col, target_col=target_col, buckets=buckets)
    rows = stash(weigh(docs, gain, id_col=id_col, text_col=text_col, seed=seed), "weights")
    able = rows.where(F.col("n_words") >= least_words)
    draw = share[0] * able.count() // share[1]
    return ranked(able, draw).unionByName(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
