"""Content-chosen anchors and the exact search for the first owner of each key.

Both exact-substring operators find repeats the same way. Winnowing picks, in every window of the threshold's length, the k-gram with the
smallest hash (the leftmost of equals), so two equal windows always hold the same anchor, wherever they stand. Anchors go as packed arrays,
reduced to one or two entries for each key and group of documents, to the partition of their key, which tells every group that holds a key
of several documents who owns it first. A key of a third of all documents costs one entry a group, not one a document.

Documents are dealt to groups by a hash of id and text; a group holds about GROUP_DOCS documents or GROUP_BYTES bytes. Everything is exact
up to hash collisions: anchors only propose candidates, decisions rest on 64-bit hashes of the strings compared, within a partition.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID
from .hashing import gram, mix, sliding_min

GROUP_DOCS, GROUP_BYTES = 1024, 4 << 20
POS_BITS = 31


def sized(docs: DataFrame, bytes_a_part: int) -> tuple[DataFrame, int]:
    """docs (doc_id, text) with their group g, dealt out by g, and the power of two of partitions for keys."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, math.ceil(n / GROUP_DOCS), math.ceil(size / GROUP_BYTES))
    bits = min(16, max(6, math.ceil(math.log2(max(1, size / bytes_a_part)))))
    g = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups))
    return docs.withColumn("g", g).repartition("g"), bits


def minima(units: np.ndarray, at: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie within one row, the anchor of each, and the hashes of all k-grams; at: the n + 1 offsets of rows in units."""
    ok = inside(at, window, len(units))
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = mix(gram(units, k))
    low = np.uint64((1 << POS_BITS) - 1)
    best = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), window - k + 1)
    return np.flatnonzero(ok), (best[ok] & low).astype(np.int64), h


def anchors(units: np.ndarray, at: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys of the anchors of all windows that lie within one row."""
    _, pos, h = minima(units, at, window, k)
    pos = pos[np.append(True, pos[1:] != pos[:-1])] if len(pos) else pos
    return pos, mix(h[pos] + np.uint64(0x9E3779B97F4A7C15))  # the chosen hashes are small ones; keys must be even again


def inside(at: np.ndarray, window: int, n: int) -> np.ndarray:
    """For each window start of a buffer of n units: does the window stay in its row?"""
    if n < window:
        return np.zeros(0, bool)
    step = np.zeros(n + 2, np.int32)
    ok = np.diff(at) >= window
    np.add.at(step, at[:-1][ok], 1)
    np.add.at(step, at[1:][ok] - window + 1, -1)
    return np.cumsum(step)[: n - window + 1] > 0


def whole_keys(texts: list[bytes]) -> np.ndarray:
    """Two independent keys for each whole text."""
    out = np.zeros((len(texts), 2), np.uint64)
    for i, t in enumerate(texts):
        h = xxhash.xxh3_128_intdigest(t)
        out[i] = (h >> 64, h & ((1 << 64) - 1))
    return out


# --- packed entries -------------------------------------------------------------------------------------------------------------

ENTRY = "p int, g long, keys binary, docs binary, base long"
ENTRY_ARROW = pa.schema([("p", pa.int32()), ("g", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("base", pa.int64())])
OWNER = "g long, keys binary, docs binary, base long"
OWNER_ARROW = pa.schema([("g", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("base", pa.int64())])


def pack_ids(docs: np.ndarray) -> tuple[bytes, int]:
    base = int(docs.min()) if len(docs) else 0
    off = (docs - base).view(np.uint64)
    return (off.astype(np.uint32) if not len(off) or off.max() < 1 << 32 else off).tobytes(), base


def unpack_ids(blob: bytes, base: int, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint32 if len(blob) == 4 * n else np.int64).astype(np.int64) + base


def pack_keys(keys: np.ndarray, width: int) -> bytes:
    return keys.tobytes() if width == 8 else np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(blob: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(blob, np.uint64)
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def shorten(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper 40 + bits bits: what anchors are compared by."""
    return keys >> np.uint64(24 - bits)


def entries(g: int, keys: np.ndarray, docs: np.ndarray, bits: int, width: int) -> list[tuple]:
    """Rows of ENTRY for one group: each key once with its smallest id, and once more with its largest if that differs.

    width 8: whole keys, dealt by their upper bits. width 5: keys shortened to 40 + bits bits.
    """
    if not len(keys):
        return []
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.append(True, keys[1:] != keys[:-1])
    last = np.append(first[1:], True)
    high = np.append(np.flatnonzero(first)[1:], len(keys)) - 1
    low = np.flatnonzero(first)
    twice = docs[high] != docs[low]
    pick = np.sort(np.concatenate([low, high[twice]]))
    keys, docs = keys[pick], docs[pick]
    del last
    top = 64 - bits if width == 8 else 40
    cut = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(top))
    cut = np.concatenate([[0], cut, [len(keys)]])
    out = []
    for p in np.flatnonzero(np.diff(cut)):
        a, b = cut[p], cut[p + 1]
        blob, base = pack_ids(docs[a:b])
        out.append((int(p), g, pack_keys(keys[a:b], width), blob, base))
    return out


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def by_group(g: np.ndarray, *columns: np.ndarray):
    """For each value of g, the columns' parts."""
    order = np.argsort(g, kind="stable")
    g = g[order]
    cut = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g)) if len(g) else np.zeros(1, int)
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(g[a]), *(c[order[a:b]] for c in columns)


def gather(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, ids and groups of all packed entries of a table."""
    keys, docs, gs = [], [], []
    for g, k, d, base in zip(table["g"].to_pylist(), table["keys"], table["docs"], table["base"].to_pylist()):
        key = unpack_keys(k.as_buffer(), width)
        keys.append(key)
        docs.append(unpack_ids(d.as_buffer(), base, len(key)))
        gs.append(np.full(len(key), g, np.int64))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(docs), np.concatenate(gs)


def owners(packed: DataFrame, width: int) -> DataFrame:
    """For each group, its keys that occur under several ids, with the smallest of all ids: (g, keys, docs, base)."""

    def reduce(key, table):
        p = key[0].as_py()
        keys, docs, gs = gather(table, width)
        order = np.argsort(keys, kind="stable")
        keys, docs, gs = keys[order], docs[order], gs[order]
        first = np.append(True, keys[1:] != keys[:-1])
        low = np.flatnonzero(first)
        size = np.diff(np.append(low, len(keys)))
        least, most = np.minimum.reduceat(docs, low), np.maximum.reduceat(docs, low)
        keep = np.repeat(most > least, size)
        keep[1:] &= first[1:] | (gs[1:] != gs[:-1])  # a group's second entry for a key
        owner = np.repeat(least, size)[keep]
        keys, gs = keys[keep], gs[keep]
        if width != 8:
            keys = keys | np.uint64(p << 40)
        rows = []
        for g, k, o in by_group(gs, keys, owner):
            blob, base = pack_ids(o)
            rows.append((g, k.tobytes(), blob, base))
        return pa.Table.from_batches([to_batch(rows, OWNER_ARROW)])

    return packed.groupBy("p").applyInArrow(reduce, OWNER)


class Owners:
    """Look-up of keys in what owners() sent to a group."""

    def __init__(self, table: pa.Table) -> None:
        keys, docs, _ = gather(table, 8)
        order = np.argsort(keys)
        self.keys, self.docs = keys[order], docs[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The owner of each key, NO_ID where only one id has it."""
        if not len(self.keys):
            return np.full(len(keys), NO_ID, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.docs[at], NO_ID)

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n units lie in one of the spans."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step)[:n] > 0
