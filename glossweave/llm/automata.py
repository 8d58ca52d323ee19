"""Substring dedup with suffix automata of reference shards.

A word is removed if it lies in a window of `length` words that also starts in a document with a smaller id.

 1. Anchors (see winnow) over words tell which documents may share windows, and for each anchor which document holds it first: its reference.
 2. The passages of a reference around its own anchors form reference shards of SHARD_WORDS words at most, overlapping by length - 1.
    Shards meet the documents that hold one of their anchors, by reference id. They are broadcast while their measured size is at most
    BROADCAST_BYTES; beyond that both sides are dealt out by reference id, where AQE can split a popular reference's documents, as a shard is one row.
 3. For each shard a suffix automaton is built, and the documents' passages stream through it: matching statistics of `length` or more give
    the windows that start in the reference.
 4. A window may have its first copy in a document other than its anchors' references. Windows around shared anchors that no automaton
    matched are therefore compared by 64-bit hashes, first owner wins (an exact check of what the automata left, which is little).

Exact copies of whole texts are settled by whole-text keys in step 1.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, arrow_limits, ids, narrow, stash, utf8
from .hashing import Prefixes, chunks, gram, mix, words
from .winnow import ENTRY, ENTRY_ARROW, Owners, anchors, by_group, cover, entries, inside, owners, shorten, sized, to_batch, whole_keys

SHARD_WORDS = 50_000
BROADCAST_BYTES = 32 << 20

RESULT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]
RESULT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
FIRST = pa.schema([("g", pa.int64()), ("row", pa.int64()), ("open", pa.bool_()), *RESULT, ("text", pa.binary()), ("pos", pa.binary()), ("ref", pa.binary())])
FIRST_DDL = f"g long, row long, open boolean, {RESULT_DDL}, text binary, pos binary, ref binary"
HITS_DDL = "g long, row long, starts binary"
HITS = pa.schema([("g", pa.int64()), ("row", pa.int64()), ("starts", pa.binary())])


class SuffixAutomaton:
    """Suffix automaton over hashable units: every substring of what was added leads from state 0 to some state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size, self.last = [-1], [0], 0

    def add(self, unit) -> None:
        nxt, link, size = self.next, self.link, self.size
        cur, p = len(nxt), self.last
        nxt.append({})
        size.append(size[p] + 1)
        link.append(0)
        while p >= 0 and unit not in nxt[p]:
            nxt[p][unit] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][unit]
            if size[q] == size[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and nxt[p].get(unit) == q:
                    nxt[p][unit] = clone
                    p = link[p]
        self.last = cur

    def matches(self, units: list) -> list[int]:
        """Matching statistics: for each position, the length of the longest substring that ends there."""
        nxt, link, size = self.next, self.link, self.size
        state = n = 0
        out = []
        for u in units:
            while state and u not in nxt[state]:
                state = link[state]
                n = size[state]
            if u in nxt[state]:
                state = nxt[state][u]
                n += 1
            else:
                n = 0
            out.append(n)
        return out


def automaton_of(passages: list[np.ndarray]) -> SuffixAutomaton:
    """One automaton of several passages; no match runs across two, as a unit of its own stands between."""
    out = SuffixAutomaton()
    for i, p in enumerate(passages):
        for u in p.tolist():
            out.add(u)
        out.add(-1 - i)
    return out


def hashed(body: np.ndarray, at: np.ndarray, prefixes: Prefixes):
    """For ranges a..b of rows: the words' hashes and the rows' offsets among them."""
    for a, b in chunks(at):
        part = body[at[a] : at[b]]
        starts, ends, w_at = words(part, at[a : b + 1] - at[a])
        yield a, b, prefixes.load(part).of(starts, ends), w_at


def units_of(column, prefixes: Prefixes) -> list[np.ndarray]:
    """The word hashes of each row."""
    body, at = utf8(column)
    return [u[s:e] for _, _, u, w_at in hashed(body, at, prefixes) for s, e in zip(w_at[:-1], w_at[1:])]


def found(body: np.ndarray, at: np.ndarray, prefixes: Prefixes, length: int, k: int, bits: int):
    """Anchors of rows of words: row, word position, shortened key; and the rows' word offsets."""
    rows, poss, keys, edges = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    n = 0
    for a, b, u, w_at in hashed(body, at, prefixes):
        pos, key = anchors(u, w_at, length, k)
        row = np.searchsorted(w_at, pos, "right") - 1
        rows.append(row + a)
        poss.append(pos - w_at[row])
        keys.append(shorten(key, bits))
        edges.append(w_at[1:] + n)
        n += len(u)
    return np.concatenate(rows), np.concatenate(poss), np.concatenate(keys), np.concatenate(edges)


def ranges(pos: np.ndarray, before: int, after: int, n: int) -> list[tuple[int, int]]:
    """Union of the ranges pos - before .. pos + after within 0..n; pos ascends."""
    lo, hi = np.maximum(0, pos - before), np.minimum(n, pos + after)
    new = np.append(True, lo[1:] > hi[:-1])
    at = np.flatnonzero(new)
    return list(zip(lo[at].tolist(), hi[np.append(at[1:], len(hi)) - 1].tolist()))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): the words left of each text, joined by one blank.

    Words are runs outside [\\x20\\x09-\\x0D]; matches never cross documents; windows are judged on the input. A null text has no words. A null
    id counts as larger than any other, and rows with equal (or null) ids don't remove from each other. One row for each row of docs; other
    columns aren't read.
    """
    if length < 2:
        raise ValueError("length is 2 at least")
    k = min(5, length - 1)
    reach = length - k
    arrow_limits(docs.sparkSession)
    dealt, bits = sized(narrow(docs, id_col, text_col), 8 << 20)

    def first_anchors(batches):
        prefixes = Prefixes()
        for b in batches:
            body, at = utf8(b.column("text"))
            doc, g = ids(b.column("doc_id")), b.column("g").to_numpy()
            row, _, key, _ = found(body, at, prefixes, length, k, bits)
            whole = shorten(whole_keys([body[s:e].tobytes() for s, e in zip(at[:-1], at[1:])]), bits)
            row = np.concatenate([row, np.arange(len(doc)), np.arange(len(doc))])
            key = np.concatenate([key, whole[:, 0], whole[:, 1]])
            for gid, ks, ds in by_group(g[row], key, doc[row]):
                yield to_batch(entries(gid, ks, ds, bits, 5), ENTRY_ARROW)

    def settle_first(key, left, right):
        gid, owner = key[0].as_py(), Owners(right)
        body, at = utf8(left["text"])
        doc = ids(left["doc_id"])
        row, pos, ks, w_at = found(body, at, Prefixes(), length, k, bits)
        hit = owner.has(ks)
        row, pos, ref = row[hit], pos[hit], owner(ks[hit])
        cut, n = np.searchsorted(row, np.arange(len(doc) + 1)), np.diff(w_at)
        out = []
        for i in range(len(doc)):
            text = body[at[i] : at[i + 1]].tobytes()
            d = int(doc[i]) if doc[i] != NO_ID else None
            who = owner(shorten(whole_keys([text])[0], bits))
            if n[i] >= length and who[0] == who[1] < doc[i]:
                out.append((gid, i, False, *outcome(d, text, np.ones(n[i], bool)), None, None, None))
            elif cut[i] == cut[i + 1]:
                out.append((gid, i, False, *outcome(d, text, np.zeros(n[i], bool)), None, None, None))
            else:
                a, b = cut[i], cut[i + 1]
                out.append((gid, i, True, d, int(n[i]), None, None, None, text, np.diff(pos[a:b], prepend=0).astype(np.uint32).tobytes(), ref[a:b].tobytes()))
        return pa.Table.from_batches([to_batch(out, FIRST)])

    known = owners(dealt.mapInArrow(first_anchors, ENTRY), 5)
    first = stash(dealt.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(settle_first, FIRST_DDL), "automata1", "zstd")
    open_ = first.where("open").select("g", "row", "doc_id", "text", "pos", "ref")

    def places(blob):
        return np.cumsum(np.frombuffer(blob.as_buffer(), np.uint32), dtype=np.int64)

    def rows_of(batch, prefixes: Prefixes):
        doc, units = ids(batch.column("doc_id")), units_of(batch.column("text"), prefixes)
        for i, (g, row, p, r) in enumerate(zip(*(batch.column(c) for c in ("g", "row", "pos", "ref")))):
            yield int(doc[i]), g.as_py(), row.as_py(), units[i], places(p), np.frombuffer(r.as_buffer(), np.int64)

    def shards(batches):
        """Reference shards: (ref, shard, passages as their lengths and units)."""
        prefixes = Prefixes()
        schema = pa.schema([("ref", pa.int64()), ("shard", pa.int64()), ("lengths", pa.binary()), ("units", pa.binary())])
        for b in batches:
            out = []
            for d, g, row, units, pos, ref in rows_of(b, prefixes):
                own = pos[ref == d]
                if not len(own) or d == NO_ID:
                    continue
                pieces: list[np.ndarray] = []
                held = number = 0
                for s, e in ranges(own, reach, length, len(units)):
                    while s < e:
                        stop = min(e, s + SHARD_WORDS - held)
                        if stop - s < min(length, e - s):  # no room for a window
                            stop = s
                        else:
                            pieces.append(units[s:stop])
                            held += stop - s
                        if stop < e:
                            out.append((d, number, np.array([len(p) for p in pieces], np.int64).tobytes(), b"".join(p.tobytes() for p in pieces)))
                            pieces, held, number = [], 0, number + 1
                            s = max(s, stop - length + 1)
                        else:
                            s = e
                if pieces:
                    out.append((d, number, np.array([len(p) for p in pieces], np.int64).tobytes(), b"".join(p.tobytes() for p in pieces)))
            yield to_batch(out, schema)

    def passages(batches):
        """What documents have around anchors of others' references: (ref, g, row, starts and lengths of the passages, units)."""
        prefixes = Prefixes()
        schema = pa.schema([("ref", pa.int64()), ("g", pa.int64()), ("row", pa.int64()), ("spans", pa.binary()), ("mine", pa.binary())])
        for b in batches:
            out = []
            for d, g, row, units, pos, ref in rows_of(b, prefixes):
                for r, p in by_group(ref[ref < d], pos[ref < d]):
                    spans = ranges(p, reach, length, len(units))
                    out.append((r, g, row, np.array(spans, np.int64).tobytes(), b"".join(units[s:e].tobytes() for s, e in spans)))
            yield to_batch(out, schema)

    def stream(batches):
        """Matching statistics of the passages in the automaton of their shard: the starts of matched windows."""
        key = automaton = None
        for b in batches:
            out = []
            for i in range(b.num_rows):
                ref, lengths, units, g, row, spans, mine = (b.column(c)[i] for c in ("ref", "lengths", "units", "g", "row", "spans", "mine"))
                own = (ref.as_py(), lengths.as_py(), units.as_py())
                if own != key:
                    parts = np.split(np.frombuffer(own[2], np.uint64), np.cumsum(np.frombuffer(own[1], np.int64))[:-1])
                    key, automaton = own, automaton_of(parts)
                sizes, text = np.frombuffer(spans.as_buffer(), np.int64).reshape(-1, 2), np.frombuffer(mine.as_buffer(), np.uint64)
                starts, at = [], 0
                for s, e in sizes:
                    stat = np.array(automaton.matches(text[at : at + e - s].tolist()))
                    starts.append(np.flatnonzero(stat >= length) - length + 1 + s)
                    at += e - s
                all_ = np.concatenate(starts)
                if len(all_):
                    out.append((g.as_py(), row.as_py(), all_.astype(np.uint32).tobytes()))
            yield to_batch(out, HITS)

    reference = stash(open_.mapInArrow(shards, "ref long, shard long, lengths binary, units binary"), "shards", "zstd")
    size = reference.agg(F.coalesce(F.sum(F.octet_length("units") + F.octet_length("lengths")), F.lit(0))).first()[0]
    streams = open_.mapInArrow(passages, "ref long, g long, row long, spans binary, mine binary")
    met = streams.join(F.broadcast(reference) if size <= BROADCAST_BYTES else reference.hint("merge"), "ref")
    if size <= BROADCAST_BYTES:
        met = met.sortWithinPartitions("ref", "shard")
    hits = stash(met.mapInArrow(stream, HITS_DDL), "hits")

    def state(left, right):
        """Of a group: bytes, offsets, ids, units, their offsets, matched starts (by row), and the windows left for the exact check."""
        body, at = utf8(left["text"])
        doc = ids(left["doc_id"])
        units = units_of(left["text"], Prefixes())
        w_at = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
        place = {r: i for i, r in enumerate(left["row"].to_pylist())}
        matched = np.zeros(int(w_at[-1]), bool)
        for row, starts in zip(right["row"].to_pylist(), right["starts"]):
            if row is not None:
                matched[np.frombuffer(starts.as_buffer(), np.uint32).astype(np.int64) + w_at[place[row]]] = True
        lo, hi = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (p, r) in enumerate(zip(left["pos"], left["ref"])):
            pos, ref = places(p), np.frombuffer(r.as_buffer(), np.int64)
            pos = pos[ref < doc[i]]
            lo.append(np.maximum(0, pos - reach) + w_at[i])
            hi.append(pos + 1 + w_at[i])
        flat = np.concatenate([np.zeros(0, np.uint64), *units])
        left_over = cover(np.concatenate(lo), np.concatenate(hi), len(flat)) & ~matched
        left_over = left_over[: max(0, len(flat) - length + 1)] & inside(w_at, length, len(flat))
        start = np.flatnonzero(left_over)
        h = mix(gram(flat, length)[start]) if len(start) else np.zeros(0, np.uint64)
        return body, at, doc, w_at, matched, start, h, np.searchsorted(w_at, start, "right") - 1

    def leftovers(key, left, right):
        if not left.num_rows:
            return pa.Table.from_batches([to_batch([], ENTRY_ARROW)])
        _, _, doc, _, _, _, h, row = state(left, right)
        return pa.Table.from_batches([to_batch(entries(key[0].as_py(), h, doc[row], bits, 8), ENTRY_ARROW)])

    def settle_all(_, left, right):
        schema = pa.schema(RESULT)
        if not left.num_rows:
            return pa.Table.from_batches([to_batch([], schema)])
        body, at, doc, w_at, matched, start, h, row = state(left, right)
        owner = Owners(right.filter(pa.compute.is_valid(right["keys"])))
        matched[start[owner(h) < doc[row]]] = True
        first_of = np.flatnonzero(matched)
        gone = cover(first_of, first_of + length, len(matched))
        out = [outcome(int(doc[i]) if doc[i] != NO_ID else None, body[at[i] : at[i + 1]].tobytes(), gone[w_at[i] : w_at[i + 1]]) for i in range(len(doc))]
        return pa.Table.from_batches([to_batch(out, schema)])

    last = owners(open_.groupBy("g").cogroup(hits.groupBy("g")).applyInArrow(leftovers, ENTRY), 8)
    sent = hits.select("g", "row", "starts", *(F.lit(None).cast(t).alias(c) for c, t in (("keys", "binary"), ("docs", "binary"), ("base", "long"))))
    sent = sent.unionByName(last.select("g", F.lit(None).cast("long").alias("row"), F.lit(None).cast("binary").alias("starts"), "keys", "docs", "base"))
    names = [n for n, _ in RESULT]
    rest = open_.groupBy("g").cogroup(sent.groupBy("g")).applyInArrow(settle_all, RESULT_DDL)
    return first.where("not open").select(*names).unionByName(rest)


def outcome(doc: int | None, text: bytes, gone: np.ndarray) -> tuple:
    """A row of RESULT; gone: the words to remove."""
    parts = text.split()
    if gone.any():
        parts = [w for w, g in zip(parts, gone.tolist()) if not g]
    kept = b" ".join(parts)
    return doc, len(gone), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()
