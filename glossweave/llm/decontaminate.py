"""Benchmark decontamination by latent semantic retrieval.

 1. Document frequencies of the benchmark's words are counted over all documents.
 2. TF-IDF rows of the benchmark items and of all passages of all documents go through a distributed randomised SVD. Each passage weighs the same, and all
    together BALANCE times what the items weigh at most, so that a corpus of any size leaves the items their part in the axes.
 3. Every window of every whole text is projected and compared with all items: candidates have a cosine of at least `cosine` and cover at
    least `cover` of the item along its own direction.
    Items of words that most documents have, whose vectors say little, take every window that holds enough of their words; what they have in common
    with it must stand within a quarter more words than they have.
 4. A candidate stands if the longest common subsequence of words covers `lcs` of the item, or `paraphrase` of it while the item's answer
    (a column of its own, else its last sentence) is covered by `answer`.

A benchmark of any size is taken in blocks of BLOCK_ITEMS items, so what executors hold has a fixed bound.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, drop_stash, narrow, stash, thrifty, utf8
from .hashing import Prefixes, chunks, words

BLOCK_ITEMS, RANK, OVERSAMPLE, STEP = 2000, 96, 16, 16
#: Words of a passage, passages that are multiplied at once, what an item weighs, what all passages weigh against all items at most.
PASSAGE, SLAB, ITEM_WEIGHT, BALANCE = 64, 256, 9.0, 1.0
#: Bytes of the slices in which the products of tasks are added up.
SLICE_BYTES = 1 << 20
SLOT_BITS = 20
#: An item with fewer words that are rare enough to tell it (and one with less than a quarter of such words) isn't sought by its vector.
FEW_ACTIVE = 3


class Tokens:
    """Hashes of the lower-case alphanumeric words of texts."""

    def __init__(self) -> None:
        keep = np.ones(256, bool)
        keep[[*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = False
        self.letters = np.where(keep, np.arange(256), 32).astype(np.uint8)
        self.prefixes = Prefixes()

    def __call__(self, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = self.letters[body]
        starts, ends, w_at = words(body, at)
        return self.prefixes.load(body).of(starts, ends), w_at

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        body, at = utf8(pc.utf8_lower(pa.array(texts, pa.string())))
        h, w_at = self(body, at)
        return [h[a:b] for a, b in zip(w_at[:-1], w_at[1:])]


class Lexicon:
    """Numbers of known word hashes."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        slot = (self.keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slots[slot] = np.arange(len(self.keys))
        shared, n = np.unique(slot, return_counts=True)
        self.slots[shared[n > 1]] = -2

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """-1 for unknown words."""
        if not len(self.keys):
            return np.full(len(h), -1, np.int32)
        out = self.slots[(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        known = out >= 0
        out[known] = np.where(self.keys[out[known]] == h[known], out[known], -1)
        many = np.flatnonzero(out == -2)
        if len(many):
            at = np.minimum(np.searchsorted(self.keys, h[many]), len(self.keys) - 1)
            out[many] = np.where(self.keys[at] == h[many], at, -1)
        return out


def last_sentence(text: str) -> str:
    parts = [p for p in re.split(r"[.!?\n]+", text) if len(p.split()) >= 2]
    return parts[-1] if parts else text


def lcs(item: list[int], window: list[int]) -> int:
    """Length of the longest common subsequence, 64 and more positions a step in one integer."""
    masks: dict[int, int] = {}
    for i, u in enumerate(item):
        masks[u] = masks.get(u, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for u in window:
        m = masks.get(u)
        if m:
            x = v & m
            v = (v + x | v - x) & full
    return len(item) - v.bit_count()


def frequencies(docs: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """In how many of all documents each known word stands, and the number of documents."""
    size = len(lexicon.keys)

    def run(batches):
        tokens, total, n = Tokens(), np.zeros(size, np.int64), 0
        for b in batches:
            body, at = utf8(pc.utf8_lower(b.column("text")))
            n += b.num_rows
            for lo, hi in chunks(at):
                h, w_at = tokens(body[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                idx = lexicon(h)
                row = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(w_at))
                ok = idx >= 0
                seen = np.unique(row[ok] * size + idx[ok])
                total += np.bincount(seen % size, minlength=size) if size else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["word", "n"])

    out, n = np.zeros(size, np.int64), 0
    for r in docs.select("text").mapInArrow(thrifty(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():  # one row a word of the block
        if r["word"] < 0:
            n = r["n"]
        else:
            out[r["word"]] = r["n"]
    return out, n


def gram_times(words: np.ndarray, sizes: np.ndarray, idf: np.ndarray, q: np.ndarray, z: np.ndarray) -> None:
    """Adds to z the product of X'X and q, X being the TF-IDF rows, of unit length, of passages: their words one behind the other, and how many each has."""
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    for a in range(0, len(sizes), SLAB):
        b = min(a + SLAB, len(sizes))
        own, column = np.unique(words[at[a] : at[b]], return_inverse=True)
        if not len(own):
            continue
        row = np.repeat(np.arange(b - a), sizes[a:b])
        x = np.bincount(row * len(own) + column, minlength=(b - a) * len(own)).reshape(b - a, len(own)).astype(np.float32) * idf[own]
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        x /= np.where(norm > 0, norm, 1)[:, None]
        z[own] += x.T @ (x @ q[own])


def latent(docs: DataFrame, lexicon: Lexicon, idf: np.ndarray, items: list[np.ndarray], rank: int) -> np.ndarray:
    """Right singular vectors (word by axis) of the TF-IDF rows of items and of all passages, by randomised range finding with two power steps. The passages'
    known words are written once and read three times; tasks' products are added up slice by slice, so what comes to the driver is one product."""
    size = len(lexicon.keys)
    rank = max(1, min(rank, size))
    width = min(size, rank + OVERSAMPLE)
    kind = np.uint16 if size <= 1 << 16 else np.int32

    def cut(batches):
        tokens = Tokens()
        for b in batches:
            body, at = utf8(pc.utf8_lower(b.column("text")))
            out, sizes = [], []
            for lo, hi in chunks(at):
                h, w_at = tokens(body[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                idx, n = lexicon(h), np.diff(w_at)
                if not len(idx):
                    continue
                # Passages end with their text.
                many = -(-n // PASSAGE)
                first = np.concatenate([[0], np.cumsum(many)])[:-1]
                row = np.repeat(np.arange(len(n)), n)
                passage = first[row] + (np.arange(len(idx)) - w_at[row]) // PASSAGE
                known = idx >= 0
                held = np.bincount(passage[known], minlength=int(many.sum()))
                out.append(idx[known].astype(kind).tobytes())
                sizes.append(held[held > 0].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(sizes, pa.binary())], ["words", "sizes"])

    rows = stash(docs.select("text").mapInArrow(thrifty(cut), "words binary, sizes binary"), "passages")
    passages = rows.agg(F.sum(F.octet_length("sizes"))).first()[0] or 0
    own, sizes = [x for x in items if len(x)], [len(x) for x in items if len(x)]
    share = min(1.0, BALANCE * ITEM_WEIGHT * len(own) / passages) if passages else 0.0
    step = max(1, SLICE_BYTES // (4 * width))

    def times(q: np.ndarray) -> np.ndarray:
        def multiply(batches):
            z = np.zeros((size, width), np.float32)
            for b in batches:
                for w, n in zip(b.column("words"), b.column("sizes")):
                    gram_times(np.frombuffer(w.as_buffer(), kind), np.frombuffer(n.as_buffer(), np.uint8), idf, q, z)
            parts = [z[a : a + step].tobytes() for a in range(0, size, step)]
            of = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([of] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["slice", "part", "z"])

        def added(t: pa.Table) -> pa.Table:
            t = t.sort_by("part")  # in one order, so reruns agree
            total = sum(np.frombuffer(z.as_buffer(), np.float32).astype(np.float64) for z in t.column("z"))
            return pa.table({"slice": t.column("slice")[:1], "z": pa.array([total.tobytes()], pa.binary())})

        z = np.zeros((size, width), np.float32)
        if own:
            gram_times(np.concatenate(own), np.array(sizes), idf, q, z)
        z = z * ITEM_WEIGHT
        if passages:
            got = rows.mapInArrow(thrifty(multiply), "slice int, part int, z binary").groupBy("slice").applyInArrow(added, "slice int, z binary")
            for r in got.collect():  # one product: the block's words by width
                part = np.frombuffer(r["z"], np.float64).reshape(-1, width)
                z[r["slice"] * step : r["slice"] * step + len(part)] += share * part
        return z

    q = np.random.default_rng(5).standard_normal((size, width)).astype(np.float32)
    for _ in range(2):
        q = np.linalg.qr(times(q))[0].astype(np.float32)
    values, turn = np.linalg.eigh(q.T @ times(q))
    drop_stash(rows)
    return (q @ turn[:, np.argsort(-values)[:rank]]).astype(np.float32)


class Index:
    """What a task needs to search one block of items: words, latent axes, item vectors."""

    def __init__(self, item_ids: list[int], items: list[np.ndarray], answers: list[np.ndarray], lexicon: Lexicon, axes: np.ndarray, idf: np.ndarray) -> None:
        self.ids, self.lexicon = item_ids, lexicon
        self.items, self.answers = [x.tolist() for x in items], [x.tolist() for x in answers]
        self.words = (axes * idf[:, None]).astype(np.float32)
        self.active = idf > 0.5
        vec = np.array([self.words[x[self.active[x]]].sum(axis=0) for x in items]) if items else np.zeros((0, axes.shape[1]), np.float32)
        self.norm = np.sqrt((vec**2).sum(axis=1))
        self.unit = (vec / np.maximum(self.norm, 1e-9)[:, None]).astype(np.float32)
        self.blocks = np.array([-(-(len(x) + STEP) // STEP) for x in items], int)
        some = np.array([len(x) > 0 for x in items], bool)
        # What a vector of so few words points at is lost among the words around it; such items are found by counting words.
        few = np.array([self.active[x].sum() < max(FEW_ACTIVE, 0.25 * len(x)) for x in items], bool) | (self.norm <= 1e-6)
        self.usable, self.plain = some & ~few, np.flatnonzero(some & few)
        self.common = set(self.plain.tolist())

    def candidates(self, idx: np.ndarray, w_at: np.ndarray, cosine: float, cover: float, least: float):
        """Row, item, first and last word of candidate windows, and their cosines; for items of common words the share of a window's words that are the
        item's. These are all windows in which as many words are the item's as a common subsequence of the share least needs."""
        row_blocks = -(-np.diff(w_at) // STEP)
        b_at = np.concatenate([[0], np.cumsum(row_blocks)])
        n = int(b_at[-1])
        if not n:
            return
        b_row = np.repeat(np.arange(len(row_blocks)), row_blocks)
        b_start = w_at[b_row] + (np.arange(n) - b_at[b_row]) * STEP
        ok = np.flatnonzero(idx >= 0)
        ok = ok[self.active[idx[ok]]]
        sums = np.zeros((n + 1, self.words.shape[1]), np.float32)
        if len(ok):
            block = np.searchsorted(b_start, ok, "right") - 1
            first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            sums[block[first] + 1] = np.add.reduceat(self.words[idx[ok]], first, axis=0)
        np.cumsum(sums, axis=0, out=sums)
        end_of_row = b_at[b_row + 1]
        for nb in np.unique(self.blocks[self.usable]):
            which = np.flatnonzero(self.usable & (self.blocks == nb))
            start = np.flatnonzero((np.arange(n) + nb <= end_of_row) | (np.arange(n) == b_at[b_row]))
            end = np.minimum(start + nb, end_of_row[start])
            window = sums[end] - sums[start]
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            dot = window @ self.unit[which].T
            hit = (dot >= cosine * np.maximum(norm, 1e-9)[:, None]) & (dot >= cover * self.norm[which])
            for w, j in zip(*np.nonzero(hit)):
                r = b_row[start[w]]
                yield int(r), int(which[j]), int(b_start[start[w]]), int(min(b_start[start[w]] + nb * STEP, w_at[r + 1])), float(dot[w, j] / norm[w])
        for j in self.plain.tolist():
            mine = np.concatenate([[0], np.cumsum(np.isin(idx, self.items[j]))])
            nb = int(self.blocks[j])
            start = np.flatnonzero((np.arange(n) + nb <= end_of_row) | (np.arange(n) == b_at[b_row]))
            from_, to = b_start[start], np.minimum(b_start[start] + nb * STEP, w_at[b_row[start] + 1])
            near = np.maximum(from_ - STEP // 2, w_at[b_row[start]]), np.minimum(to + STEP // 2, w_at[b_row[start] + 1])
            both = mine[near[1]] - mine[near[0]]
            for w in np.flatnonzero(both >= max(1, least * len(self.items[j]))):
                yield int(b_row[start[w]]), j, int(from_[w]), int(to[w]), float(both[w] / (near[1][w] - near[0][w]))


def hits_of(column, index: Index, tokens: Tokens, p: dict):
    """For each row and item that stand: row, item number, cosine, LCS share, answer share, words of the window from, to."""
    body, at = utf8(pc.utf8_lower(column))
    for a, b in chunks(at):
        h, w_at = tokens(body[at[a] : at[b]], at[a : b + 1] - at[a])
        idx = index.lexicon(h)
        best: dict[tuple[int, int], tuple] = {}
        for r, j, s, e, c in index.candidates(idx, w_at, p["cosine"], p["cover"], p["paraphrase"]):
            item, answer = index.items[j], index.answers[j]
            s, e = max(int(w_at[r]), s - STEP // 2), min(int(w_at[r + 1]), e + STEP // 2)
            if j in index.common:  # such words stand everywhere: only what stands close together counts
                size = len(item) + max(2, len(item) // 4)
                s = max(range(s, max(s, e - size) + 1), key=lambda k: lcs(item, idx[k : k + size].tolist()))
                e = min(e, s + size)
            window = idx[s:e].tolist()
            share = lcs(item, window) / len(item)
            if share < p["paraphrase"]:
                continue
            told = lcs(answer, window) / len(answer) if answer else 0.0
            if (share >= p["lcs"] or told >= p["answer"]) and (share, told) > best.get((r, j), (0.0, 0.0))[:2]:
                best[r, j] = (share, told, c, s - int(w_at[r]), e - int(w_at[r]))
        for (r, j), (share, told, c, s, e) in sorted(best.items()):
            yield a + r, j, c, share, told, s, e


def indexes(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, answer_col: str | None, rank: int) -> list[Index]:
    """One index for each block of items. The benchmark is read block by block, each bounded by BLOCK_ITEMS."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"), answer.alias("answer"))
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    rows, out = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), []
    for k in range(blocks):
        got = sorted(rows.where(F.col("block") == k).collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        tokens = Tokens()
        raw = tokens.of([r["text"] for r in got])
        lexicon = Lexicon(np.concatenate(raw) if raw else np.zeros(0, np.uint64))
        items = [lexicon(h) for h in raw]
        answers = [lexicon(h) for h in tokens.of([r["answer"] or last_sentence(r["text"] or "") for r in got])]
        if not len(lexicon.keys):
            continue
        df, n = frequencies(docs, lexicon)
        idf = np.log((n + 1) / (df + 1)).astype(np.float32)
        out.append(Index([r["item_id"] for r in got], items, answers, lexicon, latent(docs, lexicon, idf, items, rank), idf))
    return out


DEFAULTS = {"cosine": 0.3, "cover": 0.5, "lcs": 0.8, "paraphrase": 0.6, "answer": 0.9}


def search(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None, rank: int = RANK, **limits: float) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, first_word, last_word): every document and item that the document leaks, with the best window.

    Of windows that are equally good the first counts. Null and empty texts on either side match nothing; repeated documents and items each give rows; null ids stay null. Word numbers count the
    alphanumeric words of the text. limits: cosine, cover, lcs, paraphrase, answer (DEFAULTS).
    """
    arrow_limits(docs.sparkSession)
    plain, p = narrow(docs, id_col, text_col), DEFAULTS | limits
    found = indexes(plain, benchmark, item_col, item_text_col, answer_col, rank)
    ddl = "doc_id long, item_id long, cosine double, lcs double, answer double, first_word long, last_word long"
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def runner(index: Index):
        def run(batches):
            tokens = Tokens()
            for b in batches:
                doc = b.column("doc_id").to_pylist()
                rows = [(doc[r], index.ids[j], round(c, 4), share, told, s, e) for r, j, c, share, told, s, e in hits_of(b.column("text"), index, tokens, p)]
                cols = list(zip(*rows)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "item_id", "cosine", "lcs", "answer", "first_word", "last_word"])

        return run

    out = docs.sparkSession.createDataFrame([], ddl)
    for i, index in enumerate(found):
        part = plain.mapInArrow(thrifty(runner(index)), ddl)
        out = part if not i else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None, rank: int = RANK, **limits: float) -> DataFrame:
    """The rows of docs, all columns, that leak no item of the benchmark."""
    arrow_limits(docs.sparkSession)
    p = DEFAULTS | limits

    def runner(index: Index):
        def run(batches):
            tokens = Tokens()
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[h[0] for h in hits_of(b.column(text_col).cast(pa.string()), index, tokens, p)]] = False
                yield b.filter(pa.array(keep))

        return run

    out = docs
    for index in indexes(narrow(docs, id_col, text_col), benchmark, item_col, item_text_col, answer_col, rank):
        out = out.mapInArrow(thrifty(runner(index)), docs.schema)
    return out
