"""Near copies: texts whose sets of word shingles have a Jaccard similarity of `similarity` or more, found in two rounds.

 1. SimHashes of the word sets go through the vantage-point trees of simhash; what meets there is verified. This joins most near copies at
    little cost, but a fingerprint can't promise all.
 2. An exact round finds the rest. In an order that all sets have in common, rarest shingles first, two sets of the similarity share one of
    their first n - ceil(similarity * n) + 1 shingles, and at the first one they share neither stands too far back. Shingles go as packed keys to
    the partition of their key; only those of several texts come back as rows. Small groups give the pairs that sizes and places allow. In a
    large group every text is first compared with a pivot, the one at whose place the shingle stands foremost, which is the base of many edits.
    Of the parts that are left in it then, those pairs go on that sizes and places allow, if they are few for the group's size; else the
    texts meet in blocks.

A pair is verified in two steps: numbers of shingles by hash buckets bound what two sets can share from above, and only pairs that pass bring
the sets themselves together.

Everything is keyed by the text's word sequence, not by its id, so rows with equal ids and different texts are different points.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, drop_stash, free_name, give_back, narrow, stash, thrifty, utf8
from .hashing import Prefixes, chunks, gram, mix, words
from .simhash import BROADCAST_ROWS, routed, stars
from .winnow import pack_keys, unpack_keys

#: For the order of shingles: texts sampled, and frequent shingles known at most; they only order, any choice gives the same links.
TEXTS, FREQUENT = 10_000, 300_000
#: Groups of up to SMALL texts go on as pairs, larger ones if they have up to EACH pairs a text, else in blocks of BLOCK shingles. Bytes of entries for a
#: partition of keys.
SMALL, EACH, BLOCK, PART_BYTES = 24, 32, 2_000_000, 2 << 20
#: Bits by which word sets may differ in round 1, bits between shingle sets, and partners a point puts forward.
RADIUS, APART, NEAREST = 7, 14, 2

ENTRY = "p int, keys binary, wholes binary, sizes binary, places binary"


class Shingles:
    """Of a column of texts, row by row: the hash of its lower-case word sequence, its distinct words' hashes, its distinct shingles' hashes (sorted)."""

    def __init__(self, k: int) -> None:
        self.k, self.prefixes = k, Prefixes()

    def __call__(self, column):
        body, at = utf8(pc.utf8_lower(column))
        for a, b in chunks(at):
            part = body[at[a] : at[b]]
            starts, ends, w_at = words(part, at[a : b + 1] - at[a])
            units = self.prefixes.load(part).of(starts, ends)
            grams = mix(gram(units, self.k))
            for s, e in zip(w_at[:-1].tolist(), w_at[1:].tolist()):
                own = units[s:e]
                if e - s >= self.k:
                    made = np.unique(grams[s : e - self.k + 1])
                else:
                    made = mix(gram(own, e - s)) if e > s else own
                yield int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64)) if e > s else 0, own, made


def bits_of(h: np.ndarray) -> int:
    """SimHash of a set of hashes."""
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall in each of a power of two of buckets, about four a bucket."""
    size = max(16, 1 << max(0, (len(shingles) - 1) // 4).bit_length())
    return np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint16)


def share_at_most(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the shingles that the sets of two sketches have in common."""
    if len(a) > len(b):
        a, b = b, a
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0)).sum())


def prefix(shingles: np.ndarray, similarity: float, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of which two sets with that similarity share one at least, in the common order."""
    n = len(shingles)
    f = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        f = np.where(frequent[at] == shingles, counts[at], 0)
    take = min(n, n - math.ceil(similarity * n - 1e-9) + 1)
    return shingles[np.lexsort((shingles * np.uint64(0x9E3779B97F4A7C15), f))[:take]]


def frequent_shingles(plain: DataFrame, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of texts has three times or more, and how often."""

    def run(batches):
        made = Shingles(k)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *(x for _, _, x in made(b.column("text")))]).view(np.int64))], ["token"])

    share = (1 << 20) * TEXTS // max(1, n)
    some = plain.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("text")
    found = some.mapInArrow(thrifty(run), "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 2").limit(FREQUENT).toArrow()
    token, n = found["token"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


# --- round 1 --------------------------------------------------------------------------------------------------------------------


def nearest_pairs(_, table):
    """Of a shard of the trees: for each point its nearest by the shingles' SimHash, and the smallest points at half that distance and at all of it."""
    order = np.argsort(table["whole"].to_numpy())
    fp, fine = (table[c].to_numpy()[order].view(np.uint64) for c in ("fp", "fine"))
    whole, rows = table["whole"].to_numpy()[order], np.flatnonzero(table["home"].to_numpy()[order])
    step = max(1, (1 << 20) // max(1, len(fp)))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(rows), step):
        own = rows[i : i + step]
        near = np.bitwise_count(fp[own, None] ^ fp[None, :]) <= RADIUS
        some = near.sum(axis=1) > 1
        own, near = own[some], near[some]
        if not len(own):
            continue
        at = np.arange(len(own))
        d = np.bitwise_count(fine[own, None] ^ fine[None, :])
        d[~near | (d > APART)] = 255
        d[at, own] = 255
        for most in (APART // 2, APART):
            j = (d <= most).argmax(axis=1)
            ok = d[at, j] <= most
            a.append(own[ok])
            b.append(j[ok])
        for _ in range(NEAREST):
            j = d.argmin(axis=1)
            ok = d[at, j] < 255
            a.append(own[ok])
            b.append(j[ok])
            d[at, j] = 255
    u, v = whole[np.concatenate(a)], whole[np.concatenate(b)]
    give_back()
    return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})


# --- round 2 --------------------------------------------------------------------------------------------------------------------


def packed(k: int, similarity: float, frequent: np.ndarray, counts: np.ndarray, bits: int):
    """For mapInArrow over texts: ENTRY rows of the prefixes' shingles, the texts of a batch together, equal ones once."""

    def run(batches):
        made = Shingles(k)
        for b in batches:
            done, keys, wholes, sizes, places = set(), [], [], [], []
            for whole, _, x in made(b.column("text")):
                if whole in done or not len(x):
                    continue
                done.add(whole)
                own = prefix(x, similarity, frequent, counts)
                keys.append(own)
                wholes.append(whole)
                sizes.append(len(x))
                places.append(np.minimum(np.arange(len(own)), 65535).astype(np.uint16))
            if not keys:
                continue
            many = [len(x) for x in keys]
            key = mix(np.concatenate(keys) + np.uint64(1))
            order = np.argsort(key)
            key = key[order] >> np.uint64(24 - bits)
            whole = np.repeat(np.array(wholes, np.int64), many)[order]
            size, place = np.repeat(np.array(sizes, np.uint32), many)[order], np.concatenate(places)[order]
            cut = np.concatenate([[0], np.searchsorted(key, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(40)), [len(key)]])
            rows = [(p, pack_keys(key[s:e], 5), whole[s:e].tobytes(), size[s:e].tobytes(), place[s:e].tobytes()) for p, (s, e) in enumerate(zip(cut[:-1], cut[1:])) if e > s]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], ["p", "keys", "wholes", "sizes", "places"])

    return run


def shared(key, table):
    """For applyInArrow over a partition's entries: the shingles that several texts have, as rows (token, whole, size, place)."""
    joined = lambda c, t: np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[c]])
    keys = np.concatenate([unpack_keys(x.as_buffer(), 5) for x in table["keys"]])
    whole, size, place = joined("wholes", np.int64), joined("sizes", np.uint32), joined("places", np.uint16)
    order = np.lexsort((whole, keys))
    keys, whole = keys[order], whole[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (whole[1:] != whole[:-1]))
    keys, whole, order = keys[new], whole[new], order[new]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    many = np.diff(np.append(first, len(keys)))
    keep = np.repeat(many > 1, many)
    token = keys[keep] | np.uint64(key[0].as_py() << 40)
    give_back()
    return pa.table({"token": token.view(np.int64), "whole": whole[keep], "size": size[order[keep]].astype(np.int64), "place": place[order[keep]].astype(np.int32)})


def by_token(batches):
    """The columns of all rows of some tokens at a time; batches come in order of token."""
    held: list = []
    for b in batches:
        if not b.num_rows:
            continue
        columns = [c.to_numpy() for c in b.columns]
        token = columns[0]
        cut = int(np.searchsorted(token, token[-1]))
        if cut:
            yield [np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns])]
            held = [[c[cut:] for c in columns]]
        elif held and held[-1][0][0] == token[0]:
            held.append(columns)
        else:
            if held:
                yield [np.concatenate(c) for c in zip(*held)]
            held = [columns]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def groups_of(token: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each token's rows, where they are of several parts."""
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    many = np.diff(np.append(start, len(token)))
    mixed = np.minimum.reduceat(part, start) != np.maximum.reduceat(part, start)
    return start[mixed], many[mixed]


def possible(similarity: float, size: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Can texts a and b be similar, if this is the first shingle that they share?"""
    rest = np.minimum(size[a] - place[a], size[b] - place[b])
    return rest * (1 + similarity) >= similarity * (size[a] + size[b]) - 1e-6


def meetings(similarity: float):
    """For mapInArrow over (token, whole, part, size, place) in order of token: pairs (u, v) to be verified. Large groups give the pairs with their pivots only."""

    def run(batches):
        for token, whole, part, size, place in by_token(batches):
            start, many = groups_of(token, part)
            us, vs = [], []
            for m in np.unique(many):
                s = start[many == m]
                if m <= SMALL:
                    a, b = np.triu_indices(m, 1)
                    a, b = (s[:, None] + a).ravel(), (s[:, None] + b).ravel()
                else:
                    rows = s[:, None] + np.arange(m)
                    pivot = rows[np.arange(len(s)), (place[rows].astype(np.int64) << 32 | np.arange(m)).argmin(axis=1)]
                    a, b = rows.ravel(), np.repeat(pivot, m)
                ok = (part[a] != part[b]) & possible(similarity, size, place, a, b)
                us.append(np.maximum(whole[a[ok]], whole[b[ok]]))
                vs.append(np.minimum(whole[a[ok]], whole[b[ok]]))
            u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def remaining(similarity: float):
    """For mapInArrow over (token, whole, part, size, place) in order of token: what is left of the large groups. Pairs (u, v) with no token, if they are up
    to EACH times the texts; else each text that has a possible partner, in every cell of two blocks that it is in."""

    def run(batches):
        none = lambda n: pa.nulls(n, pa.int64())
        names = ["u", "v", "token", "cell", "block"]
        for token, whole, part, size, place in by_token(batches):
            start, many = groups_of(token, part)
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, m in zip(start[many > SMALL].tolist(), many[many > SMALL].tolist()):
                here, found, live, left = slice(s, s + m), [], np.zeros(m, bool), EACH * m
                rest, all_, own = (size - place)[here], size[here], part[here]
                step = max(1, (1 << 22) // m)
                for i in range(0, m, step):
                    ok = np.minimum(rest[i : i + step, None], rest) * (1 + similarity) >= similarity * (all_[i : i + step, None] + all_) - 1e-6
                    ok &= own[i : i + step, None] != own
                    live[i : i + step] = ok.any(axis=1)
                    left -= np.count_nonzero(ok) // 2
                    if left >= 0:
                        a, b = np.nonzero(ok)
                        found.append(np.stack([a + i, b])[:, a + i < b])
                if left >= 0:
                    a, b = np.concatenate(found, axis=1) + s
                    us.append(np.maximum(whole[a], whole[b]))
                    vs.append(np.minimum(whole[a], whole[b]))
                    continue
                at = np.flatnonzero(live) + s
                block = np.cumsum(size[at]) // BLOCK
                k = int(block[-1]) + 1
                for other in range(k):
                    cell = np.minimum(block, other) * k + np.maximum(block, other)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (whole[at], part[at], token[at], cell, block)], names)
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *(none(len(u)) for _ in range(3))], names)

    return run


def islands(similarity: float):
    """For applyInArrow over the texts (whole, part, block, shingles) of a cell: links (u, v) that join all texts with that similarity.

    Texts of one part are never compared. Each text in turn is compared with all of other parts, those first whose shingles most others have.
    """

    def run(table):
        whole, block = table["whole"].to_numpy(), table["block"].to_numpy()
        part = np.unique(table["part"].to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        size = np.array([len(x) for x in sets])
        flat, start = np.unique(np.concatenate(sets), return_inverse=True)[1], np.append(0, np.cumsum(size))
        often = np.bincount(flat)
        first = np.argsort(-np.add.reduceat(often[flat], start[:-1]) / size, kind="stable")
        two = block.min() != block.max()
        live, bounds, done, held = np.arange(len(whole)), start, np.zeros(len(whole), bool), flat
        mark = np.zeros(len(often), bool)
        out_u, out_v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for count, p in enumerate(first.tolist()):
            done[p] = True
            if count and done[live].sum() * 2 > len(live):
                live = live[~done[live]]
                held = np.concatenate([flat[start[i] : start[i + 1]] for i in live]) if len(live) else flat[:0]
                bounds = np.append(0, np.cumsum(size[live]))
            other = ~done[live] & (part[live] != part[p]) & (np.minimum(size[live], size[p]) >= similarity * np.maximum(size[live], size[p]) - 1e-9)
            if two:
                other &= block[live] != block[p]
            if not other.any():
                continue
            own = flat[start[p] : start[p + 1]]
            mark[own] = True
            if other.sum() * 8 < len(live):
                both = np.array([np.count_nonzero(mark[flat[start[i] : start[i + 1]]]) for i in live[other]])
            else:
                both = np.add.reduceat(mark[held], bounds[:-1], dtype=np.int64)[other]
            mark[own] = False
            at = live[other]
            at = at[both >= similarity * (size[at] + size[p] - both) - 1e-9]
            if len(at):
                out_u.append(np.maximum(whole[at], whole[p]))
                out_v.append(np.minimum(whole[at], whole[p]))
                part[np.isin(part, part[at])] = part[p]
        return pa.table({"u": np.concatenate(out_u), "v": np.concatenate(out_v)})

    return run


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(doc_id, whole, root): for each row the hash of its word sequence, and the smallest such hash of its component; a table of the shared folder."""
    arrow_limits(docs.sparkSession)
    plain = narrow(docs, id_col, text_col)

    def mark(batches):
        made = Shingles(shingle)
        for b in batches:
            rows, known = [], {}
            for whole, own, x in made(b.column("text")):
                if whole not in known:
                    known[whole] = (bits_of(np.unique(own)), bits_of(x), len(x), sketch(x).tobytes()) if whole else (0, 0, 0, b"")
                rows.append((whole, *known[whole]))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], ["doc_id", "whole", "fp", "fine", "size", "sketch"])

    marked = stash(plain.mapInArrow(thrifty(mark), "doc_id long, whole long, fp long, fine long, size long, sketch binary"), "signatures")
    least = marked.groupBy("whole").agg(F.min("doc_id").alias("least"), F.min("fp").alias("fp"), F.min("fine").alias("fine"), F.min("size").alias("size"))
    points = stash(least, "points")
    n, shingles = points.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    side = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df

    def sets(batches):
        made = Shingles(shingle)
        for b in batches:
            rows = [(w, x.tobytes()) for (w, _, x), want in zip(made(b.column("text")), b.column("whole").to_pylist()) if w == want]
            cols = list(zip(*rows)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], ["whole", "shingles"])

    def shingles_of(ends: DataFrame, name: str) -> DataFrame:
        """The shingles of the texts named by ends (whole). Rows whose id is null have no least id: such texts aren't compared."""
        readers = points.where("least is not null").join(ends.distinct().hint("merge"), "whole", "left_semi").select("whole", F.col("least").alias("doc_id"))
        found = plain.join(side(readers, readers.count()), "doc_id").select("whole", "text").mapInArrow(thrifty(sets), "whole long, shingles binary")
        return stash(found.dropDuplicates(["whole"]), name)

    def verify(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("a"), b.column("b")):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def likely(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("a"), b.column("b")):
                x, y = (np.frombuffer(z.as_buffer(), np.uint16).astype(np.int64) for z in (x, y))
                both = share_at_most(x, y)
                keep.append(both >= similarity * (x.sum() + y.sum() - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def beside(pairs: DataFrame, known: DataFrame, what: str) -> DataFrame:
        a, b = (known.select(F.col("whole").alias(x), F.col(what).alias(y)).hint("merge") for x, y in ("ua", "vb"))
        met = pairs.join(a, "u").join(b, "v")
        return met.select("u", "v", "a", "b")

    def verified(pairs: DataFrame, name: str, sketched: bool = True) -> DataFrame:
        if not sketched:  # most of them are links
            return exactly(pairs, name)
        ends = pairs.select(F.col("u").alias("whole")).union(pairs.select("v")).distinct()
        known = stash(marked.select("whole", "sketch").join(side(ends, n), "whole", "left_semi").dropDuplicates(["whole"]), f"{name}-sketches")
        near = stash(beside(pairs, known, "sketch").mapInArrow(thrifty(likely), "u long, v long"), f"{name}-likely")
        drop_stash(known)
        return exactly(near, name)

    def exactly(pairs: DataFrame, name: str) -> DataFrame:
        known = shingles_of(pairs.select(F.col("u").alias("whole")).union(pairs.select("v")), f"{name}-sets")
        out = stash(beside(pairs, known, "shingles").mapInArrow(thrifty(verify), "u long, v long"), f"{name}-links")
        drop_stash(known)
        drop_stash(pairs)
        return out

    live = points.where("least is not null")
    where = routed(live.where("size > 0").select("fp", "fine", "whole"), n, RADIUS)
    found = stash(where.groupBy("tree", "leaf", "shard").applyInArrow(nearest_pairs, "u long, v long").distinct(), "pairs1")
    links = verified(found, "first", sketched=False)
    roots = stars(links)
    drop_stash(links)

    frequent, counts = frequent_shingles(plain, n, shingle)
    bits = min(16, max(6, math.ceil(math.log2(max(1, shingles * (1 - similarity) * 19 / PART_BYTES)))))
    entries = plain.mapInArrow(thrifty(packed(shingle, similarity, frequent, counts, bits)), ENTRY)
    few = max(12, (1 << bits) // 16)  # what is shared is little: a file holds that of 16 partitions
    meet = stash(entries.groupBy("p").applyInArrow(shared, "token long, whole long, size long, place int").coalesce(few), "tokens")

    def met(roots: DataFrame) -> DataFrame:
        named = live.select("whole").join(roots.select(F.col("u").alias("whole"), F.col("v").alias("part")).hint("merge"), "whole", "left").select("whole", F.coalesce("part", "whole").alias("part"))
        rows = meet.join(named.hint("merge"), "whole").select("token", "whole", "part", "size", "place")
        return rows.repartition("token").sortWithinPartitions("token", "whole")

    def joined(roots: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            drop_stash(more)
            return roots
        out = stars(roots.union(more))
        drop_stash(roots)
        drop_stash(more)
        return out

    pairs = stash(met(roots).mapInArrow(meetings(similarity), "u long, v long").distinct(), "pairs2")
    after = joined(roots, verified(pairs, "second"))
    left = stash(met(after).mapInArrow(remaining(similarity), "u long, v long, token long, cell long, block long"), "remaining")
    drop_stash(meet)
    rest = stash(left.where("token is null").select("u", "v").distinct().join(pairs, ["u", "v"], "left_anti"), "pairs3")
    after = joined(after, verified(rest, "third"))
    cells = left.where("token is not null").select(F.col("u").alias("whole"), F.col("v").alias("part"), "token", "cell", "block")
    if not cells.isEmpty():
        known = shingles_of(cells.select("whole"), "cell-sets")
        after = joined(after, stash(cells.join(known, "whole").groupBy("token", "cell").applyInArrow(islands(similarity), "u long, v long"), "cell-links"))
        drop_stash(known)
    for x in (pairs, rest, left):
        drop_stash(x)
    out = stash(marked.select("doc_id", "whole").join(after.select(F.col("u").alias("whole"), F.col("v").alias("root")), "whole", "left").select("doc_id", "whole", F.coalesce("root", "whole").alias("root")), "grouped")
    for x in (marked, points, after):
        drop_stash(x)
    return out


def similar_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id): components of documents whose sets of word shingles have a Jaccard similarity of `similarity` or more.

    Every link is verified by the exact similarity (shingles are compared by 64-bit hashes), and all pairs with that similarity end up joined.
    Words are the runs outside [\\x20\\x09-\\x0D], in lower case; of fewer words than a shingle has, the whole sequence is one. Equal word sequences are
    one point; null texts, empty ones and those without words are equal. component_id is the smallest id of the component. A row with a null id
    joins only rows of equal words. One row for each row of docs; other columns aren't read.
    """
    rows = grouped(docs, id_col, text_col, shingle, similarity)
    return rows.join(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row left of each of similar_components()'s components: the smallest id's, and where rows with that id have different texts
    in one component, the one whose word sequence has the smallest hash. Of repeated equal rows one stays (of rows equal in id and words, any).
    Rows with null ids all stay."""
    rows = grouped(docs, id_col, text_col, shingle, similarity).where("doc_id is not null")
    best = stash(rows.groupBy("root").agg(F.min(F.struct("doc_id", "whole")).alias("best")).select("best.doc_id", "best.whole"), "winners")
    n, distinct = rows.agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    mark = free_name(docs.columns, "whole")
    kept = best.select(F.col("doc_id").alias(id_col), F.col("whole").alias(mark))
    kept = F.broadcast(kept) if best.count() <= BROADCAST_ROWS else kept
    if n == distinct:
        out = docs.join(kept, id_col, "left_semi").select(*docs.columns)
    else:  # an id doesn't name a text here
        names = docs.columns

        def words_of(batches):
            made = Shingles(shingle)
            for b in batches:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([w for w, _, _ in made(b.column(text_col).cast(pa.string()))], pa.int64())], [*names, mark])

        marked = docs.mapInArrow(words_of, docs.select("*", F.lit(0).cast("long").alias(mark)).schema)
        out = marked.join(kept, [id_col, mark], "left_semi").dropDuplicates([id_col, mark]).select(*names)
    return out.unionByName(docs.where(F.col(id_col).isNull()))
