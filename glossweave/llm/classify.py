"""Two text classifiers fitted on a bounded sample of labelled rows and applied to every whole text.

Quality: Naive Bayes support vectors. Features are indicators of byte n-grams and of the rate levels of character-class trigrams; they are
scaled by class log-count ratios, and a linear hinge-loss model is fitted by dual coordinate descent, then calibrated to 0..1.

Toxicity: logistic model over words and word beginnings. Labelled texts in which identity terms occur are written again with other terms
(and with a neutral one) in their place; squared score changes between a text and its counterfactuals are part of the loss, so that group
mentions weigh as little as neutral words.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, narrow, thrifty, utf8
from .hashing import Prefixes, chunks, gram, mix, words

#: Labelled rows that a fit uses at most (those with the smallest hashes of their ids).
SAMPLE_ROWS, QUALITY_ROWS = 4000, 2500

# Terms for groups of people, by language, and neutral stand-ins.
IDENTITY = {
    "en": "women men woman man girls boys muslims muslim christians christian jews jewish hindus buddhists catholics atheists blacks black whites white asians asian africans african latinos hispanic arabs immigrants refugees gay lesbian bisexual transgender queer straight disabled deaf blind elderly young americans mexicans chinese indians".split(),
    "de": "frauen männer muslime christen juden ausländer flüchtlinge schwule lesben behinderte türken".split(),
    "fr": "femmes hommes musulmans chrétiens juifs immigrés réfugiés gays lesbiennes handicapés arabes".split(),
    "es": "mujeres hombres musulmanes cristianos judíos inmigrantes refugiados gais lesbianas discapacitados gitanos".split(),
}
NEUTRAL = {"en": "people", "de": "menschen", "fr": "gens", "es": "personas"}


@dataclass
class Linear:
    """Weights by feature, intercept, and the line that turns a margin into log odds; norms: each feature's share of a text's squared length, if margins are scaled by that."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    norms: np.ndarray | None = None

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def held_out(doc_id):
    """crc32 of the id as text, modulo 3, is 1; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


# --- features -------------------------------------------------------------------------------------------------------------------

GRAM_BITS, LEVELS = 17, 12


def char_classes() -> np.ndarray:
    kinds = np.full(256, 5, np.uint8)  # other ASCII
    for lo, hi, k in ((65, 90, 0), (97, 122, 1), (48, 57, 2), (9, 13, 3), (32, 32, 3), (128, 255, 4)):
        kinds[lo : hi + 1] = k
    kinds[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 6  # common marks
    return kinds


class QualityFeatures:
    """Indicators of byte n-grams of 2 to 4 and of the rate levels of character-class trigrams."""

    size = (1 << GRAM_BITS) + 343 * LEVELS

    def __init__(self) -> None:
        self.table = Prefixes().table
        self.kinds = char_classes()

    def __call__(self, body: np.ndarray) -> np.ndarray:
        """Feature numbers of one text, with repeats among the n-grams."""
        units, parts = self.table[body], []
        for n in (2, 3, 4):
            parts.append((mix(gram(units, n)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        k = self.kinds[body].astype(np.int64)
        if len(k) >= 3:
            counts = np.bincount(k[:-2] * 49 + k[1:-1] * 7 + k[2:], minlength=343)
            at = np.flatnonzero(counts)
            level = np.minimum(LEVELS - 1, np.floor(-np.log2(counts[at] / (len(k) - 2)))).astype(np.int64)
            parts.append((1 << GRAM_BITS) + at * LEVELS + level)
        return np.concatenate(parts)


WORD_BITS = 20


class WordFeatures:
    """Hashed words and word beginnings of 3 to 9 bytes, for many texts at once."""

    size = 1 << WORD_BITS

    def __init__(self) -> None:
        self.prefixes = Prefixes()
        keep = np.ones(256, bool)
        keep[[*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = False
        self.letters = np.where(keep, np.arange(256), 32).astype(np.uint8)

    def __call__(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and the row of each; texts come in lower case."""
        body = self.letters[body]
        starts, ends, at = words(body, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
        p, out, rows = self.prefixes.load(body), [], []
        for n in (0, 3, 4, 5, 6, 7, 8, 9):  # 0: the whole word
            ok = slice(None) if not n else ends - starts > n
            s = starts[ok]
            h = p.of(s, ends[ok] if not n else s + n) ^ np.uint64(0x9E3779B97F4A7C15 if n else 0)
            out.append((mix(h) >> np.uint64(64 - WORD_BITS)).astype(np.int64))
            rows.append(row[ok])
        return np.concatenate(out), np.concatenate(rows)


# --- samples --------------------------------------------------------------------------------------------------------------------


def sample_ids(labels: DataFrame, id_col: str, label_col: str, rows: int, balanced: bool) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, y) of at most rows labelled ids that are not held out, and how many there are of each class. An id with both labels counts as 1."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if not balanced:
        return known.orderBy(*order).limit(rows), counts
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(rows // 2) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), counts


def labelled(docs: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """Texts of the chosen ids, twice as many as ids at most: the first by the ids' hashes, so that repeated ids give the same sample on every run.
    The chosen ids are at most SAMPLE_ROWS, so the broadcast has a fixed bound."""
    met = docs.join(F.broadcast(chosen), "doc_id")
    return met.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(2 * rows)


# --- quality --------------------------------------------------------------------------------------------------------------------


def distinct(features: np.ndarray) -> np.ndarray:
    return np.unique(features).astype(np.int32)


def dual_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, size: int, c: float, epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """min |w|^2 / 2 + c * sum of hinge losses, by coordinate descent in the dual. Row i has values[rows[i]] at rows[i], scaled to unit length, and a constant."""
    w, bias = np.zeros(size), 0.0
    scale = np.array([1 / max(1e-9, np.sqrt(v @ v)) for r in rows for v in (values[r],)])
    q = np.array([2.0 if len(r) else 1.0 for r in rows])
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    top = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = values[r] * scale[i]
            g = y[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), top[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton steps on slightly smoothed labels."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g, h = p - t, p * (1 - p) + 1e-9
        m = np.array([[np.sum(h * margins**2) + 1e-3, np.sum(h * margins)], [np.sum(h * margins), np.sum(h) + 1e-3]])
        step = np.linalg.solve(m, np.array([np.sum(g * margins) + 1e-3 * a, np.sum(g)]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = QUALITY_ROWS, c: float = 1.0) -> Linear:
    """NB-SVM of at most rows labelled, not held-out texts; four fifths fit the model, the rest its calibration. Without labels of both classes every score is the share of label 1, or 1/2."""
    arrow_limits(docs.sparkSession)
    chosen, counts = sample_ids(labels, id_col, label_col, rows, balanced=False)

    def run(batches):
        make = QualityFeatures()
        for b in batches:
            body, at = utf8(b.column("text"))
            rows_ = [distinct(make(body[s:e])).tobytes() for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(rows_, pa.binary())], ["doc_id", "y", "features"])

    got = labelled(narrow(docs, id_col, text_col), chosen, rows).mapInArrow(thrifty(run), "doc_id long, y int, features binary").toArrow()
    xs, label = [np.frombuffer(x.as_buffer(), np.int32) for x in got["features"]], got["y"].to_numpy()
    order = sorted(range(len(xs)), key=lambda i, d=got["doc_id"].to_pylist(): (d[i], zlib.crc32(xs[i])))
    xs, y = [xs[i] for i in order], 2 * label[order].astype(np.int64) - 1
    size = QualityFeatures.size
    if len(set(y.tolist())) < 2:
        p = min(0.999, max(0.001, counts.get(1, 0) / max(1, sum(counts.values())))) if counts else 0.5
        return Linear(np.zeros(size, np.float32), 0.0, 1.0, float(np.log(p / (1 - p))))
    fit = np.arange(len(y)) % 5 != 4
    if len(set(y[fit].tolist())) < 2 or len(set(y[~fit].tolist())) < 2:
        fit[:] = True
    counts_of = [np.zeros(size), np.zeros(size)]
    for i in np.flatnonzero(fit):
        counts_of[int(y[i] < 0)][xs[i]] += 1  # a text's features are distinct
    n = [(y[fit] == s).sum() for s in (1, -1)]
    ratio = np.log((counts_of[0] + 1) / (n[0] + 2)) - np.log((counts_of[1] + 1) / (n[1] + 2))
    ratio[counts_of[0] + counts_of[1] < 3] = 0
    pruned = [x[ratio[x] != 0] for x in xs]
    del got, xs
    w, bias = dual_descent([x for x, f in zip(pruned, fit) if f], ratio, y[fit], size, c)
    norms = (ratio**2).astype(np.float32)
    model = Linear((w * ratio).astype(np.float32), bias, norms=norms)
    test = ~fit if not fit.all() else fit
    margins = np.array([model.weights[x].sum() / max(1e-9, np.sqrt(norms[x].sum())) + bias for x, t in zip(pruned, test) if t])
    model.slope, model.shift = platt(margins, y[test])
    return model


def score_quality(docs: DataFrame, model: Linear, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs' columns id and text with score (0..1) and predicted; one row for each row of docs, null and empty texts scored as texts without n-grams."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        scorer = quality_scorer(model)
        for b in batches:
            s = scorer(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], ["doc_id", "text", "score", "predicted"])

    return narrow(docs, id_col, text_col).mapInArrow(thrifty(run), "doc_id long, text string, score double, predicted int")


def quality_scorer(model: Linear):
    """A function from a text column to scores."""
    make, last = QualityFeatures(), np.zeros(QualityFeatures.size, np.int32)
    weights, norms = model.weights, model.norms

    def score(column) -> np.ndarray:
        body, at = utf8(column)
        out = np.full(len(at) - 1, model.bias)
        for i in range(len(out) if norms is not None else 0):
            x = make(body[at[i] : at[i + 1]])
            order = np.arange(len(x), dtype=np.int32)
            last[x] = order  # of equal numbers one stays
            x = x[last[x] == order]
            out[i] = weights[x].sum(dtype=np.float64) / max(1e-9, np.sqrt(norms[x].sum(dtype=np.float64))) + model.bias
        return model.scores(out)

    return score


def keep_quality(docs: DataFrame, model: Linear, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score at least threshold."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        scorer = quality_scorer(model)
        for b in batches:
            yield b.filter(pa.array(scorer(b.column(text_col).cast(pa.string())) >= threshold))

    return docs.mapInArrow(thrifty(run), docs.schema)


# --- toxicity -------------------------------------------------------------------------------------------------------------------


def swaps() -> tuple[re.Pattern, dict[str, list[str]]]:
    """A pattern for any identity term, and for each term what replaces it: the next term of its language and the neutral word."""
    other = {t: [ts[(i + 1) % len(ts)], NEUTRAL[lang]] for lang, ts in IDENTITY.items() for i, t in enumerate(ts)}
    return re.compile(r"\b(" + "|".join(sorted(map(re.escape, other), key=len, reverse=True)) + r")\b"), other


def counterfactuals(text: str, pattern: re.Pattern, other: dict[str, list[str]]) -> list[tuple[str, str]]:
    """Pairs (sentence, the sentence with every identity term replaced) of a text in lower case, two for each sentence that has such a term."""
    if not pattern.search(text):
        return []
    found = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if pattern.search(s)]
    return [(s, pattern.sub(lambda m, k=k: other[m[1]][k], s)) for s in found for k in (0, 1)]


def logistic(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int, l2: float, penalty: float, prior: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Minimise the mean log loss (classes weighed to the prior) + l2 |w|^2 / 2 + penalty * mean squared score change of pairs, by accelerated gradient steps."""
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), np.diff(at))
    share = np.where(y > 0, prior / max(1, (y > 0).sum()), (1 - prior) / max(1, (y <= 0).sum()))
    a_at = np.repeat(np.arange(len(pairs)), [len(a) for a, _ in pairs]) if pairs else np.zeros(0, int)
    b_at = np.repeat(np.arange(len(pairs)), [len(b) for _, b in pairs]) if pairs else np.zeros(0, int)
    a_flat = np.concatenate([a for a, _ in pairs]) if pairs else np.zeros(0, np.int64)
    b_flat = np.concatenate([b for _, b in pairs]) if pairs else np.zeros(0, np.int64)
    w, v = np.zeros(size), np.zeros(size)
    bias = vb = float(np.log(prior / (1 - prior)))
    # Each weight's step comes from a bound of its curvature: the shares of the rows that have it, times their numbers of features.
    curve = 0.25 * np.bincount(flat, (share * np.array([len(r) + 1 for r in rows]))[owner], size) + l2
    if pairs:
        each = np.array([len(a) + len(b) for a, b in pairs])
        curve += 2 * penalty / len(pairs) * (np.bincount(a_flat, each[a_at], size) + np.bincount(b_flat, each[b_at], size))
    rate, rate_b = 1 / curve, 4 / (share @ np.array([len(r) + 1 for r in rows]))
    for t in range(steps):
        z = np.bincount(owner, v[flat], len(rows)) + vb
        g = share * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - (y > 0))
        grad = np.bincount(flat, g[owner], size) + l2 * v
        if pairs:
            d = np.bincount(a_at, v[a_flat], len(pairs)) - np.bincount(b_at, v[b_flat], len(pairs))
            d *= 2 * penalty / len(pairs)
            grad += np.bincount(a_flat, d[a_at], size) - np.bincount(b_flat, d[b_at], size)
        new, new_b = v - rate * grad, vb - rate_b * g.sum()
        k = t / (t + 3)
        v, vb = new + k * (new - w), new_b + k * (new_b - bias)
        w, bias = new, new_b
    return w, bias


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS, l2: float = 2e-5, penalty: float = 0.3, top: int = 20000) -> Linear:
    """Counterfactually regularised logistic model of at most rows labelled, not held-out texts, half of each class where there are enough.

    Features that occur in fewer than 5 of them or whose shares in the classes differ by less than 3 standard errors are left out, unless they
    belong to identity terms' counterfactuals. Without labels of both classes every score is the share of label 1, or 1/2.
    """
    arrow_limits(docs.sparkSession)
    chosen, counts = sample_ids(labels, id_col, label_col, rows, balanced=True)

    def run(batches):
        make, (pattern, other) = WordFeatures(), swaps()
        for b in batches:
            for i in range(b.num_rows):
                text = pc.utf8_lower(b.column("text").slice(i, 1))[0].as_py() or ""
                sets = []
                for t in [text, *(s for pair in counterfactuals(text, pattern, other) for s in pair)]:
                    raw = np.frombuffer(t.encode(), np.uint8)
                    sets.append(distinct(make(raw, np.array([0, len(raw)]))[0]))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, 1), b.column("y").slice(i, 1), pa.array([[s.tobytes() for s in sets]], pa.list_(pa.binary()))], ["doc_id", "y", "features"])

    got = labelled(narrow(docs, id_col, text_col), chosen, rows).mapInArrow(thrifty(run), "doc_id long, y int, features array<binary>").toArrow()
    xs, label = [[np.frombuffer(f.as_buffer(), np.int32) for f in r] for r in got["features"]], got["y"].to_numpy()
    order = sorted(range(len(xs)), key=lambda i, d=got["doc_id"].to_pylist(): (d[i], zlib.crc32(xs[i][0])))
    xs, y = [xs[i] for i in order], label[order]
    prior = min(0.95, max(0.01, counts.get(1, 0) / max(1, sum(counts.values())))) if counts else 0.5
    size = WordFeatures.size
    if len(set(y.tolist())) < 2:
        return Linear(np.zeros(size, np.float32), 0.0, 1.0, float(np.log(prior / (1 - prior))))
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    c0, c1 = np.zeros(size), np.zeros(size)
    for x, k in zip(xs, y):
        (c1 if k else c0)[x[0]] += 1
    pooled = (c1 + c0 + 1) / (n1 + n0 + 2)
    z = np.abs(c1 / n1 - c0 / n0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    z[c1 + c0 < 5] = 0
    for x in xs:
        for a, b in zip(x[1::2], x[2::2]):
            z[np.setxor1d(a, b)] = np.inf
    keep = np.argsort(-z, kind="stable")[:top]
    keep = np.sort(keep[z[keep] >= 3])
    number = np.full(size, -1, np.int64)
    number[keep] = np.arange(len(keep))
    local = [[(m := number[f])[m >= 0] for f in x] for x in xs]
    w, bias = logistic([x[0] for x in local], y, [pair for x in local for pair in zip(x[1::2], x[2::2])], len(keep), l2, penalty, prior)
    weights = np.zeros(size, np.float32)
    weights[keep] = w
    return Linear(weights, bias)


def toxicity_scorer(model: Linear):
    make, size = WordFeatures(), WordFeatures.size
    used = model.weights != 0

    def score(column) -> np.ndarray:
        body, at = utf8(pc.utf8_lower(column))
        out = np.full(len(at) - 1, model.bias)
        for a, b in chunks(at):
            x, row = make(body[at[a] : at[b]], at[a : b + 1] - at[a])
            ok = used[x]
            both = np.unique(row[ok] * size + x[ok])
            out[a:b] += np.bincount(both // size, model.weights[both % size], b - a)
        return model.scores(out)

    return score


def score_toxicity(docs: DataFrame, model: Linear, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs' columns id and text with score (0..1) and predicted; one row for each row of docs, null and empty texts scored as texts without words."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        scorer = toxicity_scorer(model)
        for b in batches:
            s = scorer(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], ["doc_id", "text", "score", "predicted"])

    return narrow(docs, id_col, text_col).mapInArrow(thrifty(run), "doc_id long, text string, score double, predicted int")
