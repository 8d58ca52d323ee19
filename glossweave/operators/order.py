"""Repairs that put a sequence in order: between two neighbours, or over a whole group at once."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranges, sequence
from .tables import keep

BREAK_COST = 4.0


def frame(df: DataFrame, part: str, order: str, word: str, reach: int = 3) -> DataFrame:
    """Rows that stand below the one before, judged in the frame of reach rows on either side: swapped if an exchange of the two puts the frame in order,
    else astray; without_it and without_previous say whether taking out the row, or the one before, would. order is numeric and without ties."""
    near = sequence.neighbours(df.select(part, order, word), part, order, [word], reach, reach)
    words = lambda c: F.transform(c, lambda s: s[word])
    here, back, ahead = F.array(word), F.reverse(words(F.col("_before"))), words(F.col("_after"))
    last = F.array(F.element_at("_before", 1)[word])
    far = F.slice(back, F.lit(1), F.greatest(F.size(back) - 1, F.lit(0)))
    rises = lambda a: F.forall(F.sequence(F.lit(2), F.size(a)), lambda i: F.element_at(a, i) >= F.element_at(a, i - 1)) | (F.size(a) < 2)
    odd = near.where((F.size("_before") > 0) & (F.col(word) < F.try_element_at("_before", F.lit(1))[word]))
    odd = odd.select(part, order, word, F.concat(far, here, last, ahead).alias("_s"), F.concat(far, last, ahead).alias("_l"), F.concat(far, here, ahead).alias("_o"))
    return odd.select(part, order, word, F.when(rises(F.col("_s")), "swapped").otherwise("astray").alias("kind"), rises(F.col("_l")).alias("without_it"), rises(F.col("_o")).alias("without_previous"))


def insertion(odd: DataFrame, df: DataFrame, part: str, order: str, word: str) -> DataFrame:
    """odd with rank (how many words of the part are smaller), after (the largest of them) and before (the smallest larger word).

    Words are counted once; odd words and known ones are merged in runs of first letters, whose sums are carried on, so no part is gathered."""
    known = df.groupBy(part, F.col(word).alias("_w")).agg(F.count("*").alias("_n"))
    wanted = odd.select(part, F.col(word).alias("_w")).distinct().join(known, [part, "_w"], "left").withColumn("_ask", F.lit(True))
    rows = known.join(wanted.select(part, "_w", "_ask"), [part, "_w"], "full_outer").withColumn("_n", F.coalesce("_n", F.lit(0))).withColumn("_run", F.substring("_w", 1, 3))
    inner = Window.partitionBy(part, "_run").orderBy("_w")
    sums = rows.groupBy(part, "_run").agg(F.sum("_n").alias("_s"), F.max(F.when(F.col("_n") > 0, F.col("_w"))).alias("_hi"), F.min(F.when(F.col("_n") > 0, F.col("_w"))).alias("_lo"))
    outer = Window.partitionBy(part).orderBy("_run")
    sums = sums.select(
        part, "_run", F.coalesce(F.sum("_s").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_c"),
        F.max("_hi").over(outer.rowsBetween(Window.unboundedPreceding, -1)).alias("_h"), F.min("_lo").over(outer.rowsBetween(1, Window.unboundedFollowing)).alias("_l"))
    real = F.when(F.col("_n") > 0, F.col("_w"))
    placed = rows.select(
        part, "_run", "_w", "_ask", F.coalesce(F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_k"),
        F.max(real).over(inner.rowsBetween(Window.unboundedPreceding, -1)).alias("_b"), F.min(real).over(inner.rowsBetween(1, Window.unboundedFollowing)).alias("_a"))
    found = placed.where("_ask").join(sums, [part, "_run"]).select(part, F.col("_w").alias(word), (F.col("_k") + F.col("_c")).alias("rank"), F.coalesce("_b", "_h").alias("after"), F.coalesce("_a", "_l").alias("before"))
    return odd.join(found, [part, word])


def sandwich(df: DataFrame, part: str, order: str, word: str, letters: tuple[str, ...], width: int | None = None, changes: int = 1) -> DataFrame:
    """Rows out of order between two ordered neighbours, with the first change (by number of letters, up to changes of 1 or 2, then place, then letter) that puts
    them between.

    width: only the first so many places are changed; None: all. order is numeric and without ties."""
    near = sequence.neighbours(df.select(part, order, word), part, order, [word], 1, 1)
    named = near.select(part, order, word, F.try_element_at("_before", F.lit(1))[word].alias("_b"), F.try_element_at("_after", F.lit(1))[word].alias("_a"))
    odd = named.where("_b is not null and _a is not null and _b <= _a").where(~F.col(word).between(F.col("_b"), F.col("_a")) & (F.length(word) > 0))
    last = F.length(word) if width is None else F.least(F.lit(width), F.length(word))
    alphabet = F.array(*(F.lit(x) for x in letters))
    put = lambda w, i, s: F.concat(F.substring(w, F.lit(1), i - 1), s, F.substring(w, i + 1, F.length(w)))
    w = F.col(word)
    one = F.flatten(F.transform(F.sequence(F.lit(1), last), lambda i: F.transform(alphabet, lambda s: put(w, i, s))))
    fits = lambda c: F.try_element_at(F.filter(c, lambda x: x.between(F.col("_b"), F.col("_a")) & (x != w)), F.lit(1))
    fixed = fits(one)
    if changes > 1:
        pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(last - 1, F.lit(1))), lambda i: F.transform(F.sequence(i + 1, F.greatest(last, i + 1)), lambda j: F.struct(i.alias("i"), j.alias("j")))))
        two = F.flatten(F.transform(F.filter(pairs, lambda p: p["j"] <= last), lambda p: F.flatten(F.transform(alphabet, lambda s: F.transform(alphabet, lambda t: put(put(w, p["i"], s), p["j"], t))))))
        fixed = F.coalesce(fixed, fits(two))
    return odd.withColumn("fixed", fixed).where("fixed is not null").drop("_a", "_b")


def candidates_of(word: str, swap: dict[str, set[str]], cap: int) -> list[tuple[float, str]]:
    """(edits, respelling): the word itself, and every choice of confusable letters at up to two places, fewest edits first; cap of them at most."""
    out = [(0.0, word)]
    single = [(i, s) for i, ch in enumerate(word) for s in sorted(swap.get(ch, ()))]
    out += [(1.0, word[:i] + s + word[i + 1 :]) for i, s in single]
    if len(out) < cap:
        for n, (i, s) in enumerate(single):
            out += [(2.0, word[:i] + s + word[i + 1 : j] + t + word[j + 1 :]) for j, t in single[n + 1 :] if j > i]
            if len(out) >= cap:
                break
    return out[:cap]


def products(df: DataFrame, word: str, confusable: tuple[tuple[str, str], ...], most: int = 2) -> DataFrame:
    """df's rows with variant and changes: every product of choices of confusable letters that changes one to most places, made by exploding a place at a
    time from left to right, so each combination comes up once."""
    swap: dict[str, str] = {}
    for a, b in confusable:
        swap[a] = swap.get(a, "") + b
        swap[b] = swap.get(b, "") + a
    table = F.create_map(*(F.lit(x) for kv in sorted((k, "".join(sorted(set(v)))) for k, v in swap.items()) for x in kv))
    out, grown = None, df.withColumn("variant", F.col(word)).withColumn("changes", F.lit(0)).withColumn("_from", F.lit(1))
    for _ in range(most):
        places = F.sequence(F.col("_from"), F.length("variant"))
        grown = grown.where(F.col("_from") <= F.length("variant")).withColumn("_i", F.explode(places)).where(F.substring(F.col("variant"), F.col("_i"), F.lit(1)).isin(*swap))
        grown = grown.withColumn("_s", F.explode(F.split(F.element_at(table, F.substring(F.col("variant"), F.col("_i"), F.lit(1))), "")))
        grown = grown.withColumn("variant", F.concat(F.expr("substring(variant, 1, _i - 1)"), "_s", F.expr("substring(variant, _i + 1)"))).withColumn("changes", F.col("changes") + 1).withColumn("_from", F.col("_i") + 1).drop("_i", "_s")
        step = grown.drop("_from")
        out = step if out is None else out.unionByName(step)
    return out


class Respelling:
    """Least-cost choice of one candidate a row: an edit costs 1, a word that stands before its predecessor costs `cost`. Words are compared in lower case."""

    def __init__(self, confusable: tuple[tuple[str, str], ...], cap: int, cost: float) -> None:
        self.cap, self.cost, self.swap, self.known, self.met = cap, cost, {}, {}, {}
        for a, b in confusable:
            self.swap.setdefault(a, set()).add(b)
            self.swap.setdefault(b, set()).add(a)

    def layer(self, word: str | None) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Candidates of a word, their edits, their lower-case forms, and the order of those."""
        if word not in self.known:
            if len(self.known) > 4096:
                self.known.clear()
            found = candidates_of(word or "", self.swap, self.cap)
            lower = np.array([c.lower() for _, c in found], object)
            self.known[word] = [c for _, c in found], np.array([e for e, _ in found]), lower, np.argsort(lower, kind="stable")
        return self.known[word]

    def breaks(self, before: str | None, word: str | None) -> np.ndarray:
        """For each candidate before and each of the word, whether the word's stands before it: by its rank among those, as comparing all pairs of strings is slow."""
        if (before, word) not in self.met:
            if len(self.met) > 4096:
                self.met.clear()
            _, _, there, order = self.layer(before)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            self.met[before, word] = rank[:, None] >= np.searchsorted(there[order], self.layer(word)[2], "right")[None, :]
        return self.met[before, word]

    def step(self, costs: np.ndarray, before: str | None, word: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Costs up to each candidate of the next word, and which candidate before gives them: the first of the cheapest."""
        edits = self.layer(word)[1]
        ways = costs[:, None] + np.where(self.breaks(before, word), self.cost, 0.0)
        choice = ways.argmin(axis=0)
        return ways[choice, np.arange(len(edits))] + edits, choice

    def onto(self, costs: np.ndarray, before: str | None, word: str | None) -> np.ndarray:
        """The same costs for many rows of them at once: the least of those that stand no later, or the least of all and a break."""
        _, edits, here, _ = self.layer(word)
        _, _, there, order = self.layer(before)
        least = np.minimum.accumulate(costs[:, order], axis=1)
        many = np.searchsorted(there[order], here, "right")
        kept = np.where(many > 0, least[:, np.maximum(many - 1, 0)], np.inf)
        return np.minimum(kept, least[:, -1:] + self.cost) + edits

    def effect(self, words: list[str | None]) -> bytes:
        """A chunk's (min, +) matrix from the candidates of its first word to those of its last, with these words."""
        edits = self.layer(words[0])[1]
        costs = np.where(np.eye(len(edits), dtype=bool), edits[None, :], np.inf)
        for a, b in zip(words, words[1:]):
            costs = self.onto(costs, a, b)
        return pickle.dumps((words[0], words[-1], costs))

    def compose(self, effects: list[bytes]) -> bytes:
        first, last, costs = pickle.loads(effects[0])
        for e in effects[1:]:
            begin, end, more = pickle.loads(e)
            reached = self.onto(costs, last, begin) - self.layer(begin)[1]
            costs, last = (reached[:, :, None] + more[None]).min(axis=1), end
        return pickle.dumps((first, last, costs))

    def arrive(self, state: bytes | None, effect: bytes) -> bytes:
        """The costs up to each candidate of a chunk's last word, with that word, from those before the chunk."""
        begin, end, costs = pickle.loads(effect)
        if state is None:
            return pickle.dumps((end, costs.min(axis=0)))
        last, reached = pickle.loads(state)
        onto, _ = self.step(reached, last, begin)
        return pickle.dumps((end, ((onto - self.layer(begin)[1])[:, None] + costs).min(axis=0)))

    def backs(self, words: list[str | None], state: bytes | None) -> tuple[list[np.ndarray], np.ndarray]:
        """For each word of a chunk but a part's first, which candidate of the word before it comes from; and the costs at the last word."""
        if state is None:
            costs, out = self.layer(words[0])[1], []
        else:
            last, costs = pickle.loads(state)
            costs, choice = self.step(costs, last, words[0])
            out = [choice]
        for a, b in zip(words, words[1:]):
            costs, choice = self.step(costs, a, b)
            out.append(choice)
        return out, costs

    def path(self, words: list[str | None], state: bytes | None, exit: bytes | None) -> list[str]:
        """The candidates chosen for a chunk's words; without an exit the last word's is the first of the cheapest."""
        out, costs = self.backs(words, state)
        at = [int(costs.argmin()) if exit is None else pickle.loads(exit)]
        for choice in reversed(out):
            at.append(int(choice[at[-1]]))
        return [self.layer(w)[0][i] for w, i in zip(words, at[: len(words)][::-1])]


def viterbi(df: DataFrame, part: str, order: str, word: str, confusable: tuple[tuple[str, str], ...], cap: int = 48, cost: float = BREAK_COST, bits: int = ranges.BITS) -> DataFrame:
    """(part, order, word, chosen): one candidate respelling a row such that edits plus cost for each break of order are least over the part.

    A part may be of any length: rows go in chunks of 2^bits at most. Parts that lie whole in a chunk are solved with it, all in one call. Of the others, a chunk's effect is a matrix in the semiring of least sums, from candidates of its
    first row to those of its last; a tree of such products gives the costs before each chunk. With these every chunk knows for each way out
    which way in it came from; those maps are joined from the end. Candidates come by number of edits, then text; ties go to the first, so the
    result is that of one pass over the part, whatever the chunks. order may be any column that sorts, without ties; a null word is an empty one.
    """
    way = Respelling(confusable, cap, cost)
    kinds = dict(df.dtypes)
    key, head, ddl = [part, "_chunk"], f"{part} {kinds[part]}, _chunk long", f"{part} {kinds[part]}, {order} {kinds[order]}, {word} string, chosen string"
    rows = ranges.numbered(df.select(part, order, word), [part], [order], "_place").withColumn("_chunk", ranges.chunk_of("_place", bits))
    spans = rows.groupBy(F.col(part).alias("_p")).agg(F.min("_place").alias("_from"), (F.min("_chunk") < F.max("_chunk")).alias("_cut"))
    rows = rows.join(spans, F.col(part).eqNullSafe(F.col("_p"))).drop("_p")
    whole, rows = rows.where("not _cut").drop("_cut"), keep(rows.where("_cut").drop("_cut", "_from"), "cut")
    words_of = lambda r: [w if isinstance(w, str) else None for w in r.sort_values("_place")[word]]

    def one(rows: pd.DataFrame, **more) -> pd.DataFrame:
        return pd.DataFrame({part: rows[part][:1].values, "_chunk": rows["_chunk"][:1].values, **more})

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place")
        words = words_of(rows)
        ends = [0, *(np.flatnonzero(np.diff(rows["_from"].to_numpy())) + 1).tolist(), len(rows)]
        return rows.assign(chosen=[c for a, b in zip(ends, ends[1:]) for c in way.path(words[a:b], None, None)])[[part, order, word, "chosen"]]

    whole = whole.groupBy("_chunk").applyInPandas(solve, ddl)
    if rows.isEmpty():
        return whole
    effects = rows.groupBy(*key).applyInPandas(lambda r: one(r, effect=[way.effect(words_of(r))]), f"{head}, effect binary")
    before = ranges.scan(effects, part, "_chunk", "effect", way.compose, way.arrive)

    def ways_in(rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        out, costs = way.backs(words_of(rows), before["state"].iloc[0])
        at = np.arange(len(costs))
        for choice in reversed(out):
            at = choice[at]
        return one(rows, effect=[pickle.dumps((at, int(costs.argmin())))])

    entries = rows.groupBy(*key).cogroup(before.groupBy(*key)).applyInPandas(ways_in, f"{head}, effect binary")

    def joined(effects: list[bytes]) -> bytes:
        """From the part's end on: what the last of these chunks is entered by, for each way out of the first, and the best way out of the first."""
        (at, best), *rest = [pickle.loads(e) for e in effects]
        for more, _ in rest:
            at = more[at]
        return pickle.dumps((at, best))

    def leave(state: bytes | None, effect: bytes) -> bytes:
        at, best = pickle.loads(effect)
        return pickle.dumps(int(at[best if state is None else pickle.loads(state)]))

    exits = ranges.scan(entries, part, "_chunk", "effect", joined, leave, backwards=True)
    both = before.withColumnRenamed("state", "before").join(exits.withColumnRenamed("state", "exit").withColumnRenamed(part, "_p").withColumnRenamed("_chunk", "_c"), F.col(part).eqNullSafe(F.col("_p")) & (F.col("_chunk") == F.col("_c"))).select(*key, "before", "exit")

    def choose(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place")
        return rows.assign(chosen=way.path(words_of(rows), known["before"].iloc[0], known["exit"].iloc[0]))[[part, order, word, "chosen"]]

    return whole.unionByName(rows.groupBy(*key).cogroup(both.groupBy(*key)).applyInPandas(choose, ddl))
