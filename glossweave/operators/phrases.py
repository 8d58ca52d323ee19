"""Very large dictionaries of phrases found and replaced in texts: an Aho-Corasick automaton over tokens, in flat arrays.

Texts and phrases are cut into words and single other characters. The automaton reads backwards, from the last token to the first, and holds the
phrases reversed, so the longest phrase it has just finished is the longest one that begins at the token. A text is then replaced from left to right,
the longest phrase first, as if by one alternation sorted by length.

Texts are read many places at once: a batch is cut into stretches, each entered a phrase's length early, which step on together, so a step is a few array
operations. A dictionary is dealt into shards by measured size, one broadcast each; a table of any number of phrases takes as many rounds.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .tables import arrow_limits

#: Word characters are those of Java's Unicode classes, so that JVM expressions cut texts alike.
TOKENS = r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\u200c\u200d]+|[^\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\u200c\u200d]"
WORD = r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\u200c\u200d]"
SHARD_BYTES = 32 << 20
STRETCH = 256


class Automaton:
    """Goto, failure and output as arrays: state x token number is looked up in sorted keys; state 0 is the root, token 0 stands for any token that no phrase holds."""

    def __init__(self, phrases: list[list[str]]) -> None:
        tokens = sorted({t for p in phrases for t in p})
        self.number = {t: i + 1 for i, t in enumerate(tokens)}
        self.width = len(tokens) + 1
        coded = sorted((tuple(self.number[t] for t in reversed(p)), i) for i, p in enumerate(phrases))
        self.longest = max((len(p) for p in phrases), default=0)
        # States are numbered along the sorted phrases; a phrase shares those of the one before as far as both begin alike.
        parent, token, depth, ends, path, prev = [0], [0], [0], {}, [0], ()
        for code, i in coded:
            same = 0
            while same < min(len(code), len(prev)) and code[same] == prev[same]:
                same += 1
            del path[same + 1 :]
            for t in code[same:]:
                parent.append(path[-1])
                token.append(t)
                depth.append(len(path))
                path.append(len(parent) - 1)
            ends.setdefault(path[-1], i)
            prev = code
        parent, token, self.depth = np.array(parent, np.int64), np.array(token, np.int64), np.array(depth, np.int64)
        keys = parent[1:] * self.width + token[1:]
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], order + 1
        self.fail = np.zeros(len(parent), np.int64)
        self.out = np.full(len(parent), -1, np.int64)
        for state, i in ends.items():
            self.out[state] = i
        for d in range(1, self.longest + 1):
            level = np.flatnonzero(self.depth == d)
            if d > 1:
                self.fail[level] = self.go(self.fail[parent[level]], token[level])
            bare = level[self.out[level] < 0]
            self.out[bare] = self.out[self.fail[bare]]

    def child(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The state behind a token where there is one, else -1."""
        if not len(self.keys):
            return np.full(len(states), -1, np.int64)
        keys = states * self.width + tokens
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.targets[at], -1)

    def go(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The state behind a token, by way of failures."""
        states, out = states.copy(), np.zeros(len(states), np.int64)
        left = np.flatnonzero(tokens > 0)
        while len(left):
            found = self.child(states[left], tokens[left])
            hit = found >= 0
            out[left[hit]] = found[hit]
            left = left[~hit]
            left = left[states[left] > 0]
            states[left] = self.fail[states[left]]
        return out

    def starts(self, tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each token of many texts (rows tells which), the phrase that is longest of those that begin there, -1 for none."""
        n, out = len(tokens), np.full(len(tokens), -1, np.int64)
        if not n or not self.longest:
            return out
        early = self.longest - 1
        # Stretches are read from their right end on, entered early tokens further right.
        right = np.arange(STRETCH - 1, n + STRETCH - 1, STRETCH)
        states = np.zeros(len(right), np.int64)
        row = np.full(len(right), -1, np.int64)
        for k in range(-early, STRETCH):
            at = right - k
            ok = (at >= 0) & (at < n)
            here = at[ok]
            now = states[ok]
            now[rows[here] != row[ok]] = 0
            now = self.go(now, tokens[here])
            states[ok], row[ok] = now, rows[here]
            if k >= 0:
                out[here] = self.out[now]
        return out


def cut(phrase: str, pattern=None) -> list[str]:
    return (pattern or regex.compile(TOKENS)).findall(phrase)


def shards(dictionary: DataFrame, phrase: str, value: str, limit: int) -> Iterator[Callable[[], list[tuple[str, str]]]]:
    """The dictionary's rows in rounds of about limit bytes. Equal phrases come together in one; the least value stands."""
    rows = dictionary.where(F.col(phrase).isNotNull() & F.col(phrase).rlike(f"(?s)^{WORD}(.*{WORD})?$".replace("\\p{Alphabetic}", "\\p{IsAlphabetic}"))).groupBy(F.col(phrase).alias("p")).agg(F.min(value).alias("v"))
    size = rows.agg(F.sum(F.octet_length("p") + F.octet_length(F.coalesce("v", F.lit(""))) + 64)).first()[0] or 0
    rounds = max(1, -(-size // limit))
    for k in range(rounds):
        part = rows if rounds == 1 else rows.where(F.pmod(F.xxhash64("p"), F.lit(rounds)) == k)
        yield lambda part=part: [(r.p, r.v) for r in part.collect()]


def found(df: DataFrame, text: str, dictionary: DataFrame, phrase: str, value: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """df with _found, array<struct<at, size, value>>: phrases that stand in the text as whole words, from left to right, the longest at each place, none inside
    another; at and size count tokens. A phrase begins and ends with a word character (others never match, as do nulls); a null value is an empty one.
    """
    spark = df.sparkSession
    arrow_limits(spark)
    kind = "array<struct<at: long, size: long, value: string>>"
    names = df.columns
    hit = pa.list_(pa.struct([("at", pa.int64()), ("size", pa.int64()), ("value", pa.string())]))
    df = df.withColumn("_found", F.array().cast(kind))
    rounds = list(shards(dictionary, phrase, value, shard_bytes))
    for k, part in enumerate(rounds):
        rows, final = part(), k + 1 == len(rounds)
        pattern = regex.compile(TOKENS)
        auto = Automaton([cut(p, pattern) for p, _ in rows])
        sent = spark.sparkContext.broadcast(pickle.dumps((auto, [len(cut(p, pattern)) for p, _ in rows], [v or "" for _, v in rows])))

        def run(batches, sent=sent, final=final):
            auto, sizes, values = pickle.loads(sent.value)
            pattern, number = regex.compile(TOKENS), auto.number
            sizes = np.array([*sizes, 0])
            for b in batches:
                tokens, ends = [], [0]
                for t in b.column(text).to_pylist():
                    tokens += [number.get(w, 0) for w in pattern.findall(t or "")]
                    ends.append(len(tokens))
                at = np.array(ends)
                which = auto.starts(np.array(tokens, np.int64), np.repeat(np.arange(len(at) - 1), np.diff(at)))
                places = np.flatnonzero(which >= 0)
                cuts, rows = np.searchsorted(places, at), []
                for i, before in enumerate(b.column("_found").to_pylist()):
                    more = [{"at": int(p - at[i]), "size": int(sizes[which[p]]), "value": values[which[p]]} for p in places[cuts[i] : cuts[i + 1]]]
                    more = longest(before + more) if before else more
                    rows.append(apart(more) if final else more)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(rows, hit)], [*names, "_found"])

        df = df.mapInArrow(run, df.schema)
    return df


def longest(hits: list[dict]) -> list[dict]:
    """The longest hit at each start, by start. What one shard's phrases cover may hide the start of another's, so all starts stay until the last shard."""
    best: dict[int, dict] = {}
    for h in hits:
        if h["at"] not in best or best[h["at"]]["size"] < h["size"]:
            best[h["at"]] = h
    return [best[k] for k in sorted(best)]


def apart(hits: list[dict]) -> list[dict]:
    """Of hits by start, those that begin behind the last one taken."""
    out, upto = [], 0
    for h in hits:
        if h["at"] >= upto:
            out.append(h)
            upto = h["at"] + h["size"]
    return out


def replace(df: DataFrame, text: str, dictionary: DataFrame, phrase: str, value: str, name: str = "replaced", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """df with the text in which every phrase of the dictionary is replaced by its value, and replacements, how many; a null text stays null."""
    hits = found(df, text, dictionary, phrase, value, shard_bytes)
    names = df.columns

    def run(batches):
        pattern = regex.compile(TOKENS)
        for b in batches:
            texts, counts = [], []
            for t, found in zip(b.column(text).to_pylist(), b.column("_found").to_pylist()):
                if found:
                    tokens, out, at = pattern.findall(t), [], 0
                    for h in found:
                        out += [*tokens[at : h["at"]], h["value"]]
                        at = h["at"] + h["size"]
                    t = "".join([*out, *tokens[at:]])
                texts.append(t)
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], [*names, name, "replacements"])

    return hits.mapInArrow(run, StructType([*df.schema, StructField(name, StringType()), StructField("replacements", LongType())]))
