"""Token frequencies, respellings through confusable characters, membership by stems, n-gram scores."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .tables import arrow_limits, keep

# Characters that are easily taken for each other.
CONFUSABLE = (
    ("c", "o"), ("c", "e"), ("e", "o"), ("i", "l"), ("i", "1"), ("l", "1"), ("n", "u"), ("r", "v"), ("b", "h"), ("s", "z"), ("s", "8"), ("m", "n"),
    ("a", "o"), ("a", "u"), ("t", "l"), ("g", "q"), ("f", "t"), ("d", "a"), ("p", "t"), ("k", "c"), ("x", "s"), ("m", "a"), ("h", "n"), ("v", "y"),
    ("j", "i"), ("O", "0"), ("I", "l"), ("S", "5"),
)


def frequency(df: DataFrame, text: str, pattern: str = "[A-Za-z0-9]{2,}") -> DataFrame:
    """(token, n, docs): occurrences, and rows that have the token. Each row gives its tokens and, marked, its distinct ones, so both numbers are partial sums of one shuffle."""
    own = df.select(T.tokens(F.coalesce(F.col(text), F.lit("")), pattern).alias("_t"))
    both = F.array(F.struct(F.col("_t").alias("t"), F.lit(0).alias("k")), F.struct(F.array_distinct("_t").alias("t"), F.lit(1).alias("k")))
    rows = own.select(F.explode(both).alias("_x")).select("_x.k", F.explode("_x.t").alias("token"))
    return rows.groupBy("token").agg(F.count_if(F.col("k") == 0).alias("n"), F.sum("k").alias("docs"))


def respell(freq: DataFrame, pairs: tuple = CONFUSABLE, rare: int = 2, least: int = 6, ratio: int = 8, min_len: int = 3) -> DataFrame:
    """(token, n, variant, variant_n, position): for rare tokens the most frequent attested form one confusable character away.

    Ties go to the smaller position, then the smaller variant.
    """
    swap: dict[str, str] = {}
    for a, b in pairs:
        swap[a] = swap.get(a, "") + b
        swap[b] = swap.get(b, "") + a
    table = F.create_map(*(F.lit(x) for kv in sorted(swap.items()) for x in kv))
    low = freq.where((F.col("n") <= rare) & (F.length("token") >= min_len))
    cand = low.select("token", "n", F.posexplode(F.split("token", "")).alias("i", "ch")).where(F.col("ch").isin(*swap))
    cand = cand.select("token", "n", (F.col("i") + 1).alias("position"), F.explode(F.split(F.element_at(table, F.col("ch")), "")).alias("sub"))
    cand = cand.withColumn("variant", F.concat(F.expr("substring(token, 1, position - 1)"), "sub", F.expr("substring(token, position + 1)")))
    known = freq.where(F.col("n") >= least).select(F.col("token").alias("variant"), F.col("n").alias("variant_n"))
    hits = cand.join(known, "variant").where(F.col("variant_n") >= ratio * F.col("n"))
    best = hits.groupBy("token", "n").agg(F.min(F.struct((-F.col("variant_n")).alias("v"), "position", "variant")).alias("b"))
    return best.select("token", "n", F.col("b.variant").alias("variant"), (-F.col("b.v")).alias("variant_n"), F.col("b.position").cast("int").alias("position"))


def stems(c: Column, endings: tuple[str, ...] = T.ENDINGS, min_left: int = 2) -> Column:
    """c and what is left of it without each ending that leaves min_left characters."""
    return F.array_distinct(F.filter(F.array(c, *(F.when(c.endswith(e) & (F.length(c) - len(e) >= min_left), F.substring(c, F.lit(1), F.length(c) - len(e))) for e in endings)), lambda x: x.isNotNull()))


#: Bytes up to which a lexicon is broadcast; its size is measured first, and beyond that both sides are shuffled.
BROADCAST_BYTES = 32 << 20


def sized(df: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for a broadcast if the strings of a column are measured to be that small."""
    size = df.agg(F.sum(F.octet_length(column) + 24)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def unknown(tokens: DataFrame, lexicon: DataFrame, token: str = "token", word: str = "word") -> DataFrame:
    """Distinct tokens of which neither the form nor a stem is in the lexicon: each is known if one of its stems is, in one aggregate over the stems."""
    known = sized(lexicon.select(F.col(word).alias("_s")).where("_s is not null").distinct().withColumn("_known", F.lit(True)), "_s")
    rest = [c for c in tokens.columns if c != token]
    met = tokens.select("*", F.explode(stems(F.col(token))).alias("_s")).join(known, "_s", "left")
    judged = met.groupBy(token).agg(F.bool_or(F.coalesce("_known", F.lit(False))).alias("_known"), *(F.first(c).alias(c) for c in rest))
    return judged.where("not _known").select(*tokens.columns)


def ngrams(c: Column, n: int) -> Column:
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def ngram_scores(freq: DataFrame, n: int = 4, add: float = 0.2) -> DataFrame:
    """(token, score): mean log10 of the n-grams' smoothed conditional probabilities, counts weighed by token frequency. The frequencies are kept, as they are
    read twice and are far fewer than the text; the probabilities are broadcast if they are small."""
    freq = keep(freq.select("token", "n"), "frequency")
    grams = freq.select("n", F.explode(ngrams(F.concat(F.lit("^"), "token", F.lit("$")), n)).alias("g")).groupBy("g").agg(F.sum("n").alias("gn"))
    heads = grams.groupBy(F.expr(f"substring(g, 1, {n - 1})").alias("h")).agg(F.sum("gn").alias("hn"), F.count("*").alias("kinds"))
    prob = grams.withColumn("h", F.expr(f"substring(g, 1, {n - 1})")).join(heads, "h").select("g", F.log10((F.col("gn") + add) / (F.col("hn") + add * F.col("kinds"))).alias("lp"))
    each = freq.select("token", F.explode(ngrams(F.concat(F.lit("^"), "token", F.lit("$")), n)).alias("g"))
    return each.join(sized(keep(prob, "probabilities"), "g"), "g").groupBy("token").agg(F.avg("lp").alias("score"))


def first_context(df: DataFrame, doc: str, text: str, letters: str = "A-Za-z", least: int = 4, width: int = 42) -> DataFrame:
    """(token, doc, at, context): for each run of least letters or more the smallest doc that has it, its first place there as a whole run (one-based), and
    what stands around it. The smallest docs are aggregated without texts; each then meets its text once, with all the tokens it owns, and one pass
    over the text finds them all: a search of the text for each token would cost tokens times text."""
    arrow_limits(df.sparkSession)
    own = df.select(doc, F.explode(F.array_distinct(T.tokens(F.col(text), f"[{letters}]{{{least},}}"))).alias("token"))
    first = own.groupBy("token").agg(F.min(doc).alias(doc)).groupBy(doc).agg(F.collect_list("token").alias("_tokens"))
    kind = dict(df.dtypes)[doc]

    def places(batches):
        pattern = re.compile(f"[{letters}]{{{least},}}")
        for rows in batches:
            out = []
            for d, t, owned in zip(rows[doc], rows["_text"], rows["_tokens"]):
                left = set(owned)
                for m in pattern.finditer(t):
                    if m[0] in left:
                        left.discard(m[0])
                        start = max(0, m.start() - width)
                        out.append((m[0], d, m.start() + 1, ("…" if start else "") + t[start : start + 2 * width] + ("…" if start + 2 * width < len(t) else "")))
                        if not left:
                            break
            yield pd.DataFrame(out, columns=["token", doc, "at", "context"])

    met = df.select(doc, F.col(text).alias("_text")).where("_text is not null").join(first, doc)
    return met.mapInPandas(places, f"token string, {doc} {kind}, at int, context string")
