"""Filters and repairs over records: validity, restored starts, starred roots, fragment location, lexicon correction, model votes."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import lexicon, order, sequence


def valid(head: Column, senses: Column) -> Column:
    """A headword that isn't empty, isn't a cross-reference, and isn't a bare roman numeral without senses."""
    return (head != "") & ~head.startswith("Vd") & ~(head.rlike("^[IVX]+$") & (F.size(senses) == 0))


def restored(lines: DataFrame, page: str, line: str, cells: str, most: int = 2) -> DataFrame:
    """Restored line starts worth keeping: one cell that is a letter or +, on pages with at most `most` of them."""
    good = lines.where(F.col(cells).rlike("^[A-Za-zÀ-ÿ+]$")).dropDuplicates([page, line])
    few = good.groupBy(page).agg(F.count("*").alias("_n")).where(F.col("_n") <= most)
    return good.join(few.select(page), page, "left_semi")


def plausible(variant: Column, word: Column) -> Column:
    """Same last letter, and no doubled vowel that word hasn't."""
    doubled = "(aa|ee|ii|oo|uu)"
    return (F.right(variant, F.lit(1)) == F.right(word, F.lit(1))) & ~(variant.rlike(doubled) & ~word.rlike(doubled))


def star(words: DataFrame, token: str, starred: DataFrame, root: str, endings: tuple[str, ...] = T.ENDINGS) -> DataFrame:
    """words with starred: whether the token is one of the starred roots with an ending. An equi-join on stems instead of a pattern for each root."""
    stems = words.select(token, F.explode(F.filter(F.array(*(F.when(F.col(token).endswith(e), F.substring(F.col(token), F.lit(1), F.length(token) - len(e))) for e in endings)), lambda x: F.length(x) >= 3)).alias("_r")).distinct()
    hit = stems.join(starred.select(F.col(root).alias("_r")).distinct(), "_r", "left_semi").select(token).distinct().withColumn("starred", F.lit(True))
    return words.join(hit, token, "left").withColumn("starred", F.coalesce("starred", F.lit(False)))


def locate(text: Column, fragments: Column) -> Column:
    """Start of each fragment in text, one-based, each after the end of the one before; else its first place anywhere; 0 if it has none."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(acc: Column, f: Column) -> Column:
        ahead = F.call_function("locate", f, text, acc["at"])
        where = F.when(ahead > 0, ahead).otherwise(F.instr(text, f))
        return F.struct(F.when(ahead > 0, ahead + F.length(f)).otherwise(acc["at"]).cast("int").alias("at"), F.array_append(acc["found"], where.cast("int")).alias("found"))

    return F.aggregate(fragments, start, step)["found"]


def correct(freq: DataFrame, variants: DataFrame, most: int = 5, least: int = 8, ratio: int = 8, clear: int = 3) -> DataFrame:
    """(token, n, variant, variant_n) for rare tokens with one clearly best attested variant: frequent enough, `ratio` times the token, and `clear` times the second best."""
    known = freq.select(F.col("token").alias("variant"), F.col("n").alias("variant_n"))
    c = variants.join(known, "variant").groupBy("token", "n").agg(F.max(F.struct("variant_n", "variant")).alias("b"), F.sort_array(F.collect_list("variant_n"), asc=False).alias("all"))
    second = F.coalesce(F.try_element_at("all", F.lit(2)), F.lit(0))
    good = (F.col("n") <= most) & (F.col("b.variant_n") >= least) & (F.col("b.variant_n") >= ratio * F.col("n")) & (second * clear <= F.col("b.variant_n"))
    return c.where(good).select("token", "n", F.col("b.variant").alias("variant"), F.col("b.variant_n").alias("variant_n"))


def gram_pass(freq: DataFrame, confusable: tuple[tuple[str, str], ...], n: int = 4, add: float = 0.2, margin: float = 6.0, rare: int = 1, known: int = 3, most: int = 2) -> DataFrame:
    """(token, variant, gain): tokens seen rare times at most, respelled at up to most places such that the n-grams of the known tokens make the word
    10^margin times likelier; the likeliest respelling wins, ties go to the smaller. freq has token and n."""
    padded = lambda c: F.concat(F.lit("^" * (n - 1)), F.lower(c), F.lit("$"))
    grams = freq.where(F.col("n") >= known).select("n", F.explode(lexicon.ngrams(padded(F.col("token")), n)).alias("g")).groupBy("g").agg(F.sum("n").alias("gn"))
    heads = grams.groupBy(F.expr(f"substring(g, 1, {n - 1})").alias("h")).agg(F.sum("gn").alias("hn"))
    size = grams.select(F.explode(F.split("g", "")).alias("c")).agg((F.countDistinct("c") + 1).alias("v"))  # one row
    low = freq.where(F.col("n") <= rare).select("token")
    words = order.products(low, "token", confusable, most).select("token", "variant").distinct().unionByName(low.withColumn("variant", F.col("token")))
    each = words.select("token", "variant", F.explode(lexicon.ngrams(padded(F.col("variant")), n)).alias("g")).withColumn("h", F.expr(f"substring(g, 1, {n - 1})"))
    met = each.join(grams, "g", "left").join(heads, "h", "left").crossJoin(F.broadcast(size))
    score = met.groupBy("token", "variant").agg(F.sum(F.log10((F.coalesce("gn", F.lit(0)) + add) / (F.coalesce("hn", F.lit(0)) + add * F.col("v")))).alias("s"))
    base = score.where("token = variant").select("token", F.col("s").alias("b"))
    best = score.where("token <> variant").groupBy("token").agg(F.min(F.struct((-F.round("s", 9)).alias("m"), "variant")).alias("x"))
    return best.join(base, "token").select("token", "x.variant", (-F.col("x.m") - F.col("b")).alias("gain")).where(F.col("gain") > margin)


def perceptron_rounds(df: DataFrame, key: str, vector: str, label: str, rounds: int = 3, sure: float = 0.98, most: int = 6, group: str | None = None, **how) -> DataFrame:
    """perceptron() several times, each time with the rows of which the last one was sure put in with their labels, at most so many of a group (a column of
    df), the surest first."""
    known, out = df, None
    for _ in range(rounds):
        out = perceptron(known, key, vector, label, **how)
        best = F.array_max("posterior")
        more = out.withColumn("_p", best).where(F.col("_p") > sure).join(df.where(F.col(label).isNull()).select(key, *([group] if group else [])), key)
        if group:
            more = sequence.top_per_group(more, group, [F.desc("_p"), F.asc(key)], most)
        named = more.select(key, F.col("label").cast("double").alias("_l"))
        known = df.join(named, key, "left").withColumn(label, F.coalesce(F.col(label).cast("double"), "_l")).drop("_l")
    return out


def self_train(df: DataFrame, key: str, vector: str, label: str, rounds: int = 2, confident: float = 0.9) -> DataFrame:
    """(key, label, sure): a logistic model on the labelled rows, trained again with the rows it is confident of."""
    data = df.select(key, F.col(label).cast("double").alias("label"), array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    train = data.where("label is not null")
    for _ in range(rounds):
        model = LogisticRegression(maxIter=40, regParam=1e-3).fit(train)
        guess = model.transform(data.drop("label")).withColumn("sure", F.array_max(vector_to_array("probability")))
        more = guess.where(F.col("sure") > confident).select(key, F.col("prediction").alias("label"), "features").join(train.select(key), key, "left_anti")
        train = data.where("label is not null").unionByName(more)
    return guess.select(key, F.col("prediction").cast("int").alias("label"), "sure")


def perceptron(df: DataFrame, key: str, vector: str, label: str, hidden: int = 32, seed: int = 0) -> DataFrame:
    """(key, label, posterior) of a one-layer perceptron fitted on the labelled rows."""
    data = df.select(key, F.col(label).cast("double").alias("label"), array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    size, classes = data.select(F.max(F.size(vector_to_array("features"))), F.max("label")).first()
    model = MultilayerPerceptronClassifier(layers=[size, hidden, int(classes) + 1], seed=seed, maxIter=40).fit(data.where("label is not null"))
    return model.transform(data.drop("label")).select(key, F.col("prediction").cast("int").alias("label"), vector_to_array("probability").alias("posterior"))


def cluster_votes(df: DataFrame, cluster: str, posterior: str) -> DataFrame:
    """(cluster, label): the class with the largest mean posterior, ties to the smaller."""
    means = df.select(cluster, F.posexplode(posterior).alias("i", "p")).groupBy(cluster, "i").agg(F.avg("p").alias("m"))
    return means.groupBy(cluster).agg(F.min(F.struct((-F.round("m", 9)).alias("m"), "i")).alias("b")).select(cluster, F.col("b.i").alias("label"))
