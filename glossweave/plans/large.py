"""Queries of operators built for large inputs: dictionaries of phrases, searches by the thousand, sequences of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tabular
from ..functions import text as T
from ..operators import clusters, lexicon, order, overlay, phrases, regluing, repair, review, search_index, sketches
from ..operators.tables import keep
from ..sources import sinks
from .base import query, table
from .lexical import forms


def phrase_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(phrase, value): names of parts, and all runs of six words of the benchmark's items."""
    parts = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("phrase")).agg(F.concat(F.lit("[part "), F.min("p_partkey"), F.lit("]")).alias("value"))
    words = F.split("text", " ")
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - 5), lambda i: F.array_join(F.slice(words, i, 6), " "))
    items = table(spark, sf_dir, "benchmark").where(F.size(words) >= 6).select(F.explode(runs).alias("phrase"), F.concat(F.lit("[item "), "item_id", F.lit("]")).alias("value"))
    items = items.where(F.col("phrase").rlike("(?s)^[A-Za-z].*[A-Za-z]$"))
    return parts.unionByName(items)


@query()
def dictionary_phrases(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.replace(docs, "text", phrase_dictionary(spark, sf_dir), "phrase", "value").select("doc_id", "replaced", "replacements")


#: Words of names and types, each also without its third letter, with its last two swapped, and less its first, as people would type them.
ASKED = """select distinct q from (
  select unnest([w, substr(w, 1, 2) || substr(w, 4), substr(w, 1, length(w) - 2) || right(w, 1) || substr(w, length(w) - 1, 1), substr(w, 2), w || 'x']) as q
  from (select distinct unnest(string_split(lower(p_name || ' ' || p_type || ' ' || p_brand), ' ')) as w from part))"""


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand")), " ")).alias("w")).distinct()
    kinds = ["w", "concat(substr(w, 1, 2), substr(w, 4))", "concat(substr(w, 1, length(w) - 2), right(w, 1), substr(w, length(w) - 1, 1))", "substr(w, 2)", "concat(w, 'x')"]
    return words.select(F.explode(F.array(*map(F.expr, kinds))).alias("q")).distinct()


@query(f"""with a as ({ASKED}),
 f as (select p_partkey, lower(p_type || ' ' || p_brand) as body, unnest(list_concat([lower(p_name)], string_split(lower(p_name), ' '))) as form from part),
 r as (select q, p_partkey, case when form = q then 0 when starts_with(form, q) then 1 when contains(form, q) then 2
   when length(q) >= 4 and levenshtein(form, q) <= 1 then 3 when length(q) >= 4 and levenshtein(form, q) <= 2 then 4 when contains(body, q) then 5 end as rank from a, f)
 select q, p_partkey, cast(min(rank) as int) as rank from r where rank is not null group by all""")
def search_many(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    index = search_index.build(part, "p_partkey", forms(), F.concat_ws(" ", "p_type", "p_brand"))
    return search_index.search(index, asked(spark, sf_dir), "q").select("q", F.col("key").alias("p_partkey"), "rank")


@query()
def respelled_sequence(spark, sf_dir):
    """The names of a type's parts by key: few sequences, each of any length."""
    return order.viterbi(table(spark, sf_dir, "part"), "p_type", "p_partkey", "p_name", lexicon.CONFUSABLE)


@query()
def leader_rounds(spark, sf_dir):
    """All embeddings as one group, in order of their ids."""
    return clusters.leaders(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", ["vec_id"], 0.5)


@query()
def minibatch_kmeans(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clusters.assign(emb, "embedding", clusters.mini_batch(emb, "vec_id", "embedding", 10)).select("vec_id", "cluster")


def broken_lines():
    """Lines of a document, words of six letters and more broken in two."""
    return F.split(F.regexp_replace("text", "([a-z]{3})([a-z]{3}) ", "$1-\n$2 "), "\n")


@query()
def reglued_documents(spark, sf_dir):
    """Documents put together from broken lines by what other lines hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", broken_lines().alias("lines"))
    return regluing.reglue(docs, "doc_id", "lines").select("doc_id", "text")


@query("""with e as (select date_trunc('week', ts) as week, user_id, value from events)
 select cast(week as date) as week, count(*) as n, count(distinct user_id) as users, true as counted, true as joined, true as median, true as tail from e group by week""")
def weekly_sketches(spark, sf_dir):
    """Sketches by day, merged by week, against the exact numbers: whether each is within its bound (5 % of the users, 3 % of the rows in rank)."""
    events = table(spark, sf_dir, "events")
    days = keep(sketches.daily(events, F.to_date("ts"), "user_id", "value"), "days")
    told = sketches.read(sketches.merged(days, F.date_trunc("week", "day").cast("date")))
    week = F.date_trunc("week", "ts").cast("date")
    exact = events.select(week.alias("period"), "user_id", "value").join(F.broadcast(told.select("period", "q50", "q99")), "period")
    share = lambda c: F.avg(c.cast("double"))
    v = F.col("value")
    exact = exact.groupBy("period").agg(F.countDistinct("user_id").alias("users"), *(share(v < F.col(q)).alias(f"{q}_lt") for q in ("q50", "q99")), *(share(v <= F.col(q)).alias(f"{q}_le") for q in ("q50", "q99")))
    near = lambda est: F.abs(est - F.col("users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("users"))
    rank = lambda q, p: (F.col(f"{q}_lt") <= p + 0.03) & (F.col(f"{q}_le") >= p - 0.03)
    return told.join(exact, "period").select(F.col("period").alias("week"), "n", "users", near(F.col("distinct")).alias("counted"), near(F.col("members")).alias("joined"), rank("q50", 0.5).alias("median"), rank("q99", 0.99).alias("tail"))


@query("""with a as (select p_partkey, p_type, p_name from part) select p_partkey, 0 as sense, lower(p_type) as text from a union all select p_partkey, 1, p_name from a union all select p_partkey, 2, 'x' from a
 union all select p_partkey, 2, p_type from a union all select p_partkey, 0, 'z' from a""")
def lateral_parentheticals(spark, sf_dir):
    """The parentheticals of articles by a lateral join with a table function, in SQL text."""
    tabular.register(spark)
    table(spark, sf_dir, "part").createOrReplaceTempView("parts_read")
    return spark.sql("""select p_partkey, x.sense, x.text from (select p_partkey, lower(p_type) as fako, array('Una (' || p_name || ') fino', 'Du (x) e (' || p_type || ')') as senci, array('Noto (z)') as noti from parts_read) a,
        lateral parentheticals(a.fako, a.senci, a.noti) x""")


@query("""with v as (select source, lang, count(*) as votes from documents group by all), r as (select *, row_number() over (partition by source order by votes desc, lang) as rn, sum(votes) over (partition by source) as total from v)
 select source, lang, votes, cast(total as bigint) as total from r where rn = 1""")
def vote_in_two_steps(spark, sf_dir):
    """The most frequent language of each source, by a partial and a final table function in SQL text."""
    tabular.register(spark)
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents_read")
    return spark.sql("""select key as source, value as lang, votes, total from vote_final(table(select * from vote_partial(table(select source as key, lang as value from documents_read))) partition by key)""")


_MISREAD = "case when p_partkey % 3 = 0 then replace(p_name, 'i', 'l') || 'x' when p_partkey % 3 = 1 then replace(p_name, 'e', 'o') else substr(p_name, 1, length(p_name) - 2) end"


def misread(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", F.expr(_MISREAD).alias("read"))


@query(f"""with m as (select p_partkey, p_name, {_MISREAD} as read from part),
 c as (select p_partkey, i as position, rpad(p_name, cast(greatest(length(p_name), length(read)) as int), ' ')[i + 1] as expected, rpad(read, cast(greatest(length(p_name), length(read)) as int), ' ')[i + 1] as found
   from m, unnest(range(0, greatest(length(p_name), length(read)))) as r(i))
 select p_partkey, cast(position as int) as position, expected, found from c where expected <> found""")
def position_faults(spark, sf_dir):
    """Every position at which a reading of a name is not the name."""
    return review.faults(misread(spark, sf_dir), ["p_partkey"], "p_name", "read")


@query(f"""with m as (select p_type, p_name, {_MISREAD} as read from part),
 c as (select p_type, rpad(p_name, cast(greatest(length(p_name), length(read)) as int), ' ')[i + 1] = rpad(read, cast(greatest(length(p_name), length(read)) as int), ' ')[i + 1] as same
   from m, unnest(range(0, greatest(length(p_name), length(read)))) as r(i))
 select p_type, sum(same::int)::bigint as good, count(*) as total from c group by 1""")
def position_accuracy(spark, sf_dir):
    """How many positions of the names of a type are read rightly."""
    return review.accuracy(misread(spark, sf_dir), ["p_type"], "p_name", "read")


_LINES = "select p_type as part, row_number() over (partition by p_type order by p_partkey) as line, p_name || ' ' || p_brand || ' ' || p_size as text from part"
_MOVED = "select part, line + length(part) - 5 as line, replace(replace(text, 'e', 'o'), 'Brand', 'Erand') as text from o where line % 7 <> 3"


@query(f"""with o as ({_LINES}), w as ({_MOVED}),
 m as (select o.part, d as shift, avg(round(1 - levenshtein(o.text, w.text) / greatest(length(o.text), length(w.text)), 9)) as mean, count(*) as n from o, range(-4, 17) r(d), w where o.part = w.part and o.line + d = w.line group by all having count(*) >= 8)
 select part, cast(arg_min(shift, struct_pack(a := -round(mean, 9), b := shift)) as int) as shift, max(round(mean, 9)) as mean, arg_min(n, struct_pack(a := -round(mean, 9), b := shift)) as n from m group by 1""")
def shift_by_similarity(spark, sf_dir):
    """By how many lines a reading of the parts of a type is moved against another."""
    numbered = F.row_number().over(Window.partitionBy("p_type").orderBy("p_partkey"))
    text = F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string"))
    old = table(spark, sf_dir, "part").select(F.col("p_type").alias("part"), numbered.alias("line"), text.alias("text"))
    new = old.where("line % 7 <> 3").select("part", (F.col("line") + F.length("part") - 5).alias("line"), F.expr("replace(replace(text, 'e', 'o'), 'Brand', 'Erand')").alias("text"))
    return review.shift_by_similarity(old, new, "part", "line", "text", range(-4, 17))


@query()
def rare_word_sheets(spark, sf_dir):
    """Rare words of the documents that the benchmark doesn't attest, on the sheets they are judged on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = table(spark, sf_dir, "benchmark").select(F.explode(T.tokens(F.col("text"), "[A-Za-z]{4,}")).alias("word")).distinct()
    freq = lexicon.frequency(docs, "text", "[A-Za-z]{4,}").select("token", "n")
    return review.rare_words(lexicon.first_context(docs, "doc_id", "text"), freq, words)


@query()
def perceptron_rounds_labels(spark, sf_dir):
    """Labels of all embeddings from every other one's, sure ones put in for a second round."""
    emb = table(spark, sf_dir, "embeddings").withColumn("known", F.when(F.col("vec_id") % 2 == 0, F.col("label")))
    return repair.perceptron_rounds(emb, "vec_id", "embedding", "known", rounds=2).select("vec_id", "label")


@query("""select '# Parti' || chr(10) as value union all select '---' union all select '## ' || p_name || chr(10) || 'p. ' || p_size || chr(10) from part""")
def book_of_parts(spark, sf_dir):
    """One book of all parts in order of their keys."""
    text = F.concat(F.lit("## "), "p_name", F.lit("\np. "), F.col("p_size").cast("string"))
    return sinks.book(table(spark, sf_dir, "part"), ["p_partkey"], text, "Parti")


_VERBS = "select p_partkey, p_name, case when p_partkey % 3 = 0 then 'per ' || p_type || ' o kun ula' when p_partkey % 3 = 1 then 'kun ' || p_brand end as g, case when p_partkey % 5 = 0 then 't' end as first, case when p_partkey % 2 = 0 then 'i' else 't' end as second from part"


def verbs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    g = F.when(k % 3 == 0, F.concat(F.lit("per "), "p_type", F.lit(" o kun ula"))).when(k % 3 == 1, F.concat(F.lit("kun "), "p_brand"))
    kinds = F.map_from_arrays(F.when(k % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2))), F.when(k % 5 == 0, F.array(F.lit("t"), F.when(k % 2 == 0, "i").otherwise("t"))).otherwise(F.array(F.when(k % 2 == 0, "i").otherwise("t"))))
    return part.select("p_partkey", "p_name", F.when(g.isNotNull(), F.array(g)).otherwise(F.array().cast("array<string>")).alias("governs"), kinds.alias("kinds"))


@query(f"""with v as ({_VERBS}), c as (select case when first is not null and first <> second then 'by sense' else second end as name from v union all select 'governing' from v where g is not null union all select 'verbs' from v)
 select name, count(*) as n from c group by 1""")
def verb_class_counts(spark, sf_dir):
    """How many verbs there are of each class, made of the parts."""
    return sinks.verb_counts(verbs(spark, sf_dir), "kinds", "governs")


@query(f"""with v as ({_VERBS}), e as (select 'per' as preposition, p_name from v where g like 'per %' union select 'kun', p_name from v where g is not null), s as (select preposition, list_sort(list(p_name)) as heads from e group by 1)
 select preposition, len(heads) as n, '**' || preposition || '** (' || len(heads) || ') — ' || array_to_string(heads, ', ') as line from s""")
def preposition_lines(spark, sf_dir):
    """Verbs by the prepositions through which they govern."""
    return sinks.preposition_lines(verbs(spark, sf_dir), "p_name", "governs")


@query("""with e as (select o_custkey, o_orderstatus as l, max((o_orderdate <= (select max(o_orderdate) - interval 3 year from orders))::int) as o, max((o_orderdate > (select max(o_orderdate) - interval 3 year from orders))::int) as n from orders group by all)
 select o_custkey, array_to_string(list_sort(list(l)), ',') as every, array_to_string(list_sort(coalesce(list(l) filter (where o = 1 and n = 1), [])), ',') as kept,
  array_to_string(list_sort(coalesce(list(l) filter (where o = 0), [])), ',') as added, array_to_string(list_sort(coalesce(list(l) filter (where n = 0), [])), ',') as dropped from e group by 1""")
def label_set_changes(spark, sf_dir):
    """What became of each customer's set of order states in the last three years."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    mid = F.broadcast(orders.agg(F.expr("max(o_orderdate) - interval 3 years").alias("mid")))  # one row
    both = orders.crossJoin(mid)
    out = overlay.set_changes(both.where("o_orderdate <= mid"), both.where("o_orderdate > mid"), "o_custkey", "o_orderstatus")
    return out.select("o_custkey", *(F.array_join(c, ",").alias(c) for c in ("every", "kept", "added", "dropped")))
