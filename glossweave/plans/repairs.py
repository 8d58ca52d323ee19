"""Filters and repairs over records, corpus-wide sets, model votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lexicon, repair
from .base import query, table
from .lexical import TOKENS_SQL


@query("""with r as (select p_partkey, case p_partkey % 6 when 0 then '' when 1 then 'XIV' when 2 then 'Vd. ' || p_name else p_name end as head, case when p_partkey % 4 = 0 then [] else [p_type] end as senses from part)
 select p_partkey, head <> '' and not starts_with(head, 'Vd') and not (regexp_matches(head, '^[IVX]+$') and len(senses) = 0) as valid from r""")
def record_validity(spark, sf_dir):
    k = F.col("p_partkey")
    head = F.when(k % 6 == 0, "").when(k % 6 == 1, "XIV").when(k % 6 == 2, F.concat(F.lit("Vd. "), "p_name")).otherwise(F.col("p_name"))
    senses = F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", repair.valid(head, senses).alias("valid"))


@query("""with l as (select distinct conv_id, turn, left(text, 1) as c from conversations where regexp_matches(left(text, 1), '^[A-Za-zÀ-ÿ+]$')), n as (select conv_id from l group by 1 having count(*) <= 2)
 select conv_id, turn, c from l where conv_id in (select conv_id from n)""")
def restored_starts(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.substring("text", 1, 1).alias("c"))
    return repair.restored(lines, "conv_id", "turn", "c")


@query("""select a.p_name as word, b.p_name as variant from (select distinct p_name from part) a join (select distinct p_name from part) b on split_part(a.p_name, ' ', 1) = split_part(b.p_name, ' ', 1) and a.p_name <> b.p_name
 where right(a.p_name, 1) = right(b.p_name, 1) and not (regexp_matches(b.p_name, '(aa|ee|ii|oo|uu)') and not regexp_matches(a.p_name, '(aa|ee|ii|oo|uu)'))""")
def plausible_respelling(spark, sf_dir):
    # Both sides meet on the last letter too, which plausible forms share, so hardly a pair is made that isn't a result.
    n = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("h", F.split_part("p_name", F.lit(" "), F.lit(1))).withColumn("z", F.right("p_name", F.lit(1)))
    both = n.withColumnRenamed("p_name", "word").join(n.withColumnRenamed("p_name", "variant"), ["h", "z"]).where("word <> variant")
    return both.where(repair.plausible(F.col("variant"), F.col("word"))).select("word", "variant")


@query(f"""with {TOKENS_SQL}, b as (select distinct left(w, length(w) - 1) as r from (select unnest(regexp_extract_all(text, '[A-Za-z0-9]{{2,}}')) as w from benchmark) where regexp_matches(w, '[aeio]$') and length(w) >= 4)
 select token, """ + " or ".join(f"coalesce(ends_with(token, '{e}') and length(token) - {len(e)} >= 3 and left(token, length(token) - {len(e)}) in (select r from b), false)" for e in T.ENDINGS) + " as starred from f")
def starred_roots(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("w")).where(F.col("w").rlike("[aeio]$") & (F.length("w") >= 4))
    roots = words.select(F.expr("left(w, length(w) - 1)").alias("r"))
    return repair.star(lexicon.frequency(table(spark, sf_dir, "documents"), "text").select("token"), "token", roots, "r")


@query("""with f as (select item_id, text, string_split(text, ' ')[1] as a, string_split(text, ' ')[3] as b from benchmark where len(string_split(text, ' ')) >= 3),
 p as (select *, instr(text, a) as pa from f)
 select item_id, pa::int as first, case when instr(substr(text, pa + length(a)), b) > 0 then pa + length(a) + instr(substr(text, pa + length(a)), b) - 1 else instr(text, b) end::int as second from p""")
def fragment_places(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id", "text", F.split("text", " ").alias("w")).where(F.size("w") >= 3)
    at = repair.locate(F.col("text"), F.array(F.col("w")[0], F.col("w")[2]))
    return b.select("item_id", at.alias("at")).select("item_id", F.col("at")[0].alias("first"), F.col("at")[1].alias("second"))


@query("select distinct unnest(regexp_extract_all(text, '[A-Za-z]+-[A-Za-z]+')) as compound from documents union select distinct unnest(regexp_extract_all(url, '[a-z]+-[a-z]+')) from pages")
def compound_set(spark, sf_dir):
    every = lambda df, c, p: df.select(F.explode(F.regexp_extract_all(c, F.lit(p), F.lit(0))).alias("compound"))
    return every(table(spark, sf_dir, "documents"), "text", "[A-Za-z]+-[A-Za-z]+").unionByName(every(table(spark, sf_dir, "pages"), "url", "[a-z]+-[a-z]+")).distinct()


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents) select doc_id, min(length(line) - length(ltrim(line, ' '))) as margin, count(*) as lines from l where trim(line, ' ') <> '' group by 1""")
def page_margin(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''")
    return lines.groupBy("doc_id").agg(F.min(F.length("line") - F.length(F.ltrim("line"))).cast("long").alias("margin"), F.count("*").alias("lines"))


@query("""select case when regexp_matches(t, '^[0-9]') then '1 number' when t = upper(t) then '2 capitals' when regexp_matches(t, '^[A-Z]') then '3 name' else '4 word' end as family, count(*) as n
 from (select unnest(regexp_extract_all(text, '[A-Za-z0-9]{2,}')) as t from documents) group by 1""")
def rule_families(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select(F.explode(T.tokens(F.col("text"))).alias("t"))
    family = F.when(F.col("t").rlike("^[0-9]"), "1 number").when(F.col("t") == F.upper("t"), "2 capitals").when(F.col("t").rlike("^[A-Z]"), "3 name").otherwise("4 word")
    return t.groupBy(family.alias("family")).agg(F.count("*").alias("n"))


@query(f"""with {TOKENS_SQL}, v as (select token, n, lower(token) as variant from f where n <= 5 and token <> lower(token) union select token, n, token || 'o' from f where n <= 5 union select token, n, token || 'e' from f where n <= 5),
 h as (select v.token, v.n, v.variant, f.n as vn, row_number() over (partition by v.token order by f.n desc, v.variant desc) as rn, lead(f.n) over (partition by v.token order by f.n desc, v.variant desc) as second from v join f on f.token = v.variant)
 select token, n, variant, vn as variant_n from h where rn = 1 and vn >= 8 and vn >= 8 * n and coalesce(second, 0) * 3 <= vn""")
def lexicon_correction(spark, sf_dir):
    freq = lexicon.frequency(table(spark, sf_dir, "documents"), "text").select("token", "n")
    rare = freq.where("n <= 5").select("token", "n", F.explode(F.array_distinct(F.array(F.lower("token"), F.concat("token", F.lit("o")), F.concat("token", F.lit("e"))))).alias("variant")).where("variant <> token")
    return repair.correct(freq, rare)


@query()
def self_training(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").withColumn("known", F.when(F.col("vec_id") % 3 == 0, F.col("label")))
    return repair.self_train(emb, "vec_id", "embedding", "known").select("vec_id", "label", F.round("sure", 4).alias("sure"))


@query()
def perceptron_votes(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").withColumn("known", F.when(F.col("vec_id") % 2 == 0, F.col("label")))
    return repair.cluster_votes(repair.perceptron(emb, "vec_id", "embedding", "known").withColumn("cluster", F.col("vec_id") % 20), "cluster", "posterior")
