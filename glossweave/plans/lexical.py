"""Search and lexicon queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lexicon, matching, search
from .base import query, table

SEARCHES = ("gizmo", "rings", "small", "brandnew", "hot rod")

RANK_SQL = """
case when f = q then 0 when starts_with(f, q) then 1 when contains(f, q) then 2
 when length(q) >= 4 and levenshtein(f, q) <= 1 then 3 when length(q) >= 4 and levenshtein(f, q) <= 2 then 4 end"""
SEARCH_SQL = f"""
q as (select unnest(['{"', '".join(SEARCHES)}']) as q),
f as (select p_partkey, p_name, lower(p_type || ' ' || p_brand) as body, unnest(list_concat([lower(p_name)], string_split(lower(p_name), ' '))) as f from part),
r as (select q, p_partkey, p_name, body, min({RANK_SQL}) as r from f, q group by all),
s as (select q, p_partkey, p_name, coalesce(r, case when contains(body, q) then 5 end) as rank from r)"""


def forms():
    return F.concat(F.array(F.lower("p_name")), F.split(F.lower("p_name"), " "))


@query(f"with {SEARCH_SQL} select p_partkey, p_name, cast(rank as int) as rank from s where q = 'rings' and rank is not null order by rank, p_name, p_partkey limit 400")
def search_ranked(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    body = F.concat_ws(" ", "p_type", "p_brand")
    return search.search(part, "rings", forms(), body, ["p_name", "p_partkey"]).select("p_partkey", "p_name", "rank")


@query(f"with {SEARCH_SQL} select q, cast(rank as int) as rank, count(*) as n from s where rank is not null group by all")
def search_ranked_count(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    ranks = F.array(*(F.struct(F.lit(q).alias("q"), search.rank_of(forms(), F.concat_ws(" ", "p_type", "p_brand"), q).alias("rank")) for q in SEARCHES))
    return part.select(F.explode(ranks).alias("r")).select("r.*").where("rank is not null").groupBy("q", "rank").agg(F.count("*").alias("n"))


TOKENS_SQL = "t as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9]{2,}')) as token from documents), f as (select token, count(*) as n, count(distinct doc_id) as docs from t group by token)"


@query(f"with {TOKENS_SQL} select token, n, docs from f")
def token_frequency(spark, sf_dir):
    return lexicon.frequency(table(spark, sf_dir, "documents"), "text")


def respell_sql(pairs, rare, least, ratio):
    both = sorted({(a, b) for x, y in pairs for a, b in ((x, y), (y, x))})
    values = ", ".join(f"('{a}', '{b}')" for a, b in both)
    return f"""with {TOKENS_SQL}, p(a, b) as (values {values}),
    c as (select token, n, unnest(range(1, length(token) + 1)) as i from f where n <= {rare} and length(token) >= 3),
    v as (select c.token, c.n, i, substr(token, 1, i - 1) || b || substr(token, i + 1) as variant from c join p on substr(token, i, 1) = a),
    h as (select v.*, f.n as vn, row_number() over (partition by v.token order by f.n desc, i, variant) as rn from v join f on f.token = variant where f.n >= {least} and f.n >= {ratio} * v.n)
    select token, n, variant, vn as variant_n, cast(i as int) as position from h where rn = 1"""


def respelled(spark, sf_dir, **limits):
    return lexicon.respell(lexicon.frequency(table(spark, sf_dir, "documents"), "text"), **limits)


@query(respell_sql(lexicon.CONFUSABLE, 2, 6, 8))
def lookalike_strict(spark, sf_dir):
    return respelled(spark, sf_dir)


@query(respell_sql(lexicon.CONFUSABLE, 2, 4, 5))
def lookalike_loose(spark, sf_dir):
    return respelled(spark, sf_dir, least=4, ratio=5)


@query(respell_sql((("c", "o"),), 2, 6, 8))
def lookalike_co(spark, sf_dir):
    return respelled(spark, sf_dir, pairs=(("c", "o"),))


STEMS_SQL = " union all ".join(["select token, token as stem from f", *(f"select token, left(token, length(token) - {len(e)}) as stem from f where ends_with(token, '{e}') and length(token) - {len(e)} >= 2" for e in T.ENDINGS)])


@query(f"""with {TOKENS_SQL}, l as (select distinct unnest(regexp_extract_all(text, '[A-Za-z0-9]{{2,}}')) as word from benchmark),
 s as ({STEMS_SQL}), k as (select distinct token from s join l on stem = word)
 select f.token, f.n from f left join k using (token) where k.token is null""")
def unknown_tokens(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("word")).distinct()
    return lexicon.unknown(lexicon.frequency(table(spark, sf_dir, "documents"), "text").select("token", "n"), words)


@query("""with n as (select doc_id, text, ' ' || regexp_replace(text, '[^A-Za-z]', ' ', 'g') || ' ' as plain from documents), d as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Za-z]{4,}'))) as token from documents),
 f as (select token, min(doc_id) as doc_id from d group by token), a as (select f.token, f.doc_id, n.text, instr(n.plain, ' ' || f.token || ' ') as p from f join n using (doc_id))
 select token, doc_id, p as at,
  case when p > 43 then '…' else '' end || substr(text, greatest(p - 42, 1), 84) || case when greatest(p - 42, 1) + 84 <= length(text) then '…' else '' end as context from a""")
def first_context(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexicon.first_context(docs, "doc_id", "text").select("token", "doc_id", F.col("at").cast("long").alias("at"), "context")


@query(f"""with {TOKENS_SQL},
 e as (select token, n, '^' || token || '$' as w from f where length(token) >= 2),
 g as (select token, n, unnest(list_transform(range(1, length(w) - 2), lambda i: substr(w, i, 4))) as g from e),
 c as (select g, sum(n) as gn from g group by g), h as (select left(g, 3) as h, sum(gn) as hn, count(*) as kinds from c group by 1),
 p as (select g, log10((gn + 0.2) / (hn + 0.2 * kinds)) as lp from c join h on left(g, 3) = h)
 select token, round(avg(lp), 6) as score from g join p using (g) group by token""")
def ngram_score(spark, sf_dir):
    freq = lexicon.frequency(table(spark, sf_dir, "documents"), "text")
    return lexicon.ngram_scores(freq).select("token", F.round("score", 6).alias("score"))


@query("select doc_id, item_id from documents d, benchmark b where contains(d.text, b.text)")
def containment_join(spark, sf_dir):
    return matching.containing(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark").withColumnRenamed("text", "passage"), "item_id", "passage")


@query("""with h as (select item_id, length(b.text) as len, b.text as passage, count(*) as n from documents d, benchmark b where contains(d.text, b.text) group by all)
 select b.item_id, coalesce(n, 0) as n, case when n is null then 'unseen' when n > 1 and length(b.text) < 6 and not contains(b.text, ' ') then 'refused' else 'applied' end as status
 from benchmark b left join h using (item_id)""")
def containment_status(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "passage")
    hits = matching.containing(table(spark, sf_dir, "documents"), "doc_id", "text", bench, "item_id", "passage").groupBy("item_id").agg(F.count("*").alias("n"))
    vague = (F.col("n") > 1) & (F.length("passage") < 6) & ~F.col("passage").contains(" ")
    return bench.join(hits, "item_id", "left").select("item_id", F.when(F.col("n").isNull(), "unseen").when(vague, "refused").otherwise("applied").alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


WORDS = {"the": "THE", "and": "&", "der": "d.", "que": "q.", "les": "l."}


@query("select doc_id, md5(list_reduce(list_transform(string_split(text, ' '), lambda w: case w " + " ".join(f"when '{a}' then '{b}'" for a, b in WORDS.items()) + " else w end), lambda a, b: a || ' ' || b)) as digest from documents")
def dictionary_replace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(matching.replace_words(F.col("text"), WORDS)).alias("digest"))


@query("""with p as (select p_partkey, p_name, unnest(range(1, length(p_name) - 3)) as i from part where length(p_name) >= 5),
 h as (select p_partkey, p_name, i, len(list_filter(range(1, 6), lambda k: substr(p_name, i + k - 1, 1) <> substr('gismo', k, 1))) as d from p)
 select p_partkey, p_name, min(d) as distance from h group by all having min(d) <= 1""")
def sliding_hamming(spark, sf_dir):
    d = matching.sliding_hamming(F.col("p_name"), "gismo")
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", d.cast("long").alias("distance")).where(F.col("distance") <= 1 + len("gismo") // 12)
