"""Keys, addresses, parentheticals, indexes, quality families, markup, hashes, exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as ty

from ..functions import text as T
from ..operators import parentheticals as P
from ..operators import quality, sequence
from .base import query, table

SLUG = "regexp_replace(regexp_replace(replace(strip_accents(lower({})), ' ', '-'), '[^a-z0-9-]', '', 'g'), '-{{2,}}', '-', 'g')"
ORDER = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({})), '^[*+\"«.\\-]+', ''), '!+$', ''), '-+$', ''), '[\\s \"''«»]', '', 'g')"
TITLE = "regexp_extract(text, '^[^ \\n]+ ?[^ \\n]*', 0)"


@query(f"""with s as (select doc_id, {SLUG.format(TITLE)} as slug from documents)
 select doc_id, slug, row_number() over (partition by slug order by doc_id) as rank, count(*) over (partition by slug) as shared from s""")
def rank_in_address(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select("doc_id", T.slug(F.regexp_extract("text", "^[^ \\n]+ ?[^ \\n]*", 0)).alias("slug"))
    shared = s.groupBy("slug").agg(F.count("*").alias("shared"))
    return sequence.ranked(s, "slug", "doc_id").join(shared, "slug").select("doc_id", "slug", F.col("rank").cast("long").alias("rank"), "shared")


@query(f"""with s as (select {SLUG.format('p_name')} as slug, p_partkey from part) select slug, count(*) as n, min(p_partkey) as first from s group by 1 having count(*) > 1""")
def shared_addresses(spark, sf_dir):
    s = table(spark, sf_dir, "part").select(T.slug(F.col("p_name")).alias("slug"), "p_partkey")
    return s.groupBy("slug").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first")).where("n > 1")


HEAD = "regexp_extract(text, '[^ \\n]+', 0)"
ROOT = f"regexp_replace({ORDER.format(HEAD)}, '({'|'.join(T.ENDINGS)})$', '')"


def stem_sql(col: str, least: int = 5) -> str:
    out = col
    for s in reversed(sorted(T.SUFFIXES, key=len, reverse=True)):
        out = f"case when ends_with({col}, '{s}') and length({col}) - {len(s)} >= {least} then left({col}, length({col}) - {len(s)}) else {out} end"
    return out


@query(f"""with k as (select doc_id, {ORDER.format(HEAD)} as key, {ROOT} as root from documents) select doc_id, key, root, {stem_sql('root')} as stem from k""")
def root_stem_keys(spark, sf_dir):
    head = F.regexp_extract("text", "[^ \\n]+", 0)
    return table(spark, sf_dir, "documents").select("doc_id", T.order_key(head).alias("key"), T.root_key(head).alias("root"), T.stem_key(head).alias("stem"))


FAKO_SQL = """case p_partkey % 9 when 0 then 'trans.' when 1 then 'trans., ' || lower(p_type) when 2 then 'trans.) (' || lower(p_brand) when 3 then 'trans.) e (netrans., pri, per'
 when 4 then 'netrans., ad ulo' when 5 then 'pri rejo' when 6 then lower(p_type) || ') (kun, sen' when 7 then 'trans., e netrans.' else '' end"""
MARK_SQL = P.MARK
ABLE = ", ".join(f"'{w}'" for w in (*T.PREPOSITIONS, *T.PLACEHOLDERS))
ADMITTED = ABLE + ", " + ", ".join(f"'{w}'" for w in T.CONJUNCTIONS)
DECOMPOSED = f"""f as (select p_partkey, p_name, {FAKO_SQL} as fako from part),
 a as (select p_partkey, p_name, list_filter(list_transform(string_split_regex(fako, '{P.BOUNDARY}'), lambda p: trim(p, '() ')), lambda p: p <> '') as parts from f),
 m as (select *, list_filter(list_transform(parts, lambda p: regexp_extract(p, '{MARK_SQL}', 1)), lambda x: x <> '') as marks,
  list_filter(list_transform(parts, lambda p: case when regexp_matches(p, '{MARK_SQL}') then trim(regexp_extract(p, '{MARK_SQL}', 2), ', ') else p end), lambda p: p <> '') as rest from a),
 g as (select *, list_transform(rest, lambda p: len(list_filter(string_split_regex(p, '[\\s,]+'), lambda t: t not in ({ADMITTED}))) = 0 and len(list_filter(string_split_regex(p, '[\\s,]+'), lambda t: t in ({ABLE}))) > 0) as gov from m),
 d as (select p_partkey, p_name, case when t and n then 'both' when t then 'transitive' when n then 'intransitive' end as kind,
   list_filter(rest, lambda p, i: gov[i]) as governments, list_filter(rest, lambda p, i: not gov[i]) as notes
  from (select *, len(list_filter(marks, lambda x: contains(x, ' e ') or starts_with(x, 'trans'))) > 0 as t, len(list_filter(marks, lambda x: contains(x, ' e ') or starts_with(x, 'netrans'))) > 0 as n from g))"""


def fako():
    k, low = F.col("p_partkey") % 9, lambda c: F.lower(F.col(c))
    return (
        F.when(k == 0, "trans.").when(k == 1, F.concat(F.lit("trans., "), low("p_type"))).when(k == 2, F.concat(F.lit("trans.) ("), low("p_brand")))
        .when(k == 3, "trans.) e (netrans., pri, per").when(k == 4, "netrans., ad ulo").when(k == 5, "pri rejo")
        .when(k == 6, F.concat(low("p_type"), F.lit(") (kun, sen"))).when(k == 7, "trans., e netrans.").otherwise("")
    )


def decomposed(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", P.decompose(fako()).alias("d")).select("p_partkey", "p_name", "d.*")


@query(f"with {DECOMPOSED} select p_partkey, kind, array_to_string(governments, '|') as governments, array_to_string(notes, '|') as notes from d")
def parenthetical_decompose(spark, sf_dir):
    return decomposed(spark, sf_dir).select("p_partkey", "kind", F.array_join("governments", "|").alias("governments"), F.array_join("notes", "|").alias("notes"))


@query(f"""with {DECOMPOSED}, u as (select p_name, unnest(governments) as g from d), e as (select p_name, unnest(string_split_regex(g, '[\\s,]+')) as w from u)
 select w as key, array_to_string(list_sort(list(distinct p_name)), ',') as items, count(distinct p_name) as n from e where w in ({", ".join(f"'{w}'" for w in T.PREPOSITIONS)}) group by 1""")
def preposition_index(spark, sf_dir):
    words = decomposed(spark, sf_dir).select("p_name", F.explode("governments").alias("g")).select("p_name", F.explode(F.split("g", "[\\s,]+")).alias("w")).where(F.col("w").isin(*T.PREPOSITIONS))
    return P.inverted(words, F.col("w"), F.col("p_name")).select("key", F.array_join("items", ",").alias("items"), "n")


@query(f"with {DECOMPOSED} select n as field, count(distinct p_name) as words from (select unnest(notes) as n, p_name from d) group by 1 having count(distinct p_name) >= 5")
def field_counts(spark, sf_dir):
    notes = decomposed(spark, sf_dir).select(F.explode("notes").alias("field"), "p_name")
    return notes.distinct().groupBy("field").agg(F.count("*").alias("words")).where("words >= 5")


@query(f"""with {DECOMPOSED}, k as (select p_name, len(list_distinct(list(kind))) as kinds, min(kind) as one from d where kind is not null group by 1)
 select case when kinds = 1 then one else 'by sense' end as class, count(*) as n from k group by 1""")
def verb_classes(spark, sf_dir):
    k = decomposed(spark, sf_dir).where("kind is not null").groupBy("p_name").agg(F.size(F.collect_set("kind")).alias("kinds"), F.min("kind").alias("one"))
    return k.groupBy(F.when(F.col("kinds") == 1, F.col("one")).otherwise("by sense").alias("class")).agg(F.count("*").alias("n"))


@query("select source as key, array_to_string(list_sort(list(distinct lang)), ',') as items, count(distinct lang) as n from documents group by 1 having count(distinct lang) >= 2")
def inverted_index(spark, sf_dir):
    return P.inverted(table(spark, sf_dir, "documents"), F.col("source"), F.col("lang"), 2).select("key", F.array_join("items", ",").alias("items"), "n")


@query("""with k as (select conv_id, role, max(turn) as last, count(*) as n from conversations group by all)
 select conv_id, string_agg(role || '=' || last, ',' order by role) as kinds, sum(n) filter (where role = 'user')::bigint as users, count(*) > 2 as mixed from k group by 1""")
def kind_by_sense(spark, sf_dir):
    k = table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.max("turn").alias("last"), F.count("*").alias("n"))
    pair = F.concat("role", F.lit("="), F.col("last").cast("string"))
    return k.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("kinds"), F.sum(F.when(F.col("role") == "user", F.col("n"))).alias("users"), (F.count("*") > 2).alias("mixed"))


@query("""with t as (select case event_type when 'error' then 'Err::' when 'click' then 'UI::::' else 'evt::' end || case user_id % 4 when 0 then 'A B' when 1 then 'a b' when 2 then '-c-' else '' end as raw from events),
 g as (select regexp_replace(regexp_replace(regexp_replace(raw, '\\s+', '-', 'g'), '::+', ':', 'g'), '^-+|-+$', '', 'g') as tag from t)
 select split_part(tag, ':', 1) as prefix, count(distinct lower(tag)) as tags from g group by 1""")
def tag_prefix_counts(spark, sf_dir):
    k, u = F.col("event_type"), F.col("user_id") % 4
    raw = F.concat(F.when(k == "error", "Err::").when(k == "click", "UI::::").otherwise("evt::"), F.when(u == 0, "A B").when(u == 1, "a b").when(u == 2, "-c-").otherwise(""))
    g = table(spark, sf_dir, "events").select(T.tagify(raw).alias("tag"))
    return g.groupBy(F.split_part("tag", F.lit(":"), F.lit(1)).alias("prefix")).agg(F.countDistinct(F.lower("tag")).alias("tags"))


@query("""with c as (select doc_id, list_concat(case when not regexp_matches(split_part(text, ' ', 1), '^[A-Za-zÀ-ÿ''’-]+[.,]?$') then ['head characters'] else [] end,
  list_concat(case when not regexp_matches(lower(regexp_extract(split_part(text, ' ', 1), '^[A-Za-zÀ-ÿ]+', 0)), '(ar|ir|or|o|a|e|i|s|n)$') then ['head ending'] else [] end,
  list_concat(case when length(text) < 40 then ['short'] else [] end,
  list_concat(case when regexp_matches(text, '^[.,;:)\\]]') then ['leading mark'] when regexp_matches(text, '[a-z]- [a-z]') then ['open hyphen'] when regexp_matches(text, '[ \\n]{2,}') then ['double blank'] else [] end,
  list_concat(case when contains(text, '|') then ['table'] else [] end, case when regexp_matches(text, '(###|\\$\\$\\$|%%%|&&&)') then ['signs'] else [] end))))) as f from documents)
 select family, count(*) as n from (select unnest(f) as family from c) group by 1""")
def quality_families(spark, sf_dir):
    head, text = F.split_part("text", F.lit(" "), F.lit(1)), F.col("text")
    word = F.lower(F.regexp_extract(head, "^[A-Za-zÀ-ÿ]+", 0))
    checks = [
        ("head characters", ~head.rlike("^[A-Za-zÀ-ÿ'’-]+[.,]?$")), ("head ending", ~word.rlike("(ar|ir|or|o|a|e|i|s|n)$")), ("short", F.length(text) < 40),
        quality.first_of(("leading mark", text.rlike("^[.,;:)\\]]")), ("open hyphen", text.rlike("[a-z]- [a-z]")), ("double blank", text.rlike("[ \\n]{2,}"))),
        ("table", F.contains("text", F.lit("|"))), ("signs", text.rlike("(###|\\$\\$\\$|%%%|&&&)")),
    ]
    return quality.families(table(spark, sf_dir, "documents"), checks).groupBy("family").agg(F.count("*").alias("n"))


@query("""with w as (select distinct upper(w) as word from (select unnest(regexp_extract_all(text, '[A-Za-z]+')) as w from documents))
 select word, case when regexp_matches(word, '^[DEFIRSLPGN]{1,12}$') and len(list_distinct(string_split(word, ''))) = length(word) then
  array_to_string(list_filter(string_split('DEFIRSLPGN', ''), lambda l: contains(word, l)), '') end as code from w""")
def code_reorder(spark, sf_dir):
    """Every word of the texts, in capitals, with the code it makes, if any, in the order of the alphabet."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.transform(T.tokens(F.col("text"), "[A-Za-z]+"), F.upper)).alias("word")).distinct()
    return words.select("word", T.read_code(F.col("word"), T.CODE_ORDER).alias("code"))


HTML = "html"
for _a, _b in (("(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), ("(?s)<!--.*?-->", " "), ("</?i>", "*"), ("</?b>", "**"), ("<[^>]*>", " "), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"), ("[ \\t\\n\\r]+", " ")):
    HTML = f"regexp_replace({HTML}, '{_a}', '{_b}', 'g')"


@query(f"select page_id, trim({HTML}, ' ') as text from pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("""select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, regexp_extract(html, '<html lang="([a-z]+)"', 1) as lang,
 array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') as links, regexp_extract(html, 'track\\(([0-9]+)\\)', 1)::bigint as track from pages""")
def embedded_values(spark, sf_dir):
    h = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, '<html lang="([a-z]+)"', 1).alias("lang"),
        F.array_join(F.regexp_extract_all(h, F.lit('<a href="([^"]*)"'), F.lit(1)), " ").alias("links"), F.regexp_extract(h, "track\\(([0-9]+)\\)", 1).try_cast("long").alias("track"))


@query("select event_type, sum((props->>'$.k')::bigint)::bigint as total, max((props->>'$.k')::bigint) as most, count(*) as n from events group by 1")
def json_props(spark, sf_dir):
    k = F.from_json("props", ty.StructType([ty.StructField("k", ty.LongType())]))["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.max(k).alias("most"), F.count("*").alias("n"))


@query("select c_custkey, ('0x' || left(sha1(c_name), 8))::bigint as csum from customer")
def csum_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.csum(F.col("c_name")).alias("csum"))


_DIGITS = " || ".join(f"substr('{T.BASE91}', 1 + ((n // {91 ** i}::hugeint) % 91)::int, 1)" for i in range(9, 0, -1)) + f" || substr('{T.BASE91}', 1 + (n % 91)::int, 1)"


@query(f"""with h as (select c_custkey, ('0x' || left(sha256('customer' || chr(31) || c_name || chr(31) || '1'), 16))::ubigint::hugeint as n from customer)
 select c_custkey, ltrim(d, 'a') as guid from (select c_custkey, {_DIGITS} as d from h)""")
def guid_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.guid(F.concat_ws("\x1f", F.lit("customer"), "c_name", F.lit("1"))).alias("guid"))


@query("""with e as (select p_partkey, p_name, lower(p_type || ' ' || p_brand || ' ' || p_name || case when p_partkey % 3 = 0 then ' and more' else '' end) as body, case p_partkey % 5 when 0 then '-' || p_name when 1 then p_name || '-' else p_name end as v from part),
 r as (select *, case """ + " ".join(f"when ends_with(v, '{e}') and length(v) - {len(e)} >= 3 then left(v, length(v) - {len(e)})" for e in T.ENDINGS) + """ else v end as root from e)
 select case when starts_with(v, '-') or ends_with(v, '-') then 'affix' when length(body) < 25 then 'short' when length(root) >= 3 and contains(body, root) then 'reveals itself' else 'kept' end as gate, count(*) as n from r group by 1""")
def reverse_gate(spark, sf_dir):
    k = F.col("p_partkey")
    v = F.when(k % 5 == 0, F.concat(F.lit("-"), "p_name")).when(k % 5 == 1, F.concat("p_name", F.lit("-"))).otherwise(F.col("p_name"))
    body = F.lower(F.concat_ws(" ", "p_type", "p_brand", F.concat("p_name", F.when(k % 3 == 0, " and more").otherwise(""))))
    e = table(spark, sf_dir, "part").select(v.alias("v"), body.alias("body"))
    return e.groupBy(quality.reverse_gate(F.col("v"), F.col("body")).alias("gate")).agg(F.count("*").alias("n"))


@query("""with a as (select r_name, string_agg(upper(left(n_name, 1)) || lower(substr(n_name, 2)), '; ' order by n_nationkey) as names, count(*) as n from nation join region on n_regionkey = r_regionkey group by 1)
 select replace(lower(r_name), ' ', '-') as slug, '## ' || r_name || chr(10) || names as md, n from a""")
def per_key_concat(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = n.groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.initcap("n_name").alias("x")))).alias("s"), F.count("*").alias("n"))
    return a.select(T.slug(F.col("r_name")).alias("slug"), F.concat(F.lit("## "), "r_name", F.lit("\n"), F.array_join(F.transform("s", lambda s: s["x"]), "; ")).alias("md"), "n")


@query(f"""select doc_id, {"".join("regexp_replace(" for _ in T.SPACING)}text{"".join(", '" + a + "', '" + b.replace('$', chr(92)) + "', 'g')" for a, b in T.SPACING)} as text from documents""")
def tidy_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.tidy(F.col("text")).alias("text"))


_HEADS = "case p_partkey % 4 when 0 then p_name when 1 then '+' || upper(p_name) when 2 then '*' || replace(p_name, ' ', '(') || ')' else replace(p_name, ' ', '(') || ')O' end"


@query(f"""with v as (select p_partkey, {_HEADS} as v from part), l as (select p_partkey, v, case when left(v, 1) in ('*', '+') then substr(lower(v), 2) else lower(v) end as w from v),
 s as (select *, strpos(w, '(') as a, strpos(w, ')') as z from l)
 select p_partkey, v as headword, case when a > 0 then substr(w, 1, a - 1) || substr(w, z + 1) || '|' || substr(w, 1, a - 1) || substr(w, a + 1, z - a - 1) || substr(w, z + 1) else w end as forms from s""")
def search_forms(spark, sf_dir):
    """All forms of headwords with stars, crosses, capitals, and endings in brackets."""
    v = F.expr(_HEADS)
    return table(spark, sf_dir, "part").select("p_partkey", v.alias("headword"), F.array_join(T.search_forms(v), "|").alias("forms"))


@query("""select c_custkey, replace(replace(replace(c_name || ' & <' || c_mktsegment || '>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as html,
 replace(replace(replace(c_name || ' & 5% _x', '&', '\\&'), '%', '\\%'), '_', '\\_').replace('#', '\\#') as latex,
 case when ends_with(c_name || s, '...') or ends_with(c_name || s, 'e c.') then c_name || s else regexp_replace(c_name || s, '[ ,;:.]+$', '') end as trimmed
 from (select *, case c_custkey % 4 when 0 then '...' when 1 then ' ;,' when 2 then ' e c.' else '' end as s from customer)""")
def escapes(spark, sf_dir):
    k = F.col("c_custkey") % 4
    s = F.concat("c_name", F.when(k == 0, "...").when(k == 1, " ;,").when(k == 2, " e c.").otherwise(""))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", T.esc_html(F.concat("c_name", F.lit(" & <"), "c_mktsegment", F.lit(">"))).alias("html"), T.esc_latex(F.concat("c_name", F.lit(" & 5% _x"))).alias("latex"), T.trim_end(s).alias("trimmed"))
