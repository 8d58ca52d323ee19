"""Overlay, join and vote queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import matching, overlay, sequence
from ..operators import quantiles as exact_quantiles
from .base import query, table


@query("""with l as (select user_id, event_type, max_by(value, event_id) as value from events where event_id % 3 = 0 group by all),
 b as (select user_id, event_type, min_by(value, event_id) as value from events where event_id % 3 <> 0 group by all)
 select coalesce(b.user_id, l.user_id) as user_id, coalesce(b.event_type, l.event_type) as event_type, coalesce(l.value, b.value) as value,
  l.value is not null and l.value is distinct from b.value as changed
 from b full join l on b.user_id = l.user_id and b.event_type = l.event_type""")
def overlay_last_wins(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    keys = ["user_id", "event_type"]
    base = ev.where("event_id % 3 <> 0").groupBy(*keys).agg(F.min_by("value", "event_id").alias("value"))
    patch = overlay.last_wins(ev.where("event_id % 3 = 0"), keys, "value", ["event_id"])
    return overlay.lay_over(base, patch, keys, "value")


@query("""with o as (select o_orderkey as k, o_totalprice as amount, o_orderstatus as status from orders),
 l as (select l_orderkey as k, max(l_extendedprice) as amount, max(l_linestatus) as status from lineitem group by 1)
 select coalesce(o.k, l.k) as k, coalesce(l.amount, o.amount) as amount, coalesce(l.status, o.status) as status from o full join l on o.k = l.k""")
def upsert_full_outer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("amount"), F.max("l_linestatus").alias("status"))
    return overlay.upsert(o, li, ["k"], ["amount", "status"])


@query("""with n as (select user_id, event_type, max(event_id) as e from events where event_id % 7 = 0 group by all)
 select user_id, event_type, e from n union all
 select user_id, event_type, event_id as e from events where event_id % 7 <> 0 and (user_id, event_type) not in (select user_id, event_type from n)""")
def merge_rewritten(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    new = ev.where("event_id % 7 = 0").groupBy("user_id", "event_type").agg(F.max("event_id").alias("e"))
    return overlay.merge_rewritten(ev.where("event_id % 7 <> 0").select("user_id", "event_type", F.col("event_id").alias("e")), new, ["user_id", "event_type"])


@query("""select c_custkey, coalesce(s.v, w.v) as region from customer
 left join (select n_nationkey, c_mktsegment as seg, 'S' || n_name as v from nation, (select distinct c_mktsegment from customer) where n_nationkey % 3 = 0) s on s.n_nationkey = c_nationkey and s.seg = c_mktsegment
 left join (select n_nationkey, r_name as v from nation join region on n_regionkey = r_regionkey) w on w.n_nationkey = c_nationkey""")
def fallback_key_join(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    strong = cust.select("n_nationkey", "c_mktsegment").distinct().join(nation.where("n_nationkey % 3 = 0"), "n_nationkey").select("n_nationkey", "c_mktsegment", F.concat(F.lit("S"), "n_name").alias("region"))
    weak = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    return overlay.fallback(cust, strong, weak, ["n_nationkey", "c_mktsegment"], ["n_nationkey"], "region").select("c_custkey", "region")


@query("""with k as (select conv_id, list(turn || ':' || length(text) order by turn) as kids from conversations where role = 'assistant' group by 1)
 select c.conv_id, c.turn, coalesce(array_to_string(kids, ','), '') as kids from conversations c left join k on k.conv_id = c.conv_id and c.turn = 0 where c.role <> 'assistant' and c.turn = 0""")
def fold_child_into_parent(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").where("role = 'assistant' or turn = 0")
    item = F.concat_ws(":", F.col("turn").cast("string"), F.length("text").cast("string"))
    out = overlay.fold_children(conv, "conv_id", F.when(F.col("role") == "assistant", F.col("conv_id")), item, "turn", "kids")
    return out.select("conv_id", "turn", F.array_join("kids", ",").alias("kids"))


@query("""with d as (select conv_id, 1 as d_line, 2 as d_col from (select distinct conv_id from conversations) where conv_id % 3 = 0)
 select c.conv_id, turn + coalesce(d_line, 0) as line, length(text) + coalesce(d_col, 0) as col from conversations c left join d using (conv_id)""")
def key_shift_update(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line"), F.length("text").cast("long").alias("col"))
    off = conv.select("conv_id").distinct().where("conv_id % 3 = 0").select("conv_id", F.lit(1).alias("d_line"), F.lit(2).alias("d_col"))
    return overlay.shift_keys(conv, off, "conv_id", "line", "col")


@query("""select doc_id, case when quality = 0 then 'dropped' when toxic = 1 then 'review' else 'kept' end as status, n_chars
 from documents join labels using (doc_id)""")
def judgement_apply(spark, sf_dir):
    status = F.when(F.col("quality") == 0, "dropped").when(F.col("toxic") == 1, "review").otherwise("kept")
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", status.alias("status"), "n_chars")


@query("""with p as (select a.conv_id, a.turn, left(a.text, length(b.text)) as x, left(b.text, length(a.text)) as y, abs(length(a.text) - length(b.text)) <= 3 as ok
  from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1),
 m as (select conv_id, turn, ok, list_sum(list_transform(range(1, least(length(x), length(y)) + 1), lambda i: cast(substr(x, i, 1) = substr(y, i, 1) as int))) as same from p)
 select conv_id, turn, case when ok then 'matched' else 'rejected' end as status, case when ok then cast(coalesce(same, 0) as bigint) end as same from m""")
def length_guarded_match(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    a = conv.select("conv_id", "turn", F.col("text").alias("x"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("y"))
    ok = F.abs(F.length("x") - F.length("y")) <= 3
    n = F.least(F.length("x"), F.length("y"))
    same = F.size(F.filter(F.zip_with(F.split(F.substring(F.col("x"), F.lit(1), n), ""), F.split(F.substring(F.col("y"), F.lit(1), n), ""), lambda p, q: p == q), lambda v: v)).cast("long")
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", F.when(ok, "matched").otherwise("rejected").alias("status"), F.when(ok, same).alias("same"))


@query("select c_custkey, c_mktsegment from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def semi_membership(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(o, "c_custkey", "left_semi")


@query("select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
def anti_membership(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(o, "c_custkey", "left_anti")


@query("""with c as (select label, i, avg(embedding[i]::double) as m from embeddings, range(1, 65) t(i) group by all),
 z as (select label, list(m order by i) as c, sqrt(sum(m * m)) as n from c group by label),
 d as (select vec_id, z.label, round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::double * (c[i] / n))), 9) as s from embeddings, z)
 select vec_id, arg_min(label, struct_pack(a := -s, b := label)) as label, round(max(s), 5) as similarity from d group by vec_id""")
def nearest_centroid(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    out = matching.nearest(emb, "vec_id", "embedding", matching.centroids(emb, "label", "embedding"), "label")
    return out.select("vec_id", "label", F.round("similarity", 5).alias("similarity"))


@query("""with s as (select event_type, cast(floor(event_id / 5) as bigint) as pos, min(user_id) as v from events group by all),
 m as (select a.event_type, d.d as shift, count(*) as matches from s a, range(-4, 17) d(d), s b where a.event_type = b.event_type and b.pos = a.pos + d.d and a.v = b.v and d.d <> 0 group by all)
 select event_type, cast(arg_min(shift, struct_pack(a := -matches, b := shift)) as bigint) as shift, max(matches) as matches from m group by 1""")
def best_shift(spark, sf_dir):
    seq = table(spark, sf_dir, "events").groupBy("event_type", F.floor(F.col("event_id") / 5).alias("pos")).agg(F.min("user_id").alias("v"))
    left, right = seq, seq
    moved = matching.best_shift(left, right.where("v is not null"), "event_type", "pos", "v", range(-4, 0)).unionByName(matching.best_shift(left, right, "event_type", "pos", "v", range(1, 17)))
    return moved.groupBy("event_type").agg(F.min(F.struct((-F.col("matches")).alias("m"), "shift")).alias("b")).select("event_type", F.col("b.shift").cast("long").alias("shift"), (-F.col("b.m")).alias("matches"))


RANGES = "select user_id, event_type, cast(floor(epoch(ts) / 60) as bigint) as lo, cast(floor(epoch(ts) / 60) as bigint) + cast(floor(value) as bigint) as hi from events"


def ranges(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    minute = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60)
    return ev.select("user_id", "event_type", minute.alias("lo"), (minute + F.floor("value").cast("long")).alias("hi"))


@query(f"""with r as ({RANGES})
 select a.user_id, a.lo as a_lo, a.hi as a_hi, b.lo as b_lo, b.hi as b_hi from r a join r b on a.user_id = b.user_id and a.lo <= b.hi and b.lo <= a.hi where a.event_type = 'click' and b.event_type = 'purchase'""")
def interval_overlap(spark, sf_dir):
    r = ranges(spark, sf_dir)
    return matching.overlaps(r.where("event_type = 'click'"), r.where("event_type = 'purchase'"), "user_id", "lo", "hi", 240)


@query(f"""with r as ({RANGES}), m as (select *, max(hi) over (partition by user_id order by lo, hi rows between unbounded preceding and 1 preceding) as p from r),
 i as (select *, sum(case when lo - p <= 2 then 0 else 1 end) over (partition by user_id order by lo, hi rows unbounded preceding) as g from m)
 select user_id, min(lo) as lo, max(hi) as hi, count(*) as n from i group by user_id, g""")
def coalesce_ranges(spark, sf_dir):
    return sequence.coalesce_ranges(ranges(spark, sf_dir), ["user_id"], "lo", "hi", 2)


@query("""with v as (select source, lang, count(*) as votes from documents group by all), r as (select *, row_number() over (partition by source order by votes desc, lang) as rn, sum(votes) over (partition by source) as total from v)
 select source, lang, votes, cast(total as bigint) as total from r where rn = 1 and votes >= 3 and votes >= 0.6 * total""")
def majority_vote(spark, sf_dir):
    return sequence.majority(table(spark, sf_dir, "documents"), ["source"], "lang")


@query("""with s as (select source, case when avg(quality) >= 0.8 then 'model' end as m from documents join labels using (doc_id) group by 1),
 t as (select source, 'truth' as x from (select distinct source from documents) where source like '%1')
 select d.source, coalesce(t.x, s.m, 'none') as verdict, case when t.x is not null then 'truth' when s.m is not null then 'model' else 'default' end as origin
 from (select distinct source from documents) d left join t using (source) left join s using (source)""")
def priority_arbitration(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    names = docs.select("source").distinct()
    model = docs.join(table(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.when(F.avg("quality") >= 0.8, "model").alias("m"))
    truth = names.where("source like '%1'").withColumn("x", F.lit("truth"))
    return names.join(truth, "source", "left").join(model, "source", "left").select(
        "source", F.coalesce("x", "m", F.lit("none")).alias("verdict"), F.when(F.col("x").isNotNull(), "truth").when(F.col("m").isNotNull(), "model").otherwise("default").alias("origin"))


@query("""select sum(case when quality = 1 and p = 1 then 1 else 0 end)::bigint as tp, sum(case when quality = 0 and p = 1 then 1 else 0 end)::bigint as fp,
  sum(case when quality = 1 and p = 0 then 1 else 0 end)::bigint as fn, round(avg(case when quality = p then 1.0 else 0.0 end), 6) as matched
 from (select quality, case when contains(text, '|') or contains(text, '!!') or contains(text, '$$$') then 0 else 1 end as p from documents join labels using (doc_id))""")
def accuracy_positions(spark, sf_dir):
    p = F.when(F.contains("text", F.lit("|")) | F.contains("text", F.lit("!!")) | F.contains("text", F.lit("$$$")), 0).otherwise(1)
    both = table(spark, sf_dir, "documents").select("doc_id", p.alias("p")).join(table(spark, sf_dir, "labels"), "doc_id")
    return both.agg(F.count_if(F.expr("quality = 1 and p = 1")).alias("tp"), F.count_if(F.expr("quality = 0 and p = 1")).alias("fp"), F.count_if(F.expr("quality = 1 and p = 0")).alias("fn"), F.round(F.avg((F.col("quality") == F.col("p")).cast("double")), 6).alias("matched"))


@query("""with c as (select p_type as a, p_brand as b, count(*) as n from part group by all having count(*) >= 15)
 select a, b, n from c union all select b, a, n from c""")
def confusion_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("a"), F.col("p_brand").alias("b")).agg(F.count("*").alias("n")).where("n >= 15")
    return c.unionByName(c.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))


@query("""select l_returnflag, quantile_cont(l_extendedprice, 0.5) as med, quantile_cont(l_extendedprice, 0.99) as p99, max(l_extendedprice) as most, round(avg(l_extendedprice), 4) as mean, count(*) as n from lineitem group by 1""")
def quantiles(spark, sf_dir):
    lines, x = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice"), F.col("l_extendedprice")
    rest = lines.groupBy("l_returnflag").agg(F.max(x).alias("most"), F.round(F.avg(x), 4).alias("mean"), F.count("*").alias("n"))
    return exact_quantiles.exact(lines, ["l_returnflag"], "l_extendedprice", {"med": 0.5, "p99": 0.99}).join(rest, "l_returnflag")


@query("""with t as (select item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}')) as s from benchmark)
 select a.item_id as a, b.item_id as b, round(len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) as jaccard
 from t a join t b on a.item_id < b.item_id where len(list_intersect(a.s, b.s)) >= 12""")
def jaccard_sets(spark, sf_dir):
    t = table(spark, sf_dir, "benchmark").select("item_id", matching.flat_tokens(F.col("text")).alias("s"))
    c = F.col("both")
    return matching.similar_sets(t, "item_id", "s", 12).select("a", "b", F.round(c / (F.col("na") + F.col("nb") - c), 6).alias("jaccard"))


@query("""with u as (select doc_id, unnest(string_split(text, ' ')) as w, unnest(range(1, len(string_split(text, ' ')) + 1)) as i from documents),
 f as (select doc_id, lower(w) as k, min(i) as i, arg_min(w, i) as w from u where w <> '' group by 1, 2)
 select doc_id, md5(string_agg(w, ' ' order by i)) as digest, count(*) as n from f group by 1""")
def distinct_ordered(spark, sf_dir):
    """Each text's words once, whatever their case, in the order and spelling of their first place."""
    words = F.filter(F.split("text", " "), lambda w: w != "")
    kept = overlay.distinct_ignoring_case(words)
    # A text with a word is known by a sign that isn't a blank: a test of the words' number would compute them twice.
    out = table(spark, sf_dir, "documents").where(F.col("text").rlike("[^ ]")).select("doc_id", kept.alias("w"))
    return out.select("doc_id", F.md5(F.array_join("w", " ")).alias("digest"), F.size("w").cast("long").alias("n"))


@query("""with t as (select source as k, min(doc_id) as i from documents group by 1) select i as first, k as source, row_number() over (order by i) as place from t""")
def ordered_distinct_sources(spark, sf_dir):
    """The sources once each, in the order in which they come first."""
    docs = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("first"))
    return docs.select("first", "source", F.row_number().over(Window.orderBy("first")).cast("long").alias("place"))  # one row a source


@query("""select conv_id, string_agg(role, ',' order by first) as roles from (select conv_id, role, min(turn) as first from conversations group by 1, 2) group by 1""")
def ordered_distinct_lists(spark, sf_dir):
    """Each conversation's roles once, in the order in which they come up."""
    return overlay.ordered_distinct(table(spark, sf_dir, "conversations"), "conv_id", "role", "turn", "roles").select("conv_id", F.array_join("roles", ",").alias("roles"))


@query("""select conv_id, turn, text is null as empty from conversations where role = 'assistant' and conv_id not in (select conv_id from conversations where turn = 0 and role = 'user')""")
def orphan_children(spark, sf_dir):
    """Answers of conversations that no user's turn opens."""
    conv = table(spark, sf_dir, "conversations").where("role = 'assistant' or (turn = 0 and role = 'user')")
    out = overlay.orphans(conv, "conv_id", F.when(F.col("role") == "assistant", F.col("conv_id")))
    return out.select("conv_id", "turn", F.col("text").isNull().alias("empty"))


@query("""select p_brand, p_type, count(*) as n from part group by all order by n desc, p_brand, p_type limit 20""")
def most_common(spark, sf_dir):
    return sequence.most_common(table(spark, sf_dir, "part"), ["p_brand", "p_type"], 20)


@query("select p_partkey, p_name from part order by strip_accents(lower(p_name)), p_size desc, p_partkey limit 100")
def multi_key_order(spark, sf_dir):
    """The first hundred by folded name, size downwards, key."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return part.orderBy(T.fold(F.lower("p_name")), F.desc("p_size"), "p_partkey").limit(100).select("p_partkey", "p_name")


@query("""with h as (select doc_id, source, substr(md5('7:' || doc_id), 1, 16) as h from documents), v as (select *, row_number() over (partition by source order by substr(h, 1, 1) < '8', h, doc_id) as rn from h)
 select source, doc_id from v where rn <= 30""")
def capped_groups(spark, sf_dir):
    """Thirty rows a source, drawn by a seeded hash that both engines have."""
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit("7:"), "doc_id")), 1, 16), 16, -10).cast("long")
    return sequence.reservoir(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"], 30, by=hashed).select("source", "doc_id")


PHRASES = {"of the": "O", "the": "T", "and": "A", "de la": "D", "la": "L", "der": "R"}


@query("""with p as (select doc_id, list_concat(regexp_extract_all(text, '[A-Za-zÀ-ÿ0-9_]+|[^A-Za-zÀ-ÿ0-9_]'), ['', '']) as w from documents),
 k as (select doc_id, i, w[i] as one, w[i] || w[i + 1] || w[i + 2] as two, case when i > 2 then w[i - 2] || w[i - 1] || w[i] else '' end as ending from p, unnest(range(1, len(w) - 1)) as r(i)),
 f as (select case when two = 'of the' then 'O' when two = 'de la' then 'D' when ending in ('of the', 'de la') then null when one = 'the' then 'T' when one = 'and' then 'A' when one = 'la' then 'L' when one = 'der' then 'R' end as mark from k)
 select mark, count(*) as n from f where mark is not null group by mark""")
def phrase_replace_counts(spark, sf_dir):
    """What replace_phrases puts in, counted: whole words only, the longest phrase first, none inside another."""
    done = matching.replace_phrases(F.col("text"), {k: f"\u0001{v}\u0002" for k, v in PHRASES.items()})
    found = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(done, F.lit("\u0001([^\u0002]*)\u0002"), F.lit(1))).alias("mark"))
    return found.groupBy("mark").agg(F.count("*").alias("n"))


@query("""with c as (select *, row_number() over (partition by text order by n_chars desc, doc_id) as rn from documents) select doc_id, n_chars, source from c where rn = 1""")
def priority_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", F.sha2("text", 256).alias("h"))
    best = docs.groupBy("h").agg(F.min(F.struct((-F.col("n_chars")).alias("m"), "doc_id", "source")).alias("b"))
    return best.select(F.col("b.doc_id").alias("doc_id"), (-F.col("b.m")).alias("n_chars"), F.col("b.source").alias("source"))
