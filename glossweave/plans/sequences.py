"""Window and sequence queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import order, quantiles, sequence
from .base import query, table
from .derive import ORDER, ROOT, stem_sql


@query("""with s as (select *, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn rows unbounded preceding) as segment from conversations)
 select conv_id, segment::bigint as segment, count(*) as turns, sum(length(text))::bigint as chars, min(turn) as first from s where segment > 0 group by all""")
def segment_sessions(spark, sf_dir):
    s = sequence.segment(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user").where("segment > 0")
    return s.groupBy("conv_id", "segment").agg(F.count("*").alias("turns"), F.sum(F.length("text").cast("long")).alias("chars"), F.min("turn").alias("first"))


@query("""select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows unbounded preceding) as asked from conversations""")
def as_of_heading(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return sequence.running_last(conv, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "asked").select("conv_id", "turn", "asked")


@query("""with f as (select conv_id, arg_max(text, turn) as tail, max(turn) as turns from conversations group by 1), h as (select conv_id, text as head from conversations where turn = 0 and role = 'user')
 select h.conv_id, f.conv_id as into_conv, length(head) + length(tail) as chars from h join f on f.conv_id = h.conv_id - 1
 where not regexp_matches(tail, '[-!]$') and length(head) >= 8 and contains(head, ' ')""")
def page_adjacency(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    tail = conv.groupBy(F.col("conv_id").alias("into_conv")).agg(F.max_by("text", "turn").alias("tail"))
    head = conv.where("turn = 0 and role = 'user'").select("conv_id", F.col("text").alias("head"), (F.col("conv_id") - 1).alias("into_conv"))
    ok = ~F.col("tail").rlike("[-!]$") & (F.length("head") >= 8) & F.col("head").contains(" ")
    return head.join(tail, "into_conv").where(ok).select("conv_id", "into_conv", (F.length("head") + F.length("tail")).cast("long").alias("chars"))


KEYS = f"select doc_id, source, regexp_extract(text, '[^ \\n]+', 0) as word, {ORDER.format('regexp_extract(text, ' + chr(39) + '[^ ' + chr(92) + 'n]+' + chr(39) + ', 0)')} as key, {ROOT} as root from documents"


@query(f"""with k as ({KEYS}), s as (select *, {stem_sql('root')} as stem from k),
 l as (select *, lag(key) over w as pk, lag(root) over w as pr, lag(stem) over w as ps, lag(word) over w as pw from s window w as (partition by source order by doc_id))
 select doc_id, word, coalesce(key < pk and key <> '' and pk <> '' and root < pr and root <> '' and pr <> '' and stem < ps and stem <> '' and ps <> '' and not contains(word, ' ') and not contains(pw, ' '), false) as broken from l""")
def order_breaks(spark, sf_dir):
    word = F.regexp_extract("text", "[^ \\n]+", 0)
    k = table(spark, sf_dir, "documents").select("doc_id", "source", word.alias("word"), T.order_key(word).alias("key"), T.root_key(word).alias("root"), T.stem_key(word).alias("stem"))
    return sequence.order_breaks(k, "source", "doc_id", ["key", "root", "stem"], "word").select("doc_id", "word", "broken")


ORDERLY = "len(list_filter(range(2, len({0}) + 1), lambda i: {0}[i] < {0}[i - 1])) = 0"


@query(f"""with l as (select p_brand, p_partkey, p_name, lag(p_name) over o as before, list(p_name) over (o rows between 3 preceding and 2 preceding) as x,
   list(p_name) over (o rows between 1 following and 3 following) as y from part window o as (partition by p_brand order by p_partkey)),
  c as (select *, list_concat(list_concat(coalesce(x, []), [p_name, before]), coalesce(y, [])) as swap, list_concat(list_concat(coalesce(x, []), [before]), coalesce(y, [])) as less,
   list_concat(list_concat(coalesce(x, []), [p_name]), coalesce(y, [])) as other from l where p_name < before)
 select p_partkey, case when {ORDERLY.format('swap')} then 'swapped' else 'astray' end as kind, {ORDERLY.format('less')} as without_it, {ORDERLY.format('other')} as without_previous from c""")
def order_frame(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name")
    return order.frame(part, "p_brand", "p_partkey", "p_name").select("p_partkey", "kind", "without_it", "without_previous")


@query("""with l as (select p_brand, p_partkey, p_name, lag(p_name) over w as b from part window w as (partition by p_brand order by p_partkey)),
 o as (select * from l where p_name < b)
 select o.p_partkey, count(*) filter (where p.p_name < o.p_name) as rank, max(p.p_name) filter (where p.p_name < o.p_name) as after, min(p.p_name) filter (where p.p_name > o.p_name) as before
 from o join part p on p.p_brand = o.p_brand group by o.p_partkey""")
def insertion_points(spark, sf_dir):
    """Where a row that breaks the order belongs among its brand's names."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name")
    odd = order.frame(part, "p_brand", "p_partkey", "p_name").select("p_brand", "p_partkey", "p_name")
    return order.insertion(odd, part, "p_brand", "p_partkey", "p_name").select("p_partkey", "rank", "after", "before")


@query("""with k as (select doc_id, source, regexp_extract(text, '[A-Z][a-z]+', 0) as key from documents), f as (select *, lag(key) over (partition by source order by doc_id) as p from k where key <> '')
 select k.doc_id, coalesce(f.key < f.p, false) as broken from k left join f using (doc_id)""")
def single_key_breaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.regexp_extract("text", "[A-Z][a-z]+", 0).alias("key"))
    return sequence.single_key_breaks(docs, "source", "doc_id", "key").select("doc_id", "broken")


LETTERS = "abcdefghijklmnopqrstuvwxyz"


@query(f"""with l as (select p_partkey, p_name, lag(p_name) over w as b, lead(p_name) over w as a from part window w as (partition by p_brand order by p_partkey)),
 c as (select p_partkey, p_name, b, a, i, s, substr(p_name, 1, i - 1) || s || substr(p_name, i + 1) as cand from l, (select unnest(string_split('{LETTERS}', '')) as s), (select unnest(range(1, 41)) as i)
  where i <= length(p_name) and b is not null and a is not null and b <= a and not (p_name >= b and p_name <= a)),
 g as (select *, row_number() over (partition by p_partkey order by i, s) as rn from c where cand >= b and cand <= a and cand <> p_name)
 select p_partkey, p_name, cand as fixed from g where rn = 1""")
def sandwich_fix(spark, sf_dir):
    return order.sandwich(table(spark, sf_dir, "part"), "p_brand", "p_partkey", "p_name", tuple(LETTERS)).select("p_partkey", "p_name", "fixed")


@query("select doc_id, floor((row_number() over (partition by source order by doc_id) - 1) / 130)::bigint as batch, ((row_number() over (partition by source order by doc_id) - 1) % 130)::bigint as place from documents")
def batch_ids(spark, sf_dir):
    return sequence.batches(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 130).select("doc_id", "batch", "place")


@query("select doc_id, lang, rn from (select doc_id, lang, row_number() over (partition by lang order by n_chars desc, doc_id) as rn from documents) where rn <= 50")
def top_per_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return sequence.top_per_group(docs, "lang", [F.desc("n_chars"), F.asc("doc_id")], 50).select("doc_id", "lang", F.col("rn").cast("long").alias("rn"))


@query("""with l as (select n_name, n_nationkey, left(n_name, 1) || n_regionkey as letter, lag(left(n_name, 1) || n_regionkey) over (order by n_regionkey, n_nationkey) as p from nation)
 select n_nationkey, case when p is distinct from letter then letter end as section from l""")
def section_breaks(spark, sf_dir):
    letter = F.concat(F.substring("n_name", 1, 1), F.col("n_regionkey").cast("string"))
    w = Window.orderBy("n_regionkey", "n_nationkey")  # one row a nation
    n = table(spark, sf_dir, "nation").select("n_nationkey", letter.alias("letter"), F.lag(letter).over(w).alias("p"))
    return n.select("n_nationkey", F.when(~F.col("p").eqNullSafe(F.col("letter")), F.col("letter")).alias("section"))


@query("""with s as (select doc_id, string_split(text, chr(10)) as lines from documents), t as (select doc_id, unnest(range(1, len(lines) + 1)) as n, unnest(lines) as line from s),
 c as (select doc_id, n, unnest(range(1, length(line) + 1)) as i, line from t),
 l as (select doc_id, n, i, line, i - row_number() over (partition by doc_id, n order by i) as g from c where regexp_matches(substr(line, i, 1), '[A-Za-zÀ-ÿ]'))
 select doc_id, n as line, min(i) as first, max(i) as last, string_agg(substr(line, i, 1), '' order by i) as word from l group by doc_id, n, g""")
def letter_islands(spark, sf_dir):
    """The runs of letters of every line; a line's letters are cut into runs within the row, so nothing is shuffled."""
    t = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return sequence.islands(t, "t", "A-Za-zÀ-ÿ").select("doc_id", (F.col("line") + 1).cast("long").alias("line"), "first", "last", "word")


@query("""with s as (select doc_id, string_split(text, chr(10)) as lines from documents), t as (select doc_id, unnest(range(1, len(lines) + 1)) as n, unnest(lines) as line from s)
 select doc_id, n as line, length(regexp_extract(line, '^[A-Za-zÀ-ÿ]*', 0)) as leading from t""")
def leading_runs(spark, sf_dir):
    """Length of the run of letters that opens each line, up to the first other character."""
    t = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return t.select("doc_id", (F.col("line") + 1).cast("long").alias("line"), F.length(F.regexp_extract("t", "^[A-Za-zÀ-ÿ]*", 0)).cast("long").alias("leading"))


@query("""with s as (select doc_id, regexp_extract_all(text, '[!-~]{12,}') as runs, text from documents), b as (select doc_id, sum(len(runs)) as n, max(list_max(list_transform(runs, lambda r: length(r)))) as longest from s group by 1)
 select doc_id, n::bigint as n, coalesce(longest, 0)::bigint as longest from b""")
def long_runs(spark, sf_dir):
    """Runs of 12 visible ASCII characters or more in each text: how many, and the longest."""
    runs = sequence.binary_runs(F.col("text"), "!-~", 12)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(runs).cast("long").alias("n"), F.coalesce(F.array_max(F.transform(runs, lambda r: r["length"])), F.lit(0)).cast("long").alias("longest"))


@query("""with m as (select conv_id, min(length(text)) filter (where role = 'user') as a, median(length(text)) filter (where role = 'assistant') as b from conversations group by 1)
 select c.conv_id, turn, case when a is null or b is null then 'unknown' when length(text) > (a + b) / 2 then 'long' else 'short' end as kind from conversations c join m using (conv_id)""")
def line_calibration(spark, sf_dir):
    """The two classes' sizes are aggregated, exactly and without a group in one place; every turn then meets its conversation's numbers."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    small = conv.where("role = 'user'").groupBy("conv_id").agg(F.min("n").alias("a"))
    middle = quantiles.exact(conv.where("role = 'assistant'"), ["conv_id"], "n", {"b": 0.5})
    kind = F.when(F.col("a").isNull() | F.col("b").isNull(), "unknown").when(F.col("n") > (F.col("a") + F.col("b")) / 2, "long").otherwise("short")
    return conv.join(small, "conv_id", "left").join(middle, "conv_id", "left").select("conv_id", "turn", kind.alias("kind"))


@query("select conv_id, arg_max(role, struct_pack(a := turn, b := text)) as last, arg_min(role, struct_pack(a := turn, b := text)) as first, count(*) as n from conversations group by 1")
def first_last_per_group(spark, sf_dir):
    key = F.struct("turn", "text")
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max_by("role", key).alias("last"), F.min_by("role", key).alias("first"), F.count("*").alias("n"))


@query("""select user_id, event_type, min(ts) as first, max(ts) as last, count(*) as n from
 (select *, sum(new) over (partition by user_id, event_type order by ts, event_id rows unbounded preceding) as s from
  (select *, case when lag(ts) over (partition by user_id, event_type order by ts, event_id) is null or ts - lag(ts) over (partition by user_id, event_type order by ts, event_id) >= interval 6 hours then 1 else 0 end as new from events))
 group by user_id, event_type, s""")
def event_sessions(spark, sf_dir):
    w = F.session_window(F.col("ts").cast("timestamp"), "6 hours")
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type", w.alias("w")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n")).drop("w")


@query("select n_regionkey, count(*) as n, min(n_name) as head from nation group by rollup (n_regionkey)")
def rollup_counts(spark, sf_dir):
    return table(spark, sf_dir, "nation").rollup("n_regionkey").agg(F.count("*").alias("n"), F.min("n_name").alias("head"))
