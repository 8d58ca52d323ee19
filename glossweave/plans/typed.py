"""Repairs and grammar of typed text over whole tables: documents are spoiled by replacements that both engines make, then repaired."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import repairs as R
from ..functions.pieces import LETTER, Rules, quoted, sql_steps
from ..operators import grammar, quality
from ..operators import parentheticals as P
from ..sources import sinks
from .base import QUERIES, SQL, query, table


def spoil(*swaps: tuple[str, str], text: str = "text") -> str:
    """SQL text, the same for both engines: the replacements in turn."""
    for a, b in swaps:
        text = f"replace({text}, {quoted(a)}, {quoted(b)})"
    return text


def repaired(name: str, spoiled: str, change, sql: str | None = None, rules: tuple[Rules, ...] = ()) -> None:
    """Register a query: the digest of every document's text, spoiled and then repaired. Its SQL is given, or made of the rules."""

    def run(spark, sf_dir):
        docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(spoiled).alias("text"))
        fixed = docs.select("doc_id", change(F.col("text")).alias("fixed"), "text")
        return fixed.select("doc_id", F.md5("fixed").alias("digest"), (F.col("fixed") != F.col("text")).alias("changed"))

    run.__name__ = name
    QUERIES[name] = run
    sql = sql_steps("t", rules) if rules else sql
    if sql:
        SQL[name] = f"with s as (select *, {spoiled} as t from documents), f as (select doc_id, t, {sql} as fixed from s) select doc_id, md5(fixed) as digest, fixed <> t as changed from f"


COMPOUNDS = ("th-the", "en-le", "in-on", "de-la", "die-der")


def cut_end_sql(x: str) -> str:
    bare = f"regexp_replace({x}, '[\\s.\\-—–]+$', '')"
    return f"({bare} || regexp_extract(substr({x}, length({bare}) + 1), '[.]{{3,}}'))"


def counted(x: str, sign: str) -> str:
    return f"(length({x}) - length(replace({x}, '{sign}', '')))"


def depth_sql(x: str) -> str:
    signs = f"string_split(regexp_replace({x}, '[^()]', '', 'g'), '')"
    return f"list_reduce(list_prepend(0, list_transform({signs}, lambda c: case c when '(' then 1 when ')' then -1 else 0 end)), lambda d, y: greatest(0, d + y))"


def html_sql(x: str) -> str:
    return f"regexp_replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '(?i)(th)', '<mark>\\1</mark>', 'g')"


_BEFORE_LAST, _LAST_PART = "substr(t, 1, length(t) - 1)", "string_split(t, '(')[-1]"
_BEFORE_PART = f"substr(t, 1, length(t) - length({_LAST_PART}) - 1)"
_NAME, _AFTER = "substr(t, 2, strpos(t, '.') - 2)", "substr(t, strpos(t, '.') + 1)"
_FIRST = "regexp_replace(regexp_extract(t, '^\\S+'), '[.,)]+$', '')"
_PROPER = ", ".join(map(quoted, R.PROPER))

repaired("typed_digits", spoil(("1", "l"), ("0", "O"), (" the ", " 20o C 1500the "), (" de ", " : l. (l) ")), R.to_digits, rules=(R.DIGITS, R.UNITS))
repaired("typed_formulas", spoil((", ", " H2 O, "), (". ", " La C5 H4 N4. (CH3)2 ")), R.formulas)
repaired("orphan_brackets", "case when doc_id % 3 = 0 then text || ')' when doc_id % 3 = 1 then replace(text, ', ', ' (') || ' . )' else text end", R.orphan_bracket,
         f"case when right(t, 1) = ')' and {depth_sql(_BEFORE_LAST)} = 0 then {cut_end_sql(_BEFORE_LAST)} else t end")
repaired("closed_qualifiers", "case when doc_id % 2 = 0 then '(' || lang || '. ' else '(' || lang || '.' end || text", R.close_qualifier,
         f"case when left(t, 1) = '(' and regexp_matches({_NAME}, '^[{LETTER}]+$') and length({_NAME}) between 2 and 12 and regexp_matches({_AFTER}, '^[\\sA-ZÀ-Ý]') and {counted('t', '(')} > {counted('t', ')')}"
         f" then '(' || {_NAME} || '.)' || case when regexp_matches({_AFTER}, '^\\s') then '' else ' ' end || {_AFTER} else t end")
repaired("closed_brackets", "case when doc_id % 2 = 0 then replace(text, '. ', ' (') || '  ' else replace(replace(text, ', ', ' ('), '. ', ') ') end", R.close_bracket,
         f"case when contains(t, '(') and not contains({_LAST_PART}, ')') and {counted(_BEFORE_PART, '(')} = {counted(_BEFORE_PART, ')')} then rtrim(t) || ')' else t end")
repaired("balanced_brackets", spoil((", ", " ("), (". ", ") ")), R.balance_brackets)
repaired("doubled_marks", spoil((", ", " ,, "), (". ", " . . ")), R.tidy_punctuation, rules=(R.DOUBLED,))
repaired("spaced_marks", spoil((", ", ","), (". ", ").(e c ), *"), (" the ", "(th) ( the- ajo L.")), lambda c: R.SPACED.column(c), rules=(R.SPACED,))
repaired("set_dashes", spoil((", ", " - "), (". ", " -- "), (" the ", " -(the) ")), R.dashes, rules=R.DASHES)
repaired("stray_dashes", spoil((". ", ".- "), (", ", ",-"), (" the ", ". -The ")), R.stray_dashes, rules=(R.STRAY,))
repaired("ellipses", spoil((". ", "....")), R.ellipsis, rules=(R.DOTS,))
repaired("multiplication_signs", spoil((", ", " x 4 ")), R.multiplication, rules=(R.TIMES,))
repaired("hyphenated_compounds", spoil((" the ", " ththe "), (" en ", " enle "), (" die ", " dieder-")), lambda c: R.hyphenate(c, COMPOUNDS), rules=(R.welded(COMPOUNDS),))
repaired("pointed_metaphors", spoil((". ", " (anke metaf) "), (", ", " (Anke  metaf) ")), R.point_metaphor, rules=(R.METAPHOR,))
repaired("pointed_abbreviations", spoil((", ", ", bot, milit-"), (" the ", " Zool the.kem ")), R.point, rules=(R.POINTED,))
repaired("lower_initials", "case doc_id % 4 when 0 then text when 1 then 'Roma-' || text when 2 then 'Na ' || text else 'Élekto' || text end", R.lower_initial,
         f"case when not regexp_matches(t, '^[A-ZÀ-Ý]') or regexp_matches(regexp_replace({_FIRST}, '''+$', ''), '^[A-ZÀ-Ý]{{1,2}}$') or {_FIRST} in ({_PROPER}) or string_split({_FIRST}, '-')[1] in ({_PROPER})"
         f" or regexp_matches({_FIRST}, '[0-9₀-₉]') then t else lower(left(t, 1)) || substr(t, 2) end")
repaired("uniform_domains", spoil((". ", ",botaniko e Kem,"), (" the ", " the , trans.pri ")), R.uniform)
repaired("pointed_senses", spoil((". ", ". (Bot) "), (", ", " (,) (Muziko, zoolog) "), text="text || '. (Remarko Zoolog)'"), R.qualifiers)
_LEAD = "case when doc_id % 2 = 0 then '(' || source || ') ' else '(' || lang || ') ' end || text || ' <a & b>'"
_OPEN = "regexp_extract(t, '^[(][^()]*[)] *')"
_REST = f"substr(t, length({_OPEN}) + 1)"
repaired("highlighted_bodies", _LEAD, lambda c: R.body(c, "th"), f"case when regexp_matches({_OPEN}, '[0-9]') then {html_sql('t')} else '<i>' || {html_sql(f'trim({_OPEN})')} || '</i> ' || {html_sql(_REST)} end")
repaired("tex_italics", _LEAD, R.italics, f"case when regexp_matches({_OPEN}, '[0-9]') or regexp_matches({_REST}, '^[0-9]') then t else chr(92) || 'textit{{' || trim({_OPEN}) || '}} ' || regexp_replace({_REST}, '^\\s+', '') end")
_SUR = "chr(92) || 'sur{' || chr(92) || 'textasciicircum{}}{"
repaired("overstrikes", f"replace(replace(text, 'a', {_SUR}a}}'), 'th', {_SUR}th')", R.overstrikes, f"replace(t, {_SUR}a}}', 'â')")

#: Tokens made of a key's digest, of letters of codes and some that aren't, so that all tests of a code come up.
_TOKEN = "translate(substr(md5(cast(p_partkey as {0})), 1, cast(p_partkey % 7 + 1 as int)), '0123456789abcdef', 'DEFIRSLPGNdEFIRl')"
_NAMED = "case x " + " ".join(f"when '{k}' then '{v}'" for k, v in grammar.LANGUAGES.items()) + " end"


@query(f"""with c as (select p_partkey, {_TOKEN.format("varchar")} as token from part),
 l as (select *, length(regexp_replace(token, '[^A-Z]', '', 'g')) as tops, string_split(upper(replace(token, 'l', 'I')), '') as ls from c),
 n as (select *, list_transform(ls, lambda x: {_NAMED}) as names from l)
 select p_partkey, case when tops >= greatest(1, floor(length(token) * 0.6)) and len(list_filter(names, lambda x: x is null)) = 0 and len(list_distinct(names)) = len(names) then array_to_string(names, ',') end as languages from n""")
def language_codes(spark, sf_dir):
    """What the codes of languages stand for; null for what is none."""
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(grammar.read_code(F.expr(_TOKEN.format("string"))), ",").alias("languages"))


FIELDS = ("vedetto", "fako", "kodo", "lingui", "latina", "simbolo", "senci", "noti", "strukt", "drapeli")
#: Articles put together from a part's columns, in six shapes: w a word, s a sense, d a domain, n the shape.
_PARTS = "select p_partkey, p_partkey % 6 as n, split_part(p_name, ' ', 2) || 'o' as w, upper(left(p_name, 1)) || substr(p_name, 2) as s, lower(p_type) as d from part"
_TEXT = """case n when 0 then w || '. (' || d || ') ' || s || '. - DEFIRS.' when 1 then w || '. ' || s || ' - I. ' || s || ' una - II. Du ' || d || '. - EFIS'
 when 2 then w || '. (' || d || ') ' || s || '. L. ' || d || ' alba - DE' when 3 then w || '. ' || s || '. Simbolo kemiala : Pd. - ER' when 4 then w || '. ' || s || '. - Remarko longa pri ' || d || '. - FIS'
 else '"' || w || '". ' || s || '. - ' || s || ' : ' || d || ' klara' end"""


@query(f"""with p as ({_PARTS}) select p_partkey, w as vedetto, case when n in (0, 2) then d end as fako, case n when 0 then 'DEFIRS' when 1 then 'EFIS' when 2 then 'DE' when 3 then 'ER' when 4 then 'FIS' end as kodo,
 case n when 0 then 'Germana,Angla,Franca,Italiana,Rusa,Hispana' when 1 then 'Angla,Franca,Italiana,Hispana' when 2 then 'Germana,Angla' when 3 then 'Angla,Rusa' when 4 then 'Franca,Italiana,Hispana' end as lingui,
 case when n = 2 then d || ' alba' else '' end as latina, case when n = 3 then 'Pd' end as simbolo,
 case n when 1 then s || '|' || s || ' una|Du ' || d when 4 then s || '.' when 5 then s || '. – ' || s || ' : ' || d || ' klara' else s end as senci,
 case when n = 4 then 'Remarko longa pri ' || d else '' end as noti, case when n = 5 then '1 ' || s || ' = ' || d || ' klara' else '' end as strukt, case when n = 5 then 'sen-lingua' else '' end as drapeli from p""")
def article_grammar(spark, sf_dir):
    """Articles of every part read into their fields."""
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 6).alias("n"), F.expr("split_part(p_name, ' ', 2) || 'o'").alias("w"), F.expr("upper(left(p_name, 1)) || substr(p_name, 2)").alias("s"), F.lower("p_type").alias("d"))
    got = grammar.parse(parts.withColumn("article", F.expr(_TEXT)), "article")
    lists = {"lingui": ",", "latina": ",", "senci": "|", "noti": "|", "drapeli": ","}
    strukt = F.array_join(F.transform("strukt", lambda x: F.concat(x["sense"].cast("string"), F.lit(" "), x["label"], F.lit(" = "), x["text"])), "|").alias("strukt")
    return got.select("p_partkey", *(strukt if f == "strukt" else F.array_join(f, lists[f]).alias(f) if f in lists else F.col(f) for f in FIELDS))


@query("""with p as (select p_partkey, p_name, p_type from part)
 select p_partkey, 0 as sense, lower(p_type) as text from p union all select p_partkey, 1, p_name from p union all select p_partkey, 2, 'x' from p union all select p_partkey, 2, 'y' from p union all select p_partkey, 0, 'z' from p where p_partkey % 2 = 0""")
def exploded_parentheticals(spark, sf_dir):
    """The parentheticals of an article's head, senses and remarks, with the senses' numbers."""
    senses = F.array(F.concat(F.lit("Una ("), "p_name", F.lit(") fino")), F.lit("Du (x) e (y)"))
    notes = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("Noto (z)")))
    records = table(spark, sf_dir, "part").select("p_partkey", F.lower("p_type").alias("fako"), senses.alias("senci"), notes.alias("noti"))
    return grammar.parentheticals(records, "p_partkey")


@query("""with k as (select conv_id, turn % 3 as sense, arg_max(role, turn) as kind from conversations group by 1, 2) select conv_id, string_agg(sense || ':' || kind, ',' order by sense) as kinds from k group by 1""")
def sense_kind_maps(spark, sf_dir):
    """A map of sense to kind for each conversation, the last turn of a sense winning."""
    found = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") % 3).cast("int").alias("sense"), F.col("role").alias("kind"), F.col("turn").alias("seq"))
    maps = grammar.kinds_by_sense(found, "conv_id")
    pairs = F.transform(F.map_entries("kinds"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"]))
    return maps.select("conv_id", F.array_join(F.array_sort(pairs), ",").alias("kinds"))


@query("select page_id from pages where page_id >= 8 and page_id not in (select page_id from pages where page_id % 10 = 3)")
def body_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id")
    return grammar.front_matter(pages, pages.where("page_id % 10 = 3"), "page_id")


@query("""with f as (select lower(p_type) as key, list_sort(list_distinct(list(p_name))) as items, count(distinct p_name) as n from part group by 1)
 select case when n >= 12 then 0 else 1 end as part, key, '**' || key || '** (' || n || ') — ' || array_to_string(items, ', ') as line, row_number() over (order by case when n >= 12 then 0 else 1 end, case when n >= 12 then -n else 0 end, key) as place from f""")
def field_table(spark, sf_dir):
    """Lines of a table of fields: large ones by number, the rest by name."""
    index = P.inverted(table(spark, sf_dir, "part"), F.lower("p_type"), F.col("p_name"))
    lines = sinks.field_lines(index, 12)
    place = F.row_number().over(Window.orderBy("part", "place"))  # one row a field
    return lines.select("part", F.col("place.key").alias("key"), "line", place.cast("long").alias("place"))


@query("""with s as (select p_partkey, p_name, 'p. ' || p_size || ', l. ' || p_partkey as place, p_partkey % 2 = 0 as two, p_partkey % 3 = 0 as cited from part)
 select p_partkey, '## ' || case when cited then '« ' || p_name || ' »' else p_name end || ' *(fako.)*' || chr(10) || case when two then '1. una' || chr(10) || '2. du' else 'una' end || chr(10) || '— noto' ||
  case when two then chr(10) || 'L. a b; c' else '' end || case when cited then chr(10) || '*Simb. kem.* **Pd**' else '' end || chr(10) || '<!-- ' || place || ' -->' as md from s""")
def book_entries(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    two, cited = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 3 == 0
    senses = F.when(two, F.array(F.lit("una"), F.lit("du"))).otherwise(F.array(F.lit("una")))
    latin = F.when(two, F.array(F.lit("a b"), F.lit("c")))
    where = F.concat(F.lit("p. "), F.col("p_size").cast("string"), F.lit(", l. "), F.col("p_partkey").cast("string"))
    return part.select("p_partkey", sinks.entry(F.col("p_name"), F.lit("fako."), senses, F.array(F.lit("noto")), latin, F.when(cited, "Pd"), where, cited).alias("md"))


@query("""with s as (select replace(p_name, ' ', '-') as slug, p_name, p_partkey from part) select slug, '- [' || slug || '](' || slug || '.md) — ' || string_agg(p_name, ', ' order by p_partkey) as line, count(*) as n from s group by 1""")
def address_lines(spark, sf_dir):
    return sinks.address_index(table(spark, sf_dir, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")


CHECKED = {
    ("", "texto", "DEF"): ("headword empty",), ("ab1o", "texto", "DEF"): ("headword characters",), ("abak", "texto", "DEF"): ("headword ending",), ("an", "Prepoziciono qua", "DE"): (),
    ("abako", None, "DEF"): ("no senses",), ("abako", ", texto", "DEF"): ("mark at the head",), ("abako", "mi- texto", "DEF"): ("open hyphen",), ("abako", "du  blanki", "DEF"): ("doubled blanks",),
    ("abako", "texto", "gamo"): ("no code",), ("abako", "esas L. acarus", "DEF"): ("scientific name in a sense",), ("abako", "texto DEFIRS.", "DEF"): ("code in a sense",), ("*abako", "texto", "DEFlS, FNed"): (),
    ("-ey", "texto", None): (), ("a(d)", "texto", "DE"): ("headword ending",),
}
_FAMILIES = " union all ".join(f"select p_partkey, {quoted(f)} as family from part where p_partkey % {len(CHECKED)} = {i}" for i, v in enumerate(CHECKED.values()) for f in v)


@query(_FAMILIES + " union all select p_partkey, 'order broken' from part where p_partkey % 5 = 0 and p_partkey % 14 <> 0")
def record_families(spark, sf_dir):
    """The eleven checks over records of every kind."""
    keys = list(CHECKED)
    every = F.array(*(F.struct(*(F.lit(x).cast("string").alias(n) for x, n in zip(k, ("head", "sense", "code")))) for k in keys))
    d = table(spark, sf_dir, "part").select("p_partkey", F.element_at(every, (F.col("p_partkey") % len(keys) + 1).cast("int")).alias("r"), (F.col("p_partkey") % 5 == 0).alias("back"))
    d = d.select("p_partkey", "r.head", "r.code", F.when(F.col("r.sense").isNotNull(), F.array("r.sense")).alias("senses"), "back")
    return quality.families(d, quality.record_checks("head", "senses", "code", backwards="back")).select("p_partkey", "family")
