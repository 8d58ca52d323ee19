"""Text functions as Column builders: all run inside the JVM."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings, suffixes and word lists of the language.
ENDINGS = ("ar", "ir", "or", "o", "a", "e", "i")
SUFFIXES = (
    "ari", "atr", "ebl", "end", "eri", "esk", "estr", "ier", "ind", "ism", "ist", "oid", "ach", "ad", "aj", "al", "an", "ar", "ed", "eg", "em", "er",
    "es", "et", "ey", "id", "if", "ig", "ik", "il", "in", "iv", "iz", "oz", "ul", "um", "ur", "uy",
)
PREPOSITIONS = (
    "ad", "aden", "adsur", "an", "ante", "apud", "che", "cirkum", "da", "de", "di", "dum", "ek", "en", "exter", "inter", "kom", "kontre", "kun",
    "malgre", "per", "po", "por", "pos", "preter", "pri", "pro", "segun", "sen", "sub", "sur", "til", "tra", "trans", "ye", "vice",
)
PLACEHOLDERS = ("ulu", "ulo", "ula")
CONJUNCTIONS = ("e", "ed", "o", "od")
CODE_ORDER = "DEFIRSLPGN"
DIGIT_SUBSCRIPTS = ("0123456789", "₀₁₂₃₄₅₆₇₈₉")
BASE91 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_`{|}~"


def accents() -> tuple[str, str]:
    """Letters with marks and their bare letters, by canonical decomposition, through Latin Extended Additional."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if unicodedata.normalize("NFD", chr(c)) != chr(c)]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: Column) -> Column:
    """Without diacritics: marked letters become bare ones, loose combining marks go."""
    old, new = accents()
    return F.regexp_replace(F.translate(c, old, new), "[\\u0300-\\u036f]", "")


def slug(c: Column) -> Column:
    """Address form: lower case, no marks, blanks to hyphens, only a-z, 0-9 and hyphens, none doubled."""
    low = F.regexp_replace(fold(F.lower(c)), " ", "-")
    return F.regexp_replace(F.regexp_replace(low, "[^a-z0-9-]", ""), "-{2,}", "-")


def order_key(c: Column) -> Column:
    """Sort form: lower case, no marks, no leading signs, no trailing exclamation mark and hyphen, no blanks or quotes."""
    k = F.regexp_replace(fold(F.lower(c)), '^[*+"«.\\-]+', "")
    k = F.regexp_replace(F.regexp_replace(k, "!+$", ""), "-+$", "")
    return F.regexp_replace(k, "[\\s \"'«»]", "")


def strip_ending(c: Column, endings: tuple[str, ...] = ENDINGS, min_left: int = 0) -> Column:
    """Remove the first ending of the list that c has and that leaves at least min_left characters."""
    out = c
    for e in reversed(endings):
        out = F.when(c.endswith(e) & (F.length(c) - len(e) >= min_left), F.substring(c, F.lit(1), F.length(c) - len(e))).otherwise(out)
    return out


def root_key(c: Column) -> Column:
    return F.regexp_replace(order_key(c), f"({'|'.join(ENDINGS)})$", "")


def stem_key(c: Column, min_left: int = 5) -> Column:
    """Root key less one suffix, the longest that leaves min_left characters."""
    return strip_ending(root_key(c), tuple(sorted(SUFFIXES, key=len, reverse=True)), min_left)


def flat(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^0-9a-zà-ÿ]", "")


def tokens(c: Column, pattern: str = "[A-Za-z0-9]{2,}") -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def tagify(c: Column) -> Column:
    """Tag form: blanks to hyphens, runs of double colons to one colon, no outer hyphens, ? if nothing is left."""
    t = F.regexp_replace(F.regexp_replace(c, "[\\s]+", "-"), "::+", ":")
    return F.coalesce(F.nullif(F.regexp_replace(t, "^-+|-+$", ""), F.lit("")), F.lit("?"))


def html_to_text(c: Column) -> Column:
    """Plain text of HTML: italics and bold as * and **, scripts, styles, comments and other tags dropped, blanks squeezed."""
    steps = [
        ("(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), ("(?s)<!--.*?-->", " "), ("</?i>", "*"), ("</?b>", "**"), ("<[^>]*>", " "),
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"), ("[ \\t\\n\\r]+", " "),
    ]
    return F.trim(reduce(lambda x, s: F.regexp_replace(x, *s), steps, c))


def esc_html(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def esc_latex(c: Column) -> Column:
    """Backslash first, as the others bring new ones."""
    out = F.replace(c, F.lit("\\"), F.lit("\\textbackslash "))
    for a, b in (("&", "\\&"), ("%", "\\%"), ("$", "\\$"), ("#", "\\#"), ("_", "\\_"), ("{", "\\{"), ("}", "\\}"), ("~", "\\textasciitilde "), ("^", "\\textasciicircum ")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def trim_end(c: Column) -> Column:
    """Without trailing punctuation, but an ellipsis or an abbreviated "e c." stays."""
    return F.when(c.endswith("...") | c.endswith("…") | c.endswith("e c."), c).otherwise(F.regexp_replace(c, "[ ,;:.]+$", ""))


def search_forms(c: Column) -> Column:
    """Forms a headword is found by: lower case, one leading * or + off, x(y) as x and xy."""
    low = F.regexp_replace(F.lower(c), "^[*+]", "")
    parts = [F.regexp_extract(low, "^([^()]*)\\(([^()]*)\\)(.*)$", i) for i in (1, 2, 3)]
    return F.when(low.rlike("^[^()]*\\([^()]*\\).*$"), F.array(F.concat(parts[0], parts[2]), F.concat(*parts))).otherwise(F.array(low))


def capital_start(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def lower_start(c: Column) -> Column:
    """Initial letter in lower case unless the word is short or the second letter is a capital too."""
    keep = (F.length(c) < 3) | c.rlike("^[A-Z][A-Z0-9]")
    return F.when(keep, c).otherwise(F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c))))


def subscript_digits(c: Column) -> Column:
    return F.translate(c, *DIGIT_SUBSCRIPTS)


# One ordered rule table; a second application changes nothing.
SPACING = (
    ("[ \\t]+", " "), (" +([,;:.!?)])", "$1"), ("([(]) +", "$1"), (",{2,}", ","), (";{2,}", ";"), ("\\.{4,}", "..."), ("([,;])([A-Za-z])", "$1 $2"),
    (" *— *", " — "), ("^ +| +$", ""),
)


def tidy(c: Column) -> Column:
    """Spaces and punctuation by the ordered rules of SPACING."""
    return reduce(lambda x, s: F.regexp_replace(x, *s), SPACING, c)


def balance(c: Column, left: str = "(", right: str = ")") -> Column:
    """Opening less closing brackets."""
    return (F.length(c) - F.length(F.replace(c, F.lit(left), F.lit("")))) - (F.length(c) - F.length(F.replace(c, F.lit(right), F.lit(""))))


def read_code(c: Column, letters: str) -> Column:
    """Language code in alphabet order, null if it isn't one: at most 12 characters, all of letters, none twice."""
    cs = F.split(c, "")
    ok = c.rlike(f"^[{re.escape(letters)}]{{1,12}}$") & (F.size(F.array_distinct(cs)) == F.size(cs))
    return F.when(ok, reorder(c, letters))


def reorder(c: Column, letters: str) -> Column:
    """The characters of c that are in letters, in the order of letters."""
    return F.array_join(F.filter(F.array(*(F.lit(x) for x in letters)), lambda x: F.instr(c, x) > 0), "")


def csum(c: Column) -> Column:
    """First eight hex digits of the SHA-1, as a number."""
    return F.conv(F.substring(F.sha1(c), 1, 8), 16, 10).cast("long")


def guid(c: Column) -> Column:
    """First eight bytes of the SHA-256 as an unsigned number, in base 91, most significant digit first."""
    n = F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(10)),
        F.struct(n.alias("left"), F.lit("").alias("out")),
        lambda a, _: F.when(a["left"] == 0, a).otherwise(
            F.struct(
                ((a["left"] - F.pmod(a["left"], F.lit(91).cast("decimal(20,0)"))) / 91).cast("decimal(20,0)").alias("left"),
                F.concat(F.substring(F.lit(BASE91), F.pmod(a["left"], F.lit(91).cast("decimal(20,0)")).cast("int") + 1, F.lit(1)), a["out"]).alias("out"),
            )
        ),
    )
    return steps["out"]


def context(c: Column, at: Column, width: int = 42) -> Column:
    """width characters on either side of a one-based position, with ellipses where text is cut."""
    start = F.greatest(at - width, F.lit(1))
    return F.concat(F.when(start > 1, "…").otherwise(""), F.substring(c, start, F.lit(2 * width)), F.when(start + 2 * width <= F.length(c), "…").otherwise(""))
