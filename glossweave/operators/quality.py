"""Named data-quality checks as predicates over a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import grammar


def first_of(*checks: tuple[str, Column]) -> Column:
    """The name of the first check that a record fails: at most one of them is reported."""
    out = F.when(checks[0][1], checks[0][0])
    for name, test in checks[1:]:
        out = out.when(test, name)
    return out


def families(df: DataFrame, checks: list) -> DataFrame:
    """A row (all columns of df, family) for each check a record fails; a check is (name, predicate) or a Column of names."""
    names = [F.when(c[1], c[0]) if isinstance(c, tuple) else c for c in checks]
    return df.withColumn("family", F.explode(F.filter(F.array(*names), lambda x: x.isNotNull())))


def reverse_gate(head: Column, body: Column, least: int = 25) -> Column:
    """affix, short, reveals itself, or kept: whether a record can be asked the other way round."""
    root = T.strip_ending(F.regexp_replace(F.lower(head), "[«»!()*+]", ""), min_left=3)
    return (
        F.when(head.startswith("-") | head.endswith("-"), "affix").when(F.length(body) < least, "short")
        .when((F.length(root) >= 3) & (F.instr(F.lower(body), root) > 0), "reveals itself").otherwise("kept")
    )


def record_checks(head: str, senses: str, code: str, quoted: str | None = None, backwards: str | None = None) -> list:
    """The eleven checks of a record, for families(): headword empty, of odd characters, or of no proper ending (affixes, quotations and words that their
    first sense calls grammatical are spared); no senses; one of a mark at a sense's head, an open hyphen, doubled blanks; a code that isn't
    one; a scientific name or a code left in the senses; the order broken, where backwards names a column that says so."""
    none = F.array().cast("array<string>")
    own, text = F.coalesce(F.col(senses), none), F.array_join(F.coalesce(F.col(senses), none), " ")
    bare = F.regexp_replace(head, r"^\*+", "")
    shaped = bare.rlike(r"^[A-Za-zÀ-ÿ'’-]+(\([a-z]\))?!?( [A-Za-zÀ-ÿ'’-]+){0,2}$")
    there = F.coalesce(F.col(head), F.lit("")) != ""
    cited = F.col(quoted) if quoted else F.lit(False)
    any_ = lambda p: F.exists(own, lambda s: s.rlike(p))
    parts = F.filter(F.split(F.coalesce(F.col(code), F.lit("")), ","), lambda x: F.trim(x) != "")
    bad = F.exists(parts, lambda x: grammar.read_code(F.regexp_replace(x, r"^[ .]+|[ .]+$", "")).isNull())
    checks = [
        ("headword empty", ~there), first_of(("headword characters", there & ~shaped), ("headword ending", there & ~grammar.proper_ending(bare, cited, own))), ("no senses", there & (F.size(own) == 0)),
        F.when(there, first_of(("mark at the head", any_(r"^[.,;:)\]]")), ("open hyphen", any_(r"\w- \w")), ("doubled blanks", any_(r"\s{2,}")))),
        ("no code", there & bad), ("scientific name in a sense", there & text.rlike(r"(?<![A-Za-z])L\.\s*[a-z]")), ("code in a sense", there & text.rlike(r"\b[DEFIRS]{3,7}\b\s*\.?\s*$")),
    ]
    return checks + ([("order broken", there & F.coalesce(F.col(backwards), F.lit(False)))] if backwards else [])
