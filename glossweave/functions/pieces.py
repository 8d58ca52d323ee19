"""Rules over the pieces of a text: each piece is decided by itself and its neighbours, in one pass.

A text is cut into words, numbers, blanks, runs of full stops, and other signs one by one. A rule is a condition on a piece and those about it, and what the
piece becomes; the first rule that holds is taken, and no rule leaves the piece as it is. Rules are written once and built either as
columns or as SQL text, so another engine can compute the same over whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = "A-Za-zÀ-ÿ"
BLANK = "\\x09-\\x0D\\x20"
PIECE = f"(?s)[{LETTER}]+|[0-9]+|[.]+|[{BLANK}]+|."
#: Letters and digits together, for what is typed with either.
RUN = f"(?s)[{LETTER}0-9]+|[{BLANK}]+|."
#: Empty pieces before and behind a text, as many as a rule may look away.
PAD = 4


def ranges(chars: str) -> list[tuple[int, int]]:
    """First and last codes of the ranges of a pattern's class."""
    return [(ord(a), ord(b or a)) for a, b in re.findall(r"(?s)(.)(?:-(.))?", re.sub(r"\\x(..)", lambda m: chr(int(m[1], 16)), chars))]


class Cells:
    """A piece and its neighbours as columns: 0 is the piece itself, -1 the one before."""

    def __init__(self, padded: Column, codes: Column, i: Column) -> None:
        self.padded, self.codes, self.i = padded, codes, i

    def __getitem__(self, k: int) -> Column:
        return F.element_at(self.padded, self.i + (PAD + k))

    def like(self, k: int, pattern: str) -> Column:
        return self[k].rlike(pattern)

    def begins(self, k: int, chars: str) -> Column:
        """Does the piece begin with one of the characters (of a pattern's class)? By its first code, which is computed once a piece."""
        code = F.element_at(self.codes, self.i + (PAD + k))
        return reduce(lambda a, b: a | b, (code == a if a == b else code.between(a, b) for a, b in ranges(chars)))

    def one_of(self, k: int, *values: str) -> Column:
        return self[k].isin(*values)

    @staticmethod
    def lit(x: str) -> Column:
        return F.lit(x)

    @staticmethod
    def join(*parts) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    def looked_up(self, k: int, table: dict[str, str]) -> Column:
        return F.try_element_at(F.create_map(*(F.lit(x) for kv in sorted(table.items()) for x in kv)), self[k])

    @staticmethod
    def translated(c: Column, a: str, b: str) -> Column:
        return F.translate(c, a, b)


class Text(str):
    """SQL text with the operators that conditions use."""

    def __and__(self, other: str) -> Text:
        return Text(f"({self} and {other})")

    def __or__(self, other: str) -> Text:
        return Text(f"({self} or {other})")

    def __invert__(self) -> Text:
        return Text(f"(not {self})")


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


class SqlCells:
    """The same as SQL text, p being the padded list and i the place."""

    def __getitem__(self, k: int) -> Text:
        return Text(f"p[i + {PAD + k}]")

    def like(self, k: int, pattern: str) -> Text:
        return Text(f"regexp_matches({self[k]}, {quoted(pattern)})")

    def begins(self, k: int, chars: str) -> Text:
        return self.like(k, f"^[{chars}]")

    def one_of(self, k: int, *values: str) -> Text:
        return Text(f"({self[k]} in ({', '.join(map(quoted, values))}))")

    @staticmethod
    def lit(x: str) -> Text:
        return Text(quoted(x))

    @staticmethod
    def join(*parts) -> Text:
        return Text("(" + " || ".join(p if isinstance(p, Text) else quoted(p) for p in parts) + ")")

    def looked_up(self, k: int, table: dict[str, str]) -> Text:
        return Text("(case " + self[k] + " " + " ".join(f"when {quoted(a)} then {quoted(b)}" for a, b in sorted(table.items())) + " end)")

    @staticmethod
    def translated(c: str, a: str, b: str) -> Text:
        return Text(f"translate({c}, {quoted(a)}, {quoted(b)})")


Rule = Callable[[object], tuple[object, object]]


class Rules:
    """Rules in order, over pieces cut by a pattern. word, capital, small, number, blank and edge are what rules ask of a piece."""

    def __init__(self, *rules: Rule, cut: str = PIECE) -> None:
        self.rules, self.cut = rules, cut

    def column(self, c: Column) -> Column:
        pad = F.array(*[F.lit("")] * PAD)

        def one(padded: Column) -> Column:
            return F.element_at(F.transform(F.array(F.transform(padded, F.ascii)), lambda codes: joined(padded, codes)), 1)

        def joined(padded: Column, codes: Column) -> Column:
            def piece(i: Column) -> Column:
                v = Cells(padded, codes, i)
                told = [r(v) for r in self.rules]
                out = reduce(lambda acc, t: acc.when(*t), told[1:], F.when(*told[0]))
                return out.otherwise(v[0])

            return F.array_join(F.transform(F.sequence(F.lit(1), F.size(padded) - 2 * PAD), piece), "")

        def whole(c: Column) -> Column:
            pieces = F.regexp_extract_all(c, F.lit(self.cut), F.lit(0))
            return F.when(c.isNull() | (c == ""), c).otherwise(F.element_at(F.transform(F.array(F.concat(pad, pieces, pad)), one), 1))

        # Text and pieces are bound to variables, or they would be computed anew wherever they are read.
        return F.element_at(F.transform(F.array(c), whole), 1)

    def sql(self, text: str) -> str:
        v, pad = SqlCells(), "[" + ", ".join(["''"] * PAD) + "]"
        cases = " ".join(f"when {a} then {b}" for a, b in (r(v) for r in self.rules))
        pieces = f"list_concat({pad}, regexp_extract_all({text}, {quoted(self.cut)}, 0), {pad})"
        return f"list_transform([{pieces}], lambda p: coalesce(array_to_string(list_transform(range(1, len(p) - {2 * PAD} + 1), lambda i: case {cases} else {v[0]} end), ''), ''))[1]"


def word(v, k: int):
    return v.begins(k, LETTER)


def capital(v, k: int):
    return v.begins(k, "A-ZÀ-Ý")


def small(v, k: int):
    return v.begins(k, "a-zà-ÿ")


def number(v, k: int):
    return v.begins(k, "0-9")


def blank(v, k: int):
    return v.begins(k, BLANK)


def edge(v, k: int):
    """A blank, or no piece at all."""
    return v.begins(k, BLANK) | v.one_of(k, "")


def is_(v, k: int, *values: str):
    return v.one_of(k, *values)


def steps(c: Column, *rules: Rules) -> Column:
    return reduce(lambda x, r: r.column(x), rules, c)


def sql_steps(text: str, rules: Sequence[Rules]) -> str:
    return reduce(lambda x, r: r.sql(x), rules, text)
