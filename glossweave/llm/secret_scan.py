"""Secret scan by assignment-aware lexing.

A pass of one compiled lexer over each whole text yields name-literal pairs of source and configuration syntax
(`name = "x"`, `name: x`, `"name": "x"`, `export NAME=x`, `<name>x</name>`, `--name x`, `name = "x" + "y"`). Constants are propagated: a name
that is assigned another name, or a quoted template that holds one (`{name}`, `${name}`), has that name's literals too: those of the last pair
before, else of the first after; `a.b.name` is `name` where it isn't known itself. Names lead on over as many steps as there are.
A literal is a secret if its target name is sensitive and the value looks like a key, not like a word.

Three base patterns are always reported; the lexer only adds spans.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_limits, narrow, thrifty

# Fixed patterns of the base scan.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: a run holds no longer match than its first
HEX = r"[0-9a-f]{24,}"  # likewise
BASE_KINDS = ("assign", "access", "hex")

#: Parts of names that mark their value as secret, and parts that show it is about something else.
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "accesskey", "privatekey", "signingkey", "encryptionkey", "credential", "clientsecret", "authkey", "bearer", "connectionstring")
HARMLESS = ("tokenizer", "tokenize", "tokens", "maxtoken", "passwordless", "secretary", "publickey", "hint", "policy", "length", "count", "field", "label", "placeholder", "example")

#: Tokens of source and configuration: key blocks, strings of every kind of quote, words, line ends with what indents the next line, signs.
TOKENS = r"""
(?P<pem>-----BEGIN\ [A-Z ]*PRIVATE\ KEY-----[A-Za-z0-9+/=\s\\]+-----END\ [A-Z ]*PRIVATE\ KEY-----)
|(?P<end>\n[\x20\t]*+)
|(?:(?<!\w)[fFrRbBuU]{1,2}(?=["']))?(?:\"\"\"(?P<tdq>(?:[^"\\]++|\\.|"(?!\"\"))*+)\"\"\"|\'\'\'(?P<tsq>(?:[^'\\]++|\\.|'(?!\'\'))*+)\'\'\'|"(?P<dq>(?:[^"\\\n]++|\\.)*+)"|(?<![A-Za-z0-9_]')(?<![A-Za-z0-9_](?='))'(?P<sq>(?:[^'\\\n]++|\\.)*+)'|`(?P<bq>[^`\n]*+)`)
|(?P<word>[A-Za-z_$][\w$.-]*+|[0-9][\w.]*+)
|(?P<sign>:=|=>|==|!=|<=|>=|::|->|--(?=[A-Za-z])|</|/>|[^\w\s])
"""
QUOTED, BARE = ("dq", "sq", "bq"), ("bare", "fbare")
VALUE = re.compile(r"[A-Za-z0-9_$+/.~-][A-Za-z0-9_$+/.~=-]*+", re.ASCII)
#: Of a name that isn't sensitive, a value ends before an equals sign inside, as what stands there may be a name itself.
MILD_VALUE = re.compile(r"[A-Za-z0-9_$+/.~-]++", re.ASCII)
FLAG_VALUE = re.compile(r"[A-Za-z0-9_$+/.~][A-Za-z0-9_$+/.~=-]*+", re.ASCII)
NAME = re.compile(r"[A-Za-z_$][\w$.-]*+", re.ASCII)
TAG = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\s]{6,}+)</([A-Za-z_][\w.-]*+)>", re.ASCII)
PLACE = re.compile(r"\$?\{\s*([A-Za-z_$][\w$.]*)\s*\}", re.ASCII)
ASSIGNS, OPENS, CLOSES = (":=", "=>", ":", "="), "([{", ")]}"
#: What a declared type may hold between a name's colon and its equals sign.
TYPED = set("&*<>[]?|.,") | {"::"}
#: Attributes of a tag that name a setting, and those that hold its value.
NAMING, HOLDING = ("name", "key", "id", "property"), ("value", "content")


def lexer() -> re.Pattern:
    return re.compile(TOKENS, re.VERBOSE | re.ASCII)


@lru_cache(1 << 14)
def sensitive(name: str) -> float:
    """1 for the name of a secret, 0 for any other."""
    plain = re.sub(r"[^a-z0-9]", "", name.lower())
    if any(h in plain for h in HARMLESS):
        return 0.0
    return 1.0 if any(s in plain for s in SENSITIVE) else 0.0


def literal_score(text: str) -> float:
    """How much a literal looks like a key: entropy a character, kinds of characters, length; 0 for placeholders."""
    if len(text) < 6 or re.fullmatch(r"(.)\1*|x+|\*+|\.+|<.*>|\$\{.*\}|%.*%|\{\{.*\}\}", text):
        return 0.0
    counts: dict[str, int] = {}
    for c in text:
        counts[c] = counts.get(c, 0) + 1
    bits = -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values())
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    return bits / 4 * (0.4 + 0.2 * kinds) * min(1.0, len(text) / 12)


#: Stands for the backslash of an escaped sign.
HOLE = "\0"
#: The sensitive parts that hold no other of them.
STEMS = tuple(w for w in SENSITIVE if not any(v != w and v in w for v in SENSITIVE))


def may_name(text: str) -> bool:
    """False if no name in a text can be sensitive: names are letters, digits and the signs _ $ . -, and are compared without signs."""
    plain = text.lower()
    for sign in "_$.-":
        plain = plain.replace(sign, "")
    return any(w in plain for w in STEMS)


class Token:
    __slots__ = ("kind", "start", "end", "text", "right")

    def __init__(self, kind: str, start: int, end: int, text: str, right: int) -> None:
        self.kind, self.start, self.end, self.text, self.right = kind, start, end, text, right


def tokens_of(text: str, pattern: re.Pattern) -> list[Token]:
    """Tokens in order; of a string start and end leave out its quotes, which right takes in."""
    out = []
    for m in pattern.finditer(text):
        kind = m.lastgroup
        s, e = m.span(kind)
        if e > s and text[e - 1] == HOLE:  # of the escaped quote that ends the string
            e -= 1
        out.append(Token({"tdq": "dq", "tsq": "sq"}.get(kind, kind), s, e, text[s:e], m.end()))
    return out


def unescaped(text: str) -> str:
    """A string's text as it reads inside: escaped quotes and line ends as such, each of the same length as before, so that places stay."""
    return re.sub(r"\\(.)", lambda m: " \n" if m[1] == "n" else "  " if m[1] in "rt" else HOLE + m[1], text, flags=re.DOTALL)


def pairs_of(text: str, pattern: re.Pattern, base: int = 0):
    """The pairs of a text: (name, kind, parts), parts being (kind, start, end, text) of the literals and names that make the value. Strings are read inside, too.

    One pass over the tokens. A name and an assignment sign mark where its value begins; a bracket that opens there belongs to the name, as does one of a
    call that is the value or that bears the name, and so do all strings inside that are no names themselves.
    """
    toks = tokens_of(text, pattern)
    n = len(toks)
    owner: dict[int, str] = {}  # token where a name's value begins
    opened: dict[int, str] = {}  # bracket that belongs to a name
    stack: list[str | None] = []
    used: set[int] = set()
    line_indent = line_first = 0

    def is_name(i: int) -> str | None:
        t = toks[i]
        return t.text if t.kind == "word" and NAME.fullmatch(t.text) or t.kind in QUOTED and NAME.fullmatch(t.text) else None

    def sign(i: int, *which: str) -> bool:
        return i < n and toks[i].kind == "sign" and toks[i].text in which

    def value_at(j: int, indent: int, colon: bool) -> int | None:
        """Where the value behind an assignment sign begins; of a declaration with a type, behind the equals sign."""
        if colon:
            k, depth = j, 0
            while k < n and k < j + 16 and (toks[k].kind == "word" or toks[k].kind == "sign" and toks[k].text in TYPED):
                depth += (toks[k].text in "<[") - (toks[k].text in ">]") if toks[k].kind == "sign" else 0
                if toks[k].text == "," and depth <= 0:
                    break
                k += 1
            if k > j and sign(k, "=") and not sensitive(toks[k - 1].text):
                return k + 1
        return j if j < n else None

    def value_of_kind(name: str) -> re.Pattern:
        return VALUE if sensitive(name) else MILD_VALUE

    def part(i: int) -> tuple[str, int, int, str]:
        t = toks[i]
        return t.kind, base + t.start, base + t.end, t.text

    def joined(i: int, parts: list) -> list:
        """What goes on with a value behind token i: strings next to strings, or joined by a sign."""
        string = True
        while True:
            k = i + 1
            while k < n and toks[k].kind == "end":
                k += 1
            if sign(k, "+", ".", "\\"):
                k += 1
                while k < n and toks[k].kind == "end":
                    k += 1
                if k < n and toks[k].kind in QUOTED:
                    parts.append(part(k))
                elif k < n and toks[k].kind == "word" and not toks[i + 1].text == "\\" and NAME.fullmatch(toks[k].text):
                    parts.append(("bare", base + toks[k].start, base + toks[k].end, toks[k].text))
                else:
                    return parts
            elif string and k == i + 1 and k < n and toks[k].kind in QUOTED and toks[i].kind in QUOTED and not sign(k + 1, ":", "=>"):
                parts.append(part(k))
            else:
                return parts
            used.add(k)
            i = k

    i = 0
    while i < n:
        t = toks[i]
        if t.kind == "pem":
            yield "", "pem", [part(i)]
        elif t.kind == "end":
            line_indent, line_first = t.end - t.start - 1, i + 1
        elif t.kind == "sign" and t.text in OPENS:
            stack.append(None if t.text == "{" else opened.get(i, owner.get(i, stack[-1] if stack else None)))
        elif t.kind == "sign" and t.text in CLOSES:
            if stack:
                stack.pop()
        elif t.kind == "sign" and t.text == "<" and (m := TAG.match(text, t.start)) and m[1] == m[3]:
            yield m[1], "inner", [("inner", base + m.start(2), base + m.end(2), m[2])]
        elif t.kind == "sign" and t.text == "<" and i + 1 < n and toks[i + 1].kind == "word":
            # A tag that names a setting in one attribute and holds it in another.
            k, named, held = i + 2, None, None
            while k < n and k < i + 64 and not sign(k, ">", "/>", "<"):
                if toks[k].kind == "word" and sign(k + 1, "=") and k + 2 < n and toks[k + 2].kind in QUOTED:
                    if toks[k].text.lower() in NAMING:
                        named = toks[k + 2].text
                    elif toks[k].text.lower() in HOLDING:
                        held = k + 2
                k += 1
            if named and held:
                yield named, toks[held].kind, [part(held)]
        elif t.kind == "sign" and t.text == "--" and i + 1 < n and toks[i + 1].kind == "word" and (not t.start or not re.match(r"[\w-]", text[t.start - 1], re.ASCII)):
            w = toks[i + 1]
            k = i + 3 if sign(i + 2, "=") and toks[i + 2].start == w.end else i + 2
            if k < n and (toks[k].start > w.end or k == i + 3):
                if toks[k].kind in QUOTED:
                    yield w.text, f"f{toks[k].kind}", [part(k)]
                    used.add(k)
                elif toks[k].kind != "end" and (m := FLAG_VALUE.match(text, toks[k].start)):
                    yield w.text, "fbare", [("fbare", base + m.start(), base + m.end(), m[0])]
        if t.kind in ("word", *QUOTED):
            name = is_name(i)
            mine = owner.get(i)
            k = i + 1
            if sign(k, "]"):
                k += 1
            if name and sign(k, *ASSIGNS) and not sign(k + 1, "=", ":"):
                j = value_at(k + 1, line_indent, toks[k].text == ":")
                if j is not None:
                    if sign(j, "|", ">") and toks[k].text == ":":
                        # A block of deeper lines.
                        e = j + 1
                        while e < n and toks[e].kind != "end":
                            e += 1
                        block = []
                        at = toks[e].start if e < n else len(text)
                        for m in re.compile(r"\n([\x20\t]*)([^\n]*)").finditer(text, at):
                            if m.start() != at or m[2].strip() and len(m[1]) <= line_indent:
                                break
                            at = m.end()
                            if m[2].strip():
                                s = m.start(2)
                                block.append(("inner", base + s, base + s + len(m[2].rstrip()), m[2].rstrip()))
                        if block:
                            yield name, "inner", block
                    elif toks[j].kind == "end":
                        deep = toks[j].end - toks[j].start - 1
                        if toks[k].text == ":" and (deep > line_indent or deep == line_indent and not sign(line_first, "-")) and sign(j + 1, "-"):
                            # A list, one item a line.
                            e = j
                            while e < n and toks[e].kind == "end" and toks[e].end - toks[e].start - 1 == deep and sign(e + 1, "-"):
                                if e + 2 < n:
                                    owner.setdefault(e + 2, name)
                                e += 2
                                while e < n and toks[e].kind != "end":
                                    e += 1
                        elif toks[k].text != ":" and j + 1 < n and toks[j + 1].kind in QUOTED:
                            owner.setdefault(j + 1, name)
                    else:
                        owner.setdefault(j, name)
                # A string that is a name has been used as such.
                used.add(i)
            if mine is not None:
                if t.kind in QUOTED and i not in used:
                    used.add(i)
                    yield mine, t.kind, joined(i, [part(i)])
                elif t.kind == "word":
                    k = i
                    while k + 1 < n and toks[k + 1].kind == "word" and toks[k].text in ("new", "await", "const"):
                        k += 1
                    if sign(k + 1, "(") and toks[k + 1].start == toks[k].end:
                        opened[k + 1] = mine
                    elif sign(k + 1, "!") and sign(k + 2, "(", "["):
                        opened[k + 2] = mine
                    elif m := value_of_kind(mine).match(text, t.start):
                        whole = i
                        while whole + 1 < n and toks[whole + 1].right <= m.end():
                            whole += 1
                        yield mine, "bare", joined(whole, [("bare", base + m.start(), base + m.end(), m[0])])
                        if sensitive(mine):
                            i = whole
            elif t.kind in QUOTED and i not in used and stack and stack[-1] is not None and not sign(i + 1, ":", "=>", "="):
                used.add(i)
                yield stack[-1], t.kind, joined(i, [part(i)])
            if t.kind == "word" and mine is None and sign(i + 1, "(") and toks[i + 1].start == t.end and sensitive(t.text):
                opened.setdefault(i + 1, t.text)
        elif t.kind == "sign" and i in owner and t.text not in OPENS:
            if m := value_of_kind(owner[i]).match(text, t.start):  # a value that begins with a sign, such as / or +
                yield owner[i], "bare", [("bare", base + m.start(), base + m.end(), m[0])]
                while sensitive(owner[i]) and i + 1 < n and toks[i + 1].right <= m.end():
                    owner[i + 1] = owner[i]
                    i += 1
            elif t.text in "&*@" and i + 1 < n:
                owner.setdefault(i + 1, owner[i])
        if t.kind in QUOTED and t.end - t.start > 6 and may_name(t.text):
            yield from pairs_of(unescaped(t.text), pattern, base + t.start)
        i += 1


def lex_spans(text: str, pattern: re.Pattern, threshold: float) -> list[tuple[int, int]]:
    """Spans of literals that are secrets by their target names, constants propagated."""
    if not may_name(text) and "-----BEGIN" not in text:
        return []
    found: set[tuple[int, int]] = set()
    every = list(pairs_of(text, pattern))
    places: dict[str, list[int]] = {}
    for i, (name, kind, _) in enumerate(every):
        if kind != "pem":
            places.setdefault(name, []).append(i)

    def bound(name: str, i: int) -> int | None:
        """The pair that gives a name its value where pair i reads it."""
        at = places.get(name) or places.get(name.rpartition(".")[2])
        if not at:
            return None
        k = bisect.bisect_left(at, i) - 1
        return at[k] if k >= 0 else next((j for j in at if j > i), None)

    ends: dict[int, int] = {}

    def last_of(i: int) -> int:
        """The pair at the end of a chain of names that are only other names; of a circle, some pair of it."""
        path = []
        while i not in ends:
            ends[i] = i
            path.append(i)
            kind, _, _, said = every[i][2][0]
            k = bound(said, i) if kind in BARE and len(every[i][2]) == 1 else None
            if k is None:
                break
            i = k
        end = ends[i]
        for j in path:
            ends[j] = end
        return end

    def value_of(i: int) -> tuple[str, list[tuple[int, int]]]:
        """What pair i's name stands for, and the literals that say so; a name that leads back to itself gives nothing more."""
        i = last_of(i)
        out, spans, todo, seen = [], [], [(i, p) for p in reversed(every[i][2])], {i}
        while todo:
            j, (kind, s, e, part) = todo.pop()
            if kind in BARE:
                k = bound(part, j)
                if k is not None:
                    k = last_of(k)
                    if k not in seen:
                        seen.add(k)
                        todo += [(k, p) for p in reversed(every[k][2])]
                    continue
                if len(every[j][2]) > 1 or not re.search(r"[0-9]", part):
                    continue  # an identifier or a word
            elif kind != "inner":
                names = [(k, m[1]) for m in PLACE.finditer(part) if (k := bound(m[1], j)) is not None]
                for k, _ in names:
                    k = last_of(k)
                    if k not in seen:
                        seen.add(k)
                        todo += [(k, p) for p in every[k][2]]
                if names:
                    part = PLACE.sub("", part)
                    if literal_score(part) < threshold:
                        continue
            out.append(part)
            spans.append((s, e))
        return "".join(out), spans

    for i, (name, kind, parts) in enumerate(every):
        if kind == "pem":
            found.add(parts[0][1:3])
        elif sensitive(name):
            value, spans = value_of(i)
            if literal_score(value) >= threshold:
                found.update(spans)
    # What lies inside a literal that is a secret itself is no other secret.
    out: list[tuple[int, int]] = []
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or e > out[-1][1]:
            out.append((s, e))
    return out


def base_spans(text: str, assign: re.Pattern, access: re.Pattern, hexes: re.Pattern) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span()) for m in access.finditer(text)] if "AKIA" in text else []
    return out + [("hex", *m.span()) for m in hexes.finditer(text)]


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.45) -> DataFrame:
    """Every secret of every whole text: (doc_id, text, spans array<struct<kind, start, end>>), one row for each row of docs.

    Offsets are code points, end exclusive; spans are sorted by start, then kind (assign, access, hex, lex). A null or empty text has
    no spans. Repeated rows each get a row; a null id stays null; other columns are not read.
    """
    arrow_limits(docs.sparkSession)

    def run(batches):
        assign, access, hexes, pattern = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS), re.compile(HEX), lexer()
        order = {k: i for i, k in enumerate((*BASE_KINDS, "lex"))}
        for b in batches:
            rows = []
            for text in b.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text, assign, access, hexes)
                spans += [("lex", s, e) for s, e in lex_spans(text, pattern, threshold)]
                rows.append([{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (x[1], order[x[0]], x[2]))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(rows, kind)], ["doc_id", "text", "spans"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string, spans array<struct<kind string, start long, end long>>")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of scan()'s spans."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for spans in b.column("spans").to_pylist():
                parts = [(x["kind"], f"{x['kind']}:{x['start']}:{x['end']}") for x in spans]
                for c, k in zip(cols, BASE_KINDS):
                    c.append(sum(p[0] == k for p in parts))
                cols[3].append(hashlib.sha256(",".join(s for k, s in parts if k != "lex").encode()).hexdigest())
                cols[4].append(",".join(s for _, s in parts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scanned.select("doc_id", "spans").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", mark: str = "[SECRET]", threshold: float = 0.45) -> DataFrame:
    """docs with every secret span replaced by mark and the character count renewed; a null text stays null, all other columns as they are."""
    arrow_limits(docs.sparkSession)
    names = docs.columns

    def run(batches):
        assign, access, hexes, pattern = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS), re.compile(HEX), lexer()
        for b in batches:
            texts, sizes = [], []
            for text in b.column(text_col):
                text = text.as_py()
                if text:
                    spans = [s[1:] for s in base_spans(text, assign, access, hexes)] + lex_spans(text, pattern, threshold)
                    merged: list[list[int]] = []
                    for s, e in sorted(spans):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    for s, e in reversed(merged):
                        text = text[:s] + mark + text[e:]
                texts.append(text)
                sizes.append(None if text is None else len(text))
            new = {text_col: pa.array(texts, pa.string()), chars_col: pa.array(sizes, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[n].cast(b.schema.field(n).type) if n in new else b.column(n) for n in names], names)

    return docs.mapInArrow(thrifty(run), docs.schema)
