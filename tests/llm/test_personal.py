import hashlib
import random
import re
import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import time
from collections import defaultdict

import brute

from glossweave.llm import personal
from glossweave.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, spans int, key string"


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base(text):
    """The contract's patterns as they stand, failing matches dropped afterwards."""
    digits = lambda m: "".join(c for c in m[0] if c.isdigit())
    out = [("email", *m.span(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(p) < 4000 and int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return [f"{k}:{s}:{e}" for k, s, e, _ in sorted(out, key=lambda x: (x[1], x[3]))]


def plain(docs, least=0.5, support=3.0, rounds=3):
    """The whole method with strings in dictionaries: ctx spans by row."""
    words = re.compile("[^\x20\x09-\x0d\"'<>=,;()\\[\\]{}|.:!?]+")
    norm = lambda w: re.sub("[0-9]", "0", "".join(c.lower() if "A" <= c <= "Z" else c for c in w))
    occurs, mentions = defaultdict(int), []
    for row, (_, text) in enumerate(docs):
        text = text or ""
        all_words = [norm(w) for w in words.findall(text)]
        for i, w in enumerate(all_words):
            occurs[w,] += 1
            if i:
                occurs[all_words[i - 1], w] += 1
        spans = personal.base_spans(text)
        for seed, s, e in [(True, s, e) for _, s, e in spans] + [(False, s, e) for s, e in personal.others(text, spans)]:
            before = [norm(w) for w in words.findall(text, max(0, s - personal.REACH), s)[-2:]]
            own = personal.shape(text[s:e])
            pats = ([("shape", own)] if own else []) + ([(before[-1],)] if before else []) + ([tuple(before)] if len(before) == 2 else [])
            mentions.append((row, seed, s, e, text[s:e].lower(), [("shape:", *p) if p[0] == "shape" and len(p) == 2 and p[1] == own and i == 0 and own else p for i, p in enumerate(pats)]))
    edges, count = defaultdict(dict), defaultdict(int)
    for _, seed, _, _, x, pats in mentions:
        for p in pats:
            edges[p][x] = edges[p].get(x, False) or seed
            count[p] += 1
    edges = {p: xs for p, xs in edges.items() if len(xs) >= support}

    def run(edges, whole):
        likely, good = {}, {}
        for _ in range(rounds):
            good = {}
            for p, xs in edges.items():
                known = sum(1.0 if seed else likely.get(x, 0.0) for x, seed in xs.items())
                more = max(0, occurs[p] - count[p]) if whole and p[0] != "shape:" else 0
                if known >= support and known / (len(xs) + more + 1) >= least:
                    good[p] = known / (len(xs) + more + 1)
            likely = {}
            for p, worth in good.items():
                for x, seed in edges[p].items():
                    if not seed:
                        likely[x] = 1 - (1 - likely.get(x, 0.0)) * (1 - min(worth, 0.99))
        return good

    good = run(edges, False)
    good = run({p: edges[p] for p in good}, True)
    out = defaultdict(list)
    for row, seed, s, e, _, pats in mentions:
        if not seed and any(p in good for p in pats):
            out[row].append((s, e))
    final = {}
    for row, spans in out.items():
        end, final[row] = -1, []
        for s, e in sorted(set(spans), key=lambda x: (x[0], -x[1])):
            if s >= end:
                final[row].append(f"ctx:{s}:{e}")
                end = e
    return final


def made_up(seed=3):
    """Letters in which some words stand before personal data nearly always, and others before anything."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 5)))
    email = lambda: f"{word()}.{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com"
    phone = lambda: f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"
    docs = []
    for i in range(400):
        parts = [word() for _ in range(rnd.randint(5, 30))]
        kind = rnd.random()
        if kind < 0.3:
            parts.insert(rnd.randrange(len(parts)), f"Reach me: {rnd.choice([email, phone])()},")
        elif kind < 0.4:
            parts.insert(rnd.randrange(len(parts)), f"reach me at {rnd.choice(['jd', 'xx'])}_{rnd.randint(10000, 99999)}k")
        elif kind < 0.5:
            parts.insert(rnd.randrange(len(parts)), f"reach me: id{rnd.randint(100000, 999999)}")
        elif kind < 0.55:
            parts.insert(rnd.randrange(len(parts)), f"holder id{rnd.randint(100000, 999999)} and holder {email()}")
        elif kind < 0.7:
            parts.insert(rnd.randrange(len(parts)), f"built in {rnd.randint(1000, 2020)}-{rnd.randint(10, 99)}-17, order 1234{rnd.randint(100, 999)}")
        elif kind < 0.8:
            parts.insert(rnd.randrange(len(parts)), f"the {rnd.choice([email, phone])()} the")
        elif kind < 0.85:
            parts.insert(rnd.randrange(len(parts)), f"{phone()} 4524132264652876")
        docs.append((i, " ".join([*parts, "the", word()])))
    docs += [(1000, None), (1001, ""), (1002, "a@b.c@d.e @x.y 1.2.3.4.5.6 1.2.3.400 +1234567890123456 +1 234-567.890 4387 5130-3523 7269 é@ü"), (1003, "1" * 500_000), (1004, "a" * 300_000 + "@" + "b." * 1000)]
    docs += [docs[0], (None, docs[1][1]), docs[1]]
    return docs


def test_equals_brute_force(spark):
    docs = made_up()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA).repartition(3)
    found = plain(docs)
    want = []
    for row, (d, t) in enumerate(docs):
        b = base(t or "") if d not in (1003, 1004) else [f"{k}:{s}:{e}" for k, s, e in personal.base_spans(t)]
        spans = sorted(b + found.get(row, []), key=lambda x: (int(x.split(":")[1]), [*personal.BASE_KINDS, "ctx"].index(x.split(":")[0])))
        want.append((d, *(sum(x.startswith(k) for x in b) for k in personal.BASE_KINDS), hashlib.sha256(",".join(b).encode()).hexdigest(), ",".join(spans)))
    assert sorted((tuple(r) for r in personal.digest(personal.scan(df)).collect()), key=str) == sorted(want, key=str)
    # Unseen identifiers behind the words that vouch for them, of whatever form; none behind words that don't.
    texts = [t[int(x.split(":")[1]) : int(x.split(":")[2])] for row, xs in found.items() for x in xs for t in [docs[row][1]]]
    assert sum(bool(re.fullmatch(r"id\d{6}", t)) for t in texts) > 30 and any(t.startswith("+1 (") for t in texts)
    assert not any("-17" in t or t.startswith("1234") for t in texts)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op11_personal_data"](spark, sf).collect()}
    for d in docs:
        want, r = base(d.text or ""), rows[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k) for w in want) for k in personal.BASE_KINDS)
        assert [s for s in r.spans.split(",") if s and not s.startswith("ctx")] == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert personal.digest(personal.scan(none)).count() == 0 and personal.redact(none).count() == 0


def test_redaction(spark):
    docs = [(1, "Mail é.a@b.co or +1 234 567 8901."), (2, None), (None, "nothing")]
    rows = {r.doc_id: r.text for r in personal.redact(spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA)).collect()}
    assert rows == {1: "Mail é[PRIVATE] or [PRIVATE].", 2: None, None: "nothing"} or rows == {1: "Mail é.[PRIVATE] or [PRIVATE].", 2: None, None: "nothing"}


def test_linear_time_and_corners():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice("1 2.3-+()@ab.é%_9") for _ in range(rnd.randint(0, 40)))
        assert [f"{k}:{s}:{e}" for k, s, e in personal.base_spans(text)] == base(text), text
    for text in ("1" * 400_000, "a@" * 150_000, "1." * 150_000, "+1" * 150_000, "a" * 400_000, "x1," * 100_000, "+1 " * 100_000, "A1 " * 100_000):
        start = time.process_time()
        spans = personal.base_spans(text)
        personal.others(text, spans)
        assert time.process_time() - start < 8, text[:6]
