import hashlib
import random
import re
import sys, os; sys.path.insert(0, os.path.dirname(__file__))  # noqa: E401,E702
import zlib

import pytest

from glossweave.llm import turns
from glossweave.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, seen int, chunk string"
OUT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def broken(rows):
    """Rows (turn, role, text) of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(turn, role, text)] * (2 if k == 3 else 1)
    return out


def plain(conv, rows):
    """The contract by uniform-cost search over (row, place in the pattern), letters of all cheapest ways compared."""
    rows, seen, faults = broken(rows), [], []
    for _, role, text in rows:
        ink = re.findall("[^\x20\x09-\x0d]", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.append((role, text))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # Places: 0 nothing yet, 1 after s, 2 after u, 3 after a; best[i][q] = (cost, letters, lines) of the rest.
    n = len(rows)
    best = [[None] * 4 for _ in range(n + 1)]
    for i in range(n, -1, -1):
        todo = [[] for _ in range(4)]
        for q in range(4):
            if i == n and q in (0, 3):
                todo[q].append((0, "", ()))
            if i < n:
                _, role, text = rows[i]
                c, w, ls = best[i + 1][q]
                todo[q].append((c + 3, "D" + w, ls))
                if faults[i] not in ("blank", "duplicate"):
                    more = faults[i] == "truncated"
                    for to, ok in ((1, q == 0 and role[:1] == "s"), (2, q in (0, 1, 3) and role[:1] == "u"), (3, q == 2 and role[:1] == "a")):
                        if ok:
                            c, w, ls = best[i + 1][to]
                            todo[q].append((c + more, "K" + w, (f"{role}:{text}", *ls)))
                    to, name = (3, "assistant") if q == 2 else (2, "user")
                    c, w, ls = best[i + 1][to]
                    todo[q].append((c + 2 + more, "R" + w, (f"{name}:{text}", *ls)))
        now = [min(t, key=lambda x: x[:2]) if t else None for t in todo]
        for _ in range(4):
            for q in range(4):
                to, name = (3, "assistant:") if q == 2 else (2, "user:")
                if now[to]:
                    c, w, ls = now[to]
                    new = (c + 2, "I" + w, (name, *ls))
                    if now[q] is None or new[:2] < now[q][:2]:
                        now[q] = new
        best[i] = now
    cost, audit, kept = best[0][0]
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def expected(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    return sorted((plain(c, rs) for c, rs in convs.items()), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


def made_up(n, longest, seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(n), None]:
        for t in range(rnd.randint(0, longest)):
            if rnd.random() < 0.1:
                continue
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ustad"])
            text = rnd.choice(["Yes.", "No!", "", " \n", None, "so on", "a. b", f"text {t}.", "Why?", "é…"])
            rows.append((c, None if rnd.random() < 0.03 and not any(r[0] == c and r[1] is None for r in rows) else t, role, text, 1, "x"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows,longest,chunk", [(300, 12, 4096), (40, 60, 5), (6, 400, 7)])
def test_equals_brute_force(spark, rows, longest, chunk):
    """Conversations whole inside a range, across ranges, and in chunks of a few rows."""
    data = made_up(rows, longest, rows)
    got = result(turns.repair(spark.createDataFrame(data, SCHEMA).repartition(3), chunk_rows=chunk))
    assert got == expected([r[:4] for r in data])


def test_given_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op12_conversation_repair"](spark, sf)) == expected(rows)


def test_empty_and_repeated_rows(spark):
    assert result(turns.repair(spark.createDataFrame([], SCHEMA))) == []
    data = [(1, 1, "user", "Yes.", 1, "x")] * 3 + [(2, None, None, None, 1, "x")] * 2
    assert result(turns.repair(spark.createDataFrame(data, SCHEMA))) == expected([r[:4] for r in data])


def test_long_text_and_one_hot_conversation(spark):
    data = [(7, i, "user" if i % 2 else "assistant", f"n{i} " + "word " * (200_000 if i == 5 else 1) + ".", 1, "x") for i in range(3000)]
    assert result(turns.repair(spark.createDataFrame(data, SCHEMA).repartition(4), chunk_rows=100)) == expected([r[:4] for r in data])


def test_few_states_and_brute_traces():
    """The automaton stays small however long the rows are."""
    rnd, auto = random.Random(1), turns.Automaton()
    for _ in range(300):
        auto.scan([rnd.randrange(9) for _ in range(200)])
    assert len(auto.vectors) < 60
