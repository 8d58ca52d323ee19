"""Plain versions of the operators, for small fixtures."""

import hashlib
import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def repeats(docs, n):
    """Units removed from each of docs [(doc_id, units)]: those in a run of n that also starts under a smaller id."""
    first = {}
    for d, u in docs:
        for i in range(len(u) - n + 1):
            w = u[i : i + n]
            if d is not None and d < first.get(w, float("inf")):
                first[w] = d
    out = []
    for d, u in docs:
        gone = [False] * len(u)
        for i in range(len(u) - n + 1):
            if first.get(u[i : i + n], float("inf")) < (float("inf") if d is None else d):
                gone[i : i + n] = [True] * n
        out.append(gone)
    return out


def op2(docs, n=50):
    rows = []
    units = [(d, (t or "").encode()) for d, t in docs]
    for (d, u), gone in zip(units, repeats(units, n)):
        kept = bytes(b for b, g in zip(u, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        rows.append((d, len(u), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def op7(docs, n=13):
    rows = []
    units = [(d, tuple(WORD.findall(t or ""))) for d, t in docs]
    for (d, u), gone in zip(units, repeats(units, n)):
        kept = " ".join(w for w, g in zip(u, gone) if not g)
        rows.append((d, len(u), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(rows, key=str)


def corpus(n=120, seed=3):
    """Texts with exact and near copies, shared passages, repeated lines, nulls, empty and very long ones."""
    rnd = random.Random(seed)
    lex = ["".join(rnd.choice("abcdeéñü") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    say = lambda k: " ".join(rnd.choice(lex) for _ in range(k))
    shared = [say(rnd.randint(10, 40)) for _ in range(6)]
    texts = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.15 and texts:
            texts.append(rnd.choice(texts))
        elif kind < 0.4 and any(texts):
            ws = (rnd.choice([t for t in texts if t])).split(" ")
            for _ in range(rnd.randint(1, 4)):
                ws[rnd.randrange(len(ws))] = rnd.choice(lex)
            texts.append(" ".join(ws))
        elif kind < 0.6:
            texts.append(f"{say(rnd.randint(0, 40))} {rnd.choice(shared)}\n{say(rnd.randint(0, 40))} {rnd.choice(shared)}")
        elif kind < 0.65:
            texts.append("\n".join([say(8)] * rnd.randint(2, 30)))
        else:
            texts.append(say(rnd.randint(1, 120)))
    texts += [None, "", " ", "a" * 700, "a" * 333, say(6000), "é" * 80]
    docs = list(enumerate(texts))
    rnd.shuffle(docs)
    return docs + [docs[0], (None, texts[0]), (None, texts[1])]


def op6(docs, k=4, radius=4):
    import xxhash

    marks = []
    for d, t in docs:
        ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sh = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else [" ".join(ws)] if ws else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        marks.append(sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs)))
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, f"{m:016x}", least.get(root(i))) for i, ((d, _), m) in enumerate(zip(docs, marks))), key=str)


def similar(docs, k=5, least=0.8):
    """Component of each of docs [(doc_id, text)] under links of shingle sets with at least that Jaccard similarity; and the linked pairs."""
    sets = []
    for d, t in docs:
        ws = WORD.findall((t or "").lower())
        sets.append({" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else {" ".join(ws)})
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    pairs = []
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                pairs.append((docs[i][0], docs[j][0]))
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least_of = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least_of[root(i)] = min(d, least_of.get(root(i), d))
    return {d: least_of.get(root(i)) for i, (d, _) in enumerate(docs)}, pairs
