"""Collocations and their automata against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tripflow.llm import automata, collocations

FOLD = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
        yield re.findall(r"[^\x20\x09]+", piece)


def ngrams(texts):
    return Counter(tuple(ws[i:i + k]) for t in texts for ws in pieces(t) for k in (1, 2, 3)
                   for i in range(len(ws) - k + 1))


def brute(rows, least, top, covered=50):
    by = defaultdict(list)
    for lang, text in rows:
        by["und" if lang is None else lang].append(text)
    out = []
    for lang, texts in by.items():
        f = ngrams(texts)
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        rows = []
        for g, a in cand.items():
            cuts = [(1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if any(len(h) > len(g) and 100 * c >= covered * a and any(h[i:i + len(g)] == g for i in range(len(h)))
                   for h, c in cand.items()):
                continue
            rows.append((" ".join(g), a, f[g[:k]], f[g[k:]], n, score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def data(seed):
    r = random.Random(seed)
    words = ["New", "york", "city", "Österreich", "a", "b", "\x1f", "c\u00a0d", "x-y"] + [f"w{i}" for i in range(30)]

    def text():
        out = []
        for _ in range(r.randint(0, 60)):
            out.append(r.choice([r.choice(words), "new York CITY", "a b", "a b c"]))
            out.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\v"]))
        return "".join(out)

    rows = [(r.choice(["en", "en", "en", "de", None]), text()) for _ in range(120)]
    return rows + [("en", None), ("en", ""), ("und", "a b a b"), ("zz", " \t"), ("fr", "w1 w2 " * 5000), ("fr", "b " * 4000)] \
        + [("es", "uno dos. tres")] * 12


def table(spark, rows):
    return spark.createDataFrame([(t, lang, 1, 2.0, "x") for lang, t in rows],
                                 "text string, lang string, a long, score double, words string").repartition(5)


@pytest.mark.parametrize(("chunk", "fan"), [(8 << 20, 64), (300, 3), (64, 64)])
def test_against_brute_force(spark, chunk, fan):
    rows = data(chunk)
    got = collocations.mine(table(spark, rows), least=4, top=40, chunk=chunk, fan=fan)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 40)


def test_empty_table(spark):
    assert collocations.mine(table(spark, data(1)).limit(0)).collect() == []


def paths(a):
    owner, third, c3 = a.arcs3()
    got = Counter({(w,): int(c) for w, c in zip(a.words, a.c1, strict=True) if c})
    w = a.words
    got.update({(w[x], w[y]): int(c) for x, y, c in zip(a.first, a.second, a.c2, strict=True)})
    got.update({(w[a.first[o]], w[a.second[o]], w[z]): int(c) for o, z, c in zip(owner, third, c3, strict=True)})
    return got


def test_automata_hold_their_ngrams():
    texts = [t for _, t in data(5) if t]
    folded = [t.encode().translate(automata.FOLD) for t in texts]
    want = Counter({tuple(w.encode() for w in g): c for g, c in ngrams(texts).items()})
    whole = automata.count(folded)
    assert paths(whole) == want
    assert len(whole.offset) - 1 < len(whole.c2)  # equal states are shared
    assert paths(automata.load(bytes(whole))) == want
    halves = [automata.count(folded[:40]), automata.count(folded[40:]), automata.count([])]
    assert paths(automata.union(halves)) == want
    cut = automata.parts(whole, 7)
    assert sum((paths(a) for _, a in cut), Counter()) == want and len(cut) == 7
    finer = [(r, a) for _, p in cut for r, a in automata.parts(p, 49)]
    assert sum((paths(a) for _, a in finer), Counter()) == want
    assert all(paths(a) == paths(b) for (_, a), (_, b) in
               zip(sorted(finer, key=lambda x: x[0]), automata.parts(whole, 49), strict=True))
