"""Ranked lexical search against brute force, at several shard and leaf sizes."""

import math
import random
import re
from collections import Counter

import pytest

from tripflow.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k):
    tfs = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    tfs = [(i, c) for i, c in tfs if c]
    n, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in tfs:
            m = 25 + (75 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in TERM.findall((text or "").translate(FOLD)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i, s))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 5, 0.5, "x", 3) for i, t in docs],
                              "doc_id long, text string, q long, score double, term string, rank int")
    return d.repartition(3), spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")


def data(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Élan", "straße", "x1"]
    draw = lambda n: " ".join(r.choice(words[:r.choice([3, 12, 43])]) + r.choice(["", ".", ",", "-Y"]) for _ in range(n))
    docs = [(i, draw(r.randint(1, 80))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)] + [(None, docs[5][1]), (7, "w1 w2"), (7, "w1 w2")]
    docs += [(400, None), (401, ""), (402, "!? .."), (403, "w1 " * 20_000)]
    items = [(i, draw(r.randint(1, 12))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "w1 W1 w1"), (3, docs[5][1]), (3, docs[5][1]), (None, "w7 w8")]
    return docs, items


@pytest.mark.parametrize(("shard", "leaf", "block"), [(8192, 2048, 4 << 20), (16, 4, 4 << 20), (50, 1, 200)])
def test_against_brute_force(spark, monkeypatch, shard, leaf, block):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    if block < 1000:
        monkeypatch.setattr(lexical_search, "VOCABULARY_BYTES", 10)  # the whole index is written
    docs, items = data(shard)
    got = lexical_search.rank(*tables(spark, docs, items), k=7, leaf=leaf)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 7)


def test_empty_tables(spark):
    d, q = tables(spark, [(1, "a b")], [(1, "a")])
    assert lexical_search.rank(d.limit(0), q).collect() == []
    assert lexical_search.rank(d, q.limit(0)).collect() == []
    # log(4 / 3) is above zero: the only document holds the only term
    assert [tuple(r)[:3] for r in lexical_search.rank(d, q).collect()] == [(1, 1, 1)]
