"""Each operator against brute force, and on awkward tables."""

import hashlib
import math
import random
import textwrap
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import (ann, language_id, licenses, line_dedup, mixing, near_dedup, queries,
                          sentencepiece_codec, substring_dedup, topk, url_filter)
from tripflow.llm import common
from tripflow.llm.components import components
from tripflow.llm.license_texts import TEXTS

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "k1 long, score double, class_id long, g string")


def documents(spark, rows):
    """(id, text, lang, source) with further columns of clashing names."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, 0.5, 7, "x") for r in rows], SCHEMA)


AWKWARD = [(1, None, "en", "a"), (2, "", None, None), (3, "\n \t\n", "en", "a"), (None, "some text here now", "en", "b"),
           (4, "!!! 123", "fr", "a"), (5, "same words again and again " * 3, "en", "a"),
           (5, "same words again and again " * 3, "en", "a"), (6, "same words again and again " * 3, None, "b"),
           (7, "x" * 70_000, "de", "b"), (8, "lorem ipsum " * 9_000, "fr", None), (9, "é", "fr", "c")]


def apply(name, docs):
    return {
        "op1": lambda: substring_dedup.dedup_substrings(docs),
        "op3": lambda: line_dedup.dedup_lines(docs),
        "op4": lambda: near_dedup.near_duplicates(docs),
        "op5": lambda: licenses.scan_licenses(docs),
        "op8": lambda: language_id.identify(docs, language_id.fit(docs), keep=["doc_id"]),
        "op9": lambda: mixing.mix_sources(docs),
        "op10": lambda: sentencepiece_codec.encode(docs, MODEL),
    }[name]()


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op8", "op9", "op10"])
def test_awkward_and_empty_tables(spark, name):
    docs = documents(spark, AWKWARD)
    got = apply(name, docs).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in AWKWARD)
    assert apply(name, docs.limit(0)).collect() == []


def brute_substrings(texts, n):
    bs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + n] for b in bs for i in range(len(b) - n + 1))
    out = []
    for b in bs:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(x for x, f in zip(b, gone, strict=True) if not f)
        runs = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("n", [400, 30])
def test_substrings_against_brute_force(spark, n):
    r = random.Random(n)
    rnd = lambda k: "".join(r.choice("abcdefgh é") for _ in range(k))
    base = [rnd(r.randint(100, 2000)) for _ in range(20)]
    texts = [None, "", "a" * 2000, "a" * 401, "ab" * 700, "a" * 400, "abc" * 300 + rnd(50)]
    for _ in range(60):
        t = ""
        for _ in range(r.randint(1, 4)):
            b = r.choice(base)
            at = r.randint(0, len(b))
            t += rnd(r.randint(0, 50)) + b[at:r.randint(at, len(b))]
        texts.append(t)
    texts += [base[0]] * 8 + [base[1][:600] + "Z" + base[1][600:]] * 2 + [base[2][1:], base[2][:-1]]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(5)
    got = {x["doc_id"]: tuple(x)[1:5] for x in substring_dedup.dedup_substrings(docs, n).collect()}
    assert got == dict(enumerate(brute_substrings(texts, n)))


def brute_lines(rows, t=0.8):
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        if text is None:
            out[i] = (None, 0, 0)
            continue
        kept, ls = [], text.split("\n")
        for line in ls:
            w = frozenset(line.lower().split())
            if not w or not any(len(w & v) >= t * len(w | v) - 1e-9 for v in seen):
                kept.append(line)
            if w:
                seen.append(w)
        out[i] = ("\n".join(kept), len(ls), len(ls) - len(kept))
    return out


def test_lines_against_brute_force(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    base = [[r.choice(words[:r.choice([10, 60])]) for _ in range(r.randint(1, 25))] for _ in range(40)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (None, "a b c d e\n A b\tc d E f\n")]
    for i in range(3, 90):
        ls = []
        for _ in range(r.randint(1, 5)):
            b = list(r.choice(base))
            for _ in range(r.randint(0, 4)):
                if r.random() < .5:
                    b[r.randrange(len(b))] = r.choice(words)
                else:
                    b.append(r.choice(words))
            ls.append(" ".join(b))
        rows.append((i, "\n".join(ls)))
    rows.append((500, rows[20][1]))
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(4)
    got = {x["doc_id"]: (x["kept"], x["n_lines"], x["n_removed"]) for x in line_dedup.dedup_lines(docs).collect()}
    assert got == brute_lines(rows)


def test_lines_of_rows_without_id_whose_texts_share_a_32_bit_hash(spark):
    even = F.col("id") % 2 == 0  # whose second line goes
    at = F.concat(F.lit("line "), F.col("id"), F.lit(" first\n"), F.when(even, F.lit("first line ")).otherwise(
        F.lit("some other words ")), F.col("id"))
    some = spark.range(400_000).select(F.hash(at).alias("h"), at.alias("t"), even.alias("even"))
    twins = some.groupBy("h").agg(F.max(F.when(F.col("even"), F.col("t"))).alias("a"),
                                  F.max(F.when(~F.col("even"), F.col("t"))).alias("b")).dropna()
    _, a, b = twins.orderBy("h").first()
    rows = [(None, a, "en", "a"), (None, b, "en", "a"), (9, "different words", "en", "a")]
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert sorted(x["kept"] for x in got) == sorted([a.split("\n")[0], b, "different words"])


def test_near_copies_without_id_or_of_one_id_are_dropped(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(None, words, "en", "a"), (None, words, "en", "a"), (None, words + " more", "en", "a"),
            (3, "other " + words.upper(), "en", "a"), (3, words + " again", "en", "a"), (4, words, "en", "a"),
            (None, "quite another text of its own", "en", "a"), (7, "a b c d e f g", "en", "a"),
            (7, "h i j k l m n", "en", "a")]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted((str(x["doc_id"]), x["text"]) for x in got if x["doc_id"] != 3) == [
        ("7", "a b c d e f g"), ("7", "h i j k l m n"), ("None", "quite another text of its own")]
    assert sum(x["doc_id"] == 3 for x in got) == 1


def edit_distance(x, y):
    p = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        q = [i]
        for j, b in enumerate(y, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (a != b)))
        p = q
    return p[-1]


def test_banded_alignment_is_the_edit_distance():
    r = random.Random(3)
    for _ in range(1500):
        letters = r.choice([2, 4, 30])
        x = [r.randrange(letters) for _ in range(r.randint(0, 40))]
        y = list(x) if r.random() < .7 else [r.randrange(letters) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 10)):
            y.insert(r.randint(0, len(y)), r.randrange(letters))
            if r.random() < .6:
                y.pop(r.randrange(len(y)))
        d, most = edit_distance(x, y), r.randint(0, 25)
        got = near_dedup.edit_distance_within(np.array(x, "u8"), np.array(y, "u8"), most)
        assert got == (d if d <= most else None)


def test_near_copies_found_and_others_left(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts, group = [], []
    common = [r.choice(words) for _ in range(60)]
    for g in range(25):
        base = [r.choice(words) for _ in range(r.randint(60, 300))] + common
        for _ in range(r.choice([1, 1, 2, 8])):
            t = list(base)
            for _ in range(len(t) // 60):
                t[r.randrange(len(t))] = r.choice(words)
            texts.append(" ".join(t))
            group.append(g)
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(4)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: group.index(g) for i, g in enumerate(group)}


def test_near_star_family_against_brute_force(spark):
    r = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    base = [r.choice(words) for _ in range(200)]
    texts = [base]
    for _ in range(200):  # 0.88 similar to the base, most pairs of them below 0.8
        t = list(base)
        for at in r.sample(range(8), 4):
            i = at * 25 + r.randrange(19)
            t[i:i + 6] = [r.choice(words) for _ in range(6)]
        texts.append(t)
    texts += [[r.choice(words) for _ in range(100)] + base[:100] for _ in range(40)]
    code = {w: i for i, w in enumerate(words)}
    arrays = [np.array([code[w] for w in t], "u8") for t in texts]
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for j in range(len(texts)):
        for i in range(j):
            a, b = root(i), root(j)
            if a != b and near_dedup.edit_distance_within(arrays[i], arrays[j], 40) is not None:
                least[max(a, b)] = min(a, b)
    docs = documents(spark, [(i, " ".join(t), "en", "a") for i, t in enumerate(texts)]).repartition(4)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def test_near_pairs_of_a_crowded_group_are_all_aligned(spark):
    """Forty pairs of near copies whose one sketch lies in a passage all share."""
    r = random.Random(5)
    shared = [f"p{i}" for i in range(40)]
    agree = {}
    while max(map(len, agree.values()), default=0) < 40:
        base = shared + [f"w{r.randrange(10**9)}" for _ in range(60)]
        near = [*base[:-1], "other"]
        one, two = (near_dedup.sketches(near_dedup.word_hashes(" ".join(t).encode()), order=1, n=1)[0] for t in (base, near))
        if one == two:
            agree.setdefault(int(one), []).append((base, near))
    rows = [" ".join(t) for pair in max(agree.values(), key=len) for t in pair]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(rows)]).repartition(4)
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs, order=1, n_sketches=1).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_least_distance_is_a_lower_bound():
    r = random.Random(6)
    for _ in range(300):
        x, y = ([r.randrange(5) for _ in range(r.randrange(1, 14))] for _ in range(2))
        d = near_dedup.edit_distance_within(np.array(x, "u8"), np.array(y, "u8"), 20)
        assert near_dedup.least_distance(np.array(x, "u8"), np.array(y, "u8")) <= d


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)] + [(200, i) for i in range(201, 240)]
    got = {x["a"]: x["b"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 103: 100} | {i: 200 for i in range(201, 240)}


def test_licenses(spark):
    mit = next(t for n, t in TEXTS if n == "MIT")
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,"), "en", "a"),
            (2, "Prose.\nreleased under the MIT LICENCE!\nMore.", "en", "a"),
            (3, mit + " But not quite.", "en", "a")]
    got = {x["doc_id"]: x for x in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got[1]["license"] == "MIT" and got[2]["license"] is None and got[3]["license"] is None
    assert got[2]["notices"] == ["MIT"] and got[1]["notices"] == []


ISC_WRAPPED = """ISC License

Copyright (c) 2021, Some One <one@example.org>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

"""


def test_licenses_in_their_usual_line_breaks(spark):
    isc = next(t for n, t in TEXTS if n == "ISC").split("\n\n")[1]
    rows = [(0, ISC_WRAPPED + textwrap.fill(isc, 75), "en", "a")]
    names = ["ISC"]
    for name, text in TEXTS:
        if len(text) < 4000:  # the long ones are in their line breaks
            for width in (60, 72, 79):
                wrapped = "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))
                rows.append((len(rows), "Copyright 2020 Some One\n\n" + wrapped, "en", "a"))
                names.append(name)
        else:
            rows.append((len(rows), text.replace("[yyyy] [name of copyright owner]", "2020 Some One"), "en", "a"))
            names.append(name)
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
            "Unlicense", "CC0-1.0"} <= set(names)
    got = {x["doc_id"]: x["license"] for x in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got == dict(enumerate(names))


PAGES = [(1, "http://A.example.org/en/1?x=1"), (2, "https://example.org/es/2#t"), (3, "http://x.com/de/1"),
         (4, "http://x.com/fr/1"), (5, None), (6, "no scheme"), (7, "http://x.net"), (8, "http://y.org"),
         (9, "HTTP://notexample.org/es/2"), (None, "http://x.net/a"), (1, "http://A.example.org/en/1?x=1")]


def test_url_rules(spark):
    pages = spark.createDataFrame([(*p, "h", "v") for p in PAGES], "page_id long, url string, host string, verdict string")
    got = {x["page_id"]: x for x in url_filter.judge_urls(pages, None).collect()}
    rules = {1: "example.org/en/1", 2: "example.org/es/", 3: "com/de/", 4: "com/fr/", 5: None, 6: None, 7: None,
             8: None, 9: "org/", None: None}
    assert {k: v["rule"] for k, v in got.items()} == rules
    assert got[1]["host"] == "a.example.org" and got[1]["path"] == "/en/1" and got[7]["path"] == ""
    assert {got[i]["verdict"] for i in (1, 2, 3)} == {"block"} and {got[i]["verdict"] for i in (4, 5, 9)} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), None).collect() == []


def test_url_association_rules_are_mined(spark):
    rows = [(i, f"http://{'spam' if i % 3 else 'fine'}.net/{'ads' if i % 2 else 'doc'}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 3 != 0 and i % 2 == 1) for i in range(0, 300, 2)]
                                   + [(i, i % 3 != 0) for i in range(1, 300, 2)], "doc_id long, block boolean")
    got = {x["page_id"]: x for x in url_filter.judge_urls(pages, labels).collect()}
    assert all((got[i]["verdict"] == "block") == (i % 3 != 0 and i % 2 == 1) for i in got)
    assert got[1]["mined_rule"] == "dir:ads host:spam"


def test_url_patterns_deep_in_the_path_and_in_the_file_name(spark):
    rows = [(i, f"http://h.net/a/b/c/d/{'ads' if i % 4 == 1 else 'doc'}/{i}") for i in range(200)]
    rows += [(i, f"http://h.net/a/{'Casino-offers' if i % 4 == 1 else 'plain_page'}-{i}.html") for i in range(200, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 4 == 1) for i, _ in rows], "doc_id long, block boolean")
    got = {x["page_id"]: x for x in url_filter.judge_urls(pages, labels).collect()}
    assert all((got[i]["verdict"] == "block") == (i % 4 == 1) for i in got)
    assert got[1]["mined_rule"] == "dir:ads" and got[201]["mined_rule"] in ("file:casino", "file:offers")


VECTORS = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
           (None, [1.0, 2.0]), (20, [1.0, 2.0]), (40, [1.0, 2.0]), (100, [1.0, 2.1]), (7, [3.0, -1.5]), (8, [1.0, 2.0, 3.0]),
           (9, [1e-3, 5.0])]


def test_topk_against_brute_force(spark):
    r = np.random.default_rng(1)
    many = [(i, r.standard_normal(16).round(1).tolist()) for i in range(10, 700)]
    df = spark.createDataFrame([(*v, "s") for v in many], "vec_id long, embedding array<float>, score string")
    got = {}
    for x in topk.top_k(df.repartition(3), F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
    z = np.floor(64 * np.array([np.float32(v) for _, v in many], "f8")).astype("i8")
    ids = np.array([i for i, _ in many])
    for q in ids[ids % 20 == 0]:
        s, other = z @ z[ids == q][0], ids != q
        best = np.lexsort((ids[other], -s[other]))[:20]
        assert got[q] == list(zip(ids[other][best].tolist(), s[other][best].tolist(), strict=True))


def test_vectors_that_take_no_part(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("id") % 20 == 0).collect()
    assert {x["query_id"] for x in got} == {20, 40, 100}
    assert {x["vec_id"] for x in got} == {3, 7, 9, 20, 40, 100}
    near = ann.nearest_neighbours(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [x["vec_id"] for x in near if x["query_id"] == 20] == [40, 100, 9, 7]
    assert near[0]["score"] == 0.0
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).collect() == []
    assert ann.nearest_neighbours(df.limit(0), F.col("id") % 20 == 0).collect() == []


def test_nearest_neighbours_recall(spark, sf0001):
    df = spark.read.parquet(f"{sf0001}/embeddings.parquet")
    rows = df.collect()
    ids = np.array([x["vec_id"] for x in rows])
    m = np.array([x["embedding"] for x in rows], "f8")
    got = {}
    for x in ann.nearest_neighbours(df, F.col("id") % 100 == 0).collect():
        got.setdefault(x["query_id"], set()).add(x["vec_id"])
    hits = 0
    for q in got:
        d = ((m - m[ids == q]) ** 2).sum(1)
        d[ids == q] = np.inf
        hits += len(got[q] & set(ids[np.argsort(d)[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got)


def test_outliers_and_rare_lengths_have_neighbours(spark):
    r = np.random.default_rng(5)
    mean = np.ones(32)
    many = [(i, (mean + 0.05 * r.standard_normal(32)).tolist()) for i in range(1, 6000)]
    many += [(100_000, (-mean).tolist())] + [(200_000 + i, r.standard_normal(7).tolist()) for i in range(15)]
    df = spark.createDataFrame(many, "vec_id long, embedding array<float>")
    asked = F.col("id").isin(100_000, 200_000, 200_001)
    got = {}
    for x in ann.nearest_neighbours(df, asked, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append(x["vec_id"])
    ids, of = np.array([i for i, _ in many]), dict(many)
    for q in (100_000, 200_000, 200_001):
        d = sorted((float(((np.float32(of[i]) - np.float32(of[q])).astype("f8") ** 2).sum()), int(i))
                   for i in ids if i != q and len(of[i]) == len(of[q]))
        assert got[q] == [i for _, i in d[:10]]


def test_language_accuracy_on_held_out_documents(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    out = queries.queries()["op8_language_id"](spark, sf0001).join(docs.select("doc_id", "lang"), "doc_id")
    rows = [x for x in out.collect() if x["held_out"]]
    assert sum(x["lang"] == x["lang_pred"] for x in rows) >= 0.95 * len(rows)
    got = {x["doc_id"]: x for x in apply("op8", documents(spark, AWKWARD)).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert all(0 <= x["score"] <= 1 for x in rows)


def test_mixture_stays_within_a_block(spark):
    sizes = {"a": 900, "b": 130, "c": 60, None: 17}
    rows = [(i * 10 + j, "t", "en", s) for j, (s, n) in enumerate(sizes.items()) for i in range(n)]
    weights = {"a": 0.5, "b": 0.3, "c": 0.15, mixing.NULL_SOURCE: 0.05}
    out = mixing.mix_sources(documents(spark, rows).repartition(4), weights, block_rows=1).collect()
    assert sorted(x["doc_id"] for x in out) == sorted(r[0] for r in rows)
    first = sorted((x["slot"], x["source"]) for x in out if x["phase"] == 0)
    assert len({s for s, _ in first}) == len(first)
    exact = mixing.quantise(weights)
    used = Counter()
    ends = min(-(-n // 1) / exact[s or mixing.NULL_SOURCE] * mixing.PERIOD for s, n in sizes.items())
    for slot, s in first:
        if slot >= ends:
            break
        used[s or mixing.NULL_SOURCE] += 1
        assert all(abs(used[k] - (slot + 1) * exact[k] / mixing.PERIOD) < 1 for k in exact)
    assert len({(x["source"], x["block"], x["place"]) for x in out}) == len(out)


@pytest.mark.parametrize("n", [3, 1500])
def test_mixture_keeps_the_given_weights_over_many_periods(n):
    r = random.Random(n)
    weights = {f"s{i}": r.random() ** 3 + 1e-5 for i in range(n)}
    weights["big"] = sum(weights.values()) / math.e
    total = math.fsum(weights.values())
    used, lag = Counter(), 0.0
    steps = 20 * mixing.PERIOD
    for slot, phase, s, block in mixing.schedule(dict.fromkeys(weights, 10**9), weights, 1):
        lag = max(lag, abs(used[s] - slot * weights[s] / total))
        assert phase == 0 and block == used[s]
        used[s] += 1
        lag = max(lag, abs(used[s] - (slot + 1) * weights[s] / total))
        if slot + 1 == steps:
            break
    assert lag < 1 and all(abs(used[s] - steps * w / total) < 1 for s, w in weights.items())


def test_mixture_of_more_than_a_thousand_sources(spark):
    rows = [(i, "t", "en", f"s{i % 1100}" if i < 3300 else "big") for i in range(6600)]
    weights = {f"s{j}": 0.5 / 1100 for j in range(1100)} | {"big": 0.5}
    out = mixing.mix_sources(documents(spark, rows).repartition(4), weights, block_rows=1).collect()
    assert sorted(x["slot"] for x in out) == list(range(6600)) and len({x["doc_id"] for x in out}) == 6600
    first = sorted((x["slot"], x["source"]) for x in out if x["phase"] == 0)
    used = Counter()
    assert len(first) > 4000
    for slot, s in first:
        used[s] += 1
        assert abs(used[s] - (slot + 1) * weights[s]) < 1
    assert all(abs(used[s] - len(first) * w) < 1 for s, w in weights.items())


@pytest.mark.parametrize("n", [1, 3, 20])
def test_pfair_periods(n):
    r = random.Random(n)
    for _ in range(5):
        slots = mixing.quantise({f"s{i}": r.random() ** 3 + 1e-4 for i in range(n)})
        plan = mixing.pfair_period(slots)
        assert sorted(t for p in plan.values() for t in p) == list(range(sum(slots.values())))
        for s, p in plan.items():
            assert all(math.floor(j * mixing.PERIOD / slots[s]) <= t < math.ceil((j + 1) * mixing.PERIOD / slots[s])
                       for j, t in enumerate(p))


def test_sentencepiece_equals_the_library(spark):
    r = random.Random(1)
    letters = " \n\t▁abcthe<s>/é中\U0001F600​́"
    texts = [None, "", " ", "  a", "a\n b", "\n"] + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(300)]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    out = sentencepiece_codec.encode(docs, MODEL)
    for x in out.collect():
        ids = sp.encode(texts[x["doc_id"]] or "", add_bos=True, add_eos=True)
        assert x["ids"] == ids and x["n_tokens"] == len(ids) and x["decoded"] == sp.decode(ids)
        assert x["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    back = {x["doc_id"]: x["text"] for x in sentencepiece_codec.decode(out, MODEL).collect()}
    assert back == {i: sp.decode(sp.encode(t or "")) for i, t in enumerate(texts)}


def test_pipeline_stages(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf0001).cache()
        assert after.columns == docs.columns
        if name == "source_mixing":
            assert sorted(after.collect()) == sorted(before.collect())
        before = after
    last = corpus_pipeline.run(spark, sf0001)
    assert sorted(x["doc_id"] for x in last.select("doc_id").collect()) == sorted(
        x["doc_id"] for x in before.select("doc_id").collect())
    classes = near_dedup.near_duplicates(before)
    assert classes.where("doc_id <> class_id").count() == 0


def test_pipeline_returns_the_mixture(spark):
    sizes = {"a": 2500, "b": 900, None: 400}
    rows = [(None if i % 3 == 0 else i, f"text {i % 350} {s}", "en", s) for s, n in sizes.items() for i in range(n)]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").repartition(7)
    kept = common.stored(corpus_pipeline.mix_by_source(spark, docs, ""))
    got = corpus_pipeline.tokenise(spark, kept, "").collect()
    places = [(x["slot"], x["place"]) for x in got]
    assert len(set(places)) == len(rows) and None not in {s for s, _ in places}
    weights = {s: n ** mixing.ALPHA for s, n in sizes.items()}
    names = {corpus_pipeline.tokenise(spark, docs.limit(0), "").columns == list(got[0].asDict())}
    assert names == {True}
    sha = {}
    for x in sentencepiece_codec.encode(docs.select("doc_id", "text", "source"), MODEL, carry=["source"]).collect():
        sha[x["ids_sha256"]] = x["source"]
    slots = sorted({(x["slot"], sha[x["ids_sha256"]]) for x in got})
    used = Counter()
    for t, (slot, s) in enumerate(slots[:40]):
        used[s] += 1
        assert slot == t
        assert all(abs(used[k] - (t + 1) * w / sum(weights.values())) < 1 for k, w in weights.items())


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_pipeline_stages_on_awkward_tables(spark, stage):
    docs = documents(spark, AWKWARD).select("doc_id", "text", "lang", "source", "n_chars")
    got = stage[1](spark, docs, "").collect()
    assert len(got) <= len(AWKWARD)
    assert stage[1](spark, docs.limit(0), "").collect() == []
