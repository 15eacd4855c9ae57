"""The joins of line dedup are done in parts of the words, and words travel once a pair."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm import line_dedup as ld


def test_parts_hold_all_prefix_words_once(spark):
    words = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(40)]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    rows = ld.keyed(docs, "doc_id", "text", []).select("k1", "k2", "text")
    sets = ld.distinct_sets(rows, ld.SIMILARITY)
    whole = sorted(tuple(r) for r in sets.select("k1", F.explode("pre")).collect())
    parts = [[tuple(r) for r in ld.postings(sets, p).select("k1", "w").collect()] for p in range(ld.PARTS)]
    assert sorted(r for p in parts for r in p) == whole
    assert all(0 < len(p) < len(whole) for p in parts)


def test_one_list_of_words_a_pair_is_shuffled(spark):
    line = "a b c d e f g h i j"
    texts = [line, line[:-1] + "k", "l m n o p q r s t u", line[:-1] + "k", None]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = ld.keyed(docs, "doc_id", "text", []).select("k1", "k2", "text")
    at = {r["text"]: (r["k1"], 0, r["k2"]) for r in rows.where("k1 = 0").collect()}
    other = rows.where("text like 'l%'").select("k1", "k2").first()
    place = "struct<k1:long,no:int,k2:long>"
    pairs = spark.createDataFrame([(at[texts[0]], at[texts[1]]), (at[texts[0]], (other["k1"], 0, other["k2"]))],
                                  f"a {place}, b {place}")
    out = ld.beaten(pairs, rows.repartition(4, "k1", "k2"), ld.SIMILARITY)
    assert [tuple(r) for r in out.collect()] == [at[texts[1]]]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "AS pair" not in plan  # no grouping of both lists by pair


def test_near_lines_across_the_parts(spark):
    base = [f"w{i}" for i in range(20)]
    lines = [" ".join(base[:i] + [f"z{i}"] + base[i + 1:]) for i in range(20)]  # Jaccard 18/22 between any two
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    out = {r["doc_id"]: r["n_removed"] for r in ld.dedup_lines(docs).collect()}
    assert out == {i: int(i > 0) for i in range(20)}


def test_wide_parities_tell_long_lines_apart(spark):
    base = [f"w{i}" for i in range(200)]
    near = " ".join(base[:190] + [f"x{i}" for i in range(10)])  # Jaccard 190/210 with base
    far = " ".join(base[:60] + [f"y{i}" for i in range(140)])
    docs = spark.createDataFrame([(0, " ".join(base)), (1, near), (2, far)], "doc_id long, text string")
    rows = ld.keyed(docs, "doc_id", "text", []).select("k1", "k2", "text")
    sets = ld.distinct_sets(rows, ld.SIMILARITY)
    place = sets.select(F.struct(*ld.PLACE).alias("p"))
    pairs = place.withColumnRenamed("p", "a").crossJoin(place.withColumnRenamed("p", "b")).where("a < b")
    assert {(r["a"]["k1"], r["b"]["k1"]) for r in ld.likely(pairs, sets, ld.SIMILARITY).collect()} == {(0, 1)}


def test_unrelated_lines_of_common_words_are_no_candidates(spark, monkeypatch):
    rng = random.Random(5)
    lines = [" ".join(rng.sample([f"w{i}" for i in range(600)], 150)) for _ in range(200)]
    met, beaten = [], ld.beaten
    monkeypatch.setattr(ld, "beaten", lambda pairs, *a: met.append(pairs.count()) or beaten(pairs, *a))
    likely = ld.likely
    monkeypatch.setattr(ld, "likely", lambda pairs, *a: met.append(pairs.count()) or likely(pairs, *a))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert ld.dedup_lines(docs).where("n_removed > 0").count() == 0
    assert sum(met) < len(lines)


def test_lines_of_all_sizes_equal_brute_force(spark):
    rng, lines = random.Random(8), []
    words = [f"w{i}" for i in range(90)]
    for _ in range(60):
        line = rng.sample(words, rng.randint(4, 70))
        lines.append(line)
        for _ in range(3):
            near = [w for w in line if rng.random() > 0.07]
            lines.append(near + [f"z{rng.randint(0, 30)}" for _ in range(rng.randint(0, len(line) // 6))])
    rng.shuffle(lines)
    sets = [set(x) for x in lines]
    same = lambda a, b: len(a & b) >= ld.SIMILARITY * len(a | b) - ld.EPS
    want = {i: int(any(same(sets[j], x) for j in range(i))) for i, x in enumerate(sets) if x}
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines) if x], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in ld.dedup_lines(docs).collect()}
    assert got == want
    assert 30 < sum(want.values()) < len(want) - 30


def test_pipeline_stage_fetches_near_copies_alone(spark, monkeypatch):
    rng = random.Random(3)
    lines = [rng.sample([f"w{i}" for i in range(600)], 150) for _ in range(100)]
    lines += [line[1:] + ["zz"] for line in lines]
    met, likely, beaten = [], ld.likely, ld.beaten
    monkeypatch.setattr(ld, "likely", lambda pairs, *a: met.append(pairs.collect()) or likely(pairs, *a))
    monkeypatch.setattr(ld, "beaten", lambda pairs, *a: met.append(pairs.collect()) or beaten(pairs, *a))
    docs = spark.createDataFrame([(i, " ".join(x), "en", "s", 1) for i, x in enumerate(lines)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(100))
    pairs = {(r["a"]["k1"], r["b"]["k1"]) for rs in met for r in rs}
    assert {(i, i + 100) for i in range(100)} <= pairs
    assert len(pairs) < 150
