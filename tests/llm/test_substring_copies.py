"""Substring dedup: many copies of one long row are parsed once."""

import random

from pyspark.sql import functions as F

from test_llm_operators import brute_substrings
from tripflow.llm import substring_dedup


def test_copies_count_and_all_lose_their_text(spark):
    r = random.Random(9)
    rnd = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    long, part = rnd(3000), rnd(700)
    rows = [(1, long)] * 40 + [(None, long[:900] + rnd(200))] * 2 + [(2, part + rnd(100)), (3, rnd(50) + part[:500]),
                                                                    (4, rnd(2000)), (5, None), (5, None), (6, "a" * 900)]
    df = spark.createDataFrame([(*x, 3) for x in rows], "doc_id long, text string, n long").repartition(6)
    got = sorted(tuple(x)[1:5] for x in substring_dedup.dedup_substrings(df).collect())
    assert got == sorted(brute_substrings([t for _, t in rows], 400))
    keyed = substring_dedup.keyed(df, "doc_id", "text")
    once = substring_dedup.distinct_rows(keyed)
    assert once.agg(F.sum("n")).first()[0] == len(rows) and once.count() == 7
