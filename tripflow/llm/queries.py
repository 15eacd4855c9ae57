"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (ann, collocations, html_extract, language_id, lexical_search, licenses,
                          line_dedup, mixing, near_dedup, sentencepiece_codec, substring_dedup,
                          topk, url_filter)
from tripflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
MODEL = "piece_bpe_32k.model"


def op1_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, d, "documents"))


def op2_nn_descent(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, d, "embeddings"), F.col("id") % 100 == 0, k=10)


def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, d, "documents"))


def op5_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return (licenses.scan_licenses(table(spark, d, "documents"))
            .withColumn("notices", F.array_join("notices", " ")))


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    # the tables label documents; a page is taken to have the label of the document of its number
    labels = table(spark, d, "labels").select(
        "doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("block"))
    return url_filter.judge_urls(table(spark, d, "pages"), labels)


def op7_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64.0)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    dicts = language_id.fit(docs.where(~held_out()))
    return (language_id.identify(docs, dicts, keep=["doc_id"])
            .withColumn("held_out", held_out())
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


def op9_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents"))


def op10_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, d, "documents"), public_tokenizers.path(MODEL),
                                      with_ids=False, with_text=False)


def op11_html_extract(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(table(spark, d, "pages"))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.mine(table(spark, d, "documents"))


def op13_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return lexical_search.rank(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


def shipped(query: Query) -> Query:
    """Python workers find the package wherever the session was started."""

    @wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *paths])
        return query(spark, d)

    return run


def queries() -> dict[str, Query]:
    return {name: shipped(f) for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op5_license_scan": licenses.oracle_sql(),
            "op12_collocations": collocations.oracle_sql(),
            "op13_lexical_search": lexical_search.oracle_sql()}
