"""URL filter: fixed host rules first, then mined association rules.

Token combinations of labelled URLs that predict a verdict are mined with
Spark's FP-growth on two thirds of the labelled rows (by a hash of the id).  A
rule ``tokens => verdict`` is kept if its support (a share of the rows, and
``MIN_ROWS`` of them at least) and confidence reach the bounds, its lift is
above 1, no rule with fewer of its tokens is as confident, and it is confirmed
by the third that was held out: some of those rows have its tokens, and its
confidence there reaches the bound and beats the share of its verdict.  URLs find their rules through an inverted index: a
rule is listed under its rarest token and then checked in full.  The most
confident rule wins (then support, then fewer tokens, then the alphabet); a
URL without a rule gets the majority verdict of the labels (``allow`` if
there are none).

URLs are judged once per distinct set of tokens, so a hot host or copies of a
URL cost one comparison.  The mined rules are at most those the support bound
admits (the number of rules depends on the bound, not on the rows).

Defined results: a null url or one without ``://`` has empty host and path,
no tokens, and the majority verdict; repeated rows each get the same row;
null ids stay null; null labels are left out of mining; further columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SUPPORT = 0.005
MIN_ROWS = 5  # labelled rows that a rule stands on, at least
FOLDS = 3  # one of them is held out
MIN_CONFIDENCE = 0.55
VERDICT_ITEM = "verdict="

# Fixed rules: (host and path, verdict)
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: host labels, every directory, the words of the
    file name, the extension and the names of query arguments.  Pure numbers
    are no tokens."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    parts = F.split(path, "/")
    dirs = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    dirs = F.transform(dirs, lambda x: F.concat(F.lit("dir:"), F.lower(x)))
    file = F.regexp_replace(F.lower(F.element_at(parts, -1)), r"\.[a-z]{1,8}$", "")
    words = F.transform(F.split(file, r"[^\p{L}\p{N}]+"), lambda x: F.concat(F.lit("file:"), x))
    ext = F.regexp_extract(path, r"\.([A-Za-z]{1,8})$", 1)
    ext = F.array(F.concat(F.lit("ext:"), F.lower(ext)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    args = F.transform(F.split(query, "&"),
                       lambda x: F.concat(F.lit("arg:"), F.substring_index(x, "=", 1)))
    every = F.array_distinct(F.concat(labels, dirs, words, ext, args))
    return F.array_sort(F.filter(every, lambda x: ~x.rlike(r"^[a-z]+:[0-9]*$")))


def parsed(pages: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"))
    rows = rows.withColumn("__host", host_of(F.col("__url"))).withColumn("__path", path_of(F.col("__url")))
    return rows.withColumn("__tokens", url_tokens(F.col("__url"), F.col("__host"), F.col("__path")))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_rows: int = MIN_ROWS) -> tuple[DataFrame, str]:
    """Rules (tokens, verdict, confidence, support, rare) and the majority
    verdict.  ``labelled`` has ``__tokens`` and ``__verdict``."""
    spark = labelled.sparkSession
    share = {r["__verdict"]: r["n"] for r in
             labelled.groupBy("__verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = "tokens array<string>, verdict string, confidence double, support double, rare string"
    if not share:
        return spark.createDataFrame([], empty), "allow"
    majority = min(share, key=lambda v: (-share[v], v))
    rows = sum(share.values())
    if rows < min_rows:
        return spark.createDataFrame([], empty), majority
    # half a row less, so that the ceiling Spark takes is min_rows itself
    min_support = max(min_support, (min_rows - 0.5) / rows)
    items = labelled.select(F.concat("__tokens", F.array(F.concat(F.lit(VERDICT_ITEM), "__verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = (model.associationRules
             .where((F.size("consequent") == 1) & F.col("consequent")[0].startswith(VERDICT_ITEM)
                    & (F.col("lift") > 1.0))
             .select(F.array_sort("antecedent").alias("tokens"),
                     F.substring(F.col("consequent")[0], len(VERDICT_ITEM) + 1, 100).alias("verdict"),
                     "confidence", "support"))
    single = (model.freqItemsets.where(F.size("items") == 1)
              .select(F.col("items")[0].alias("__t"), F.col("freq").alias("__f")))
    # a rule is pruned if one with all but one of its tokens is as confident
    less = (rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("__t"))
            .select("tokens", "verdict", "confidence",
                    F.array_remove("tokens", F.col("__t")).alias("__less")))
    short = rules.select(F.col("tokens").alias("__less"), "verdict", F.col("confidence").alias("__c"))
    beaten = (less.join(short, ["__less", "verdict"]).where(F.col("__c") >= F.col("confidence"))
              .select("tokens", "verdict").distinct())
    rules = rules.join(beaten, ["tokens", "verdict"], "left_anti")
    rare = (rules.select("tokens", "verdict", F.explode("tokens").alias("__t")).join(single, "__t")
            .groupBy("tokens", "verdict").agg(F.min_by("__t", F.struct("__f", "__t")).alias("rare")))
    return rules.join(rare, ["tokens", "verdict"]), majority


def confirmed(rules: DataFrame, held: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The rules that hold on labelled rows they were not mined from."""
    base = held.groupBy(F.col("__verdict").alias("verdict")).agg(F.count(F.lit(1)).alias("__v"))
    total = held.agg(F.count(F.lit(1))).scalar()
    listed = held.groupBy("__tokens", "__verdict").agg(F.count(F.lit(1)).alias("__n")).select(
        "__tokens", "__verdict", "__n", F.explode("__tokens").alias("rare"))
    hits = listed.join(rules, "rare").where(F.size(F.array_intersect("tokens", "__tokens")) == F.size("tokens"))
    right = F.sum(F.when(F.col("__verdict") == F.col("verdict"), F.col("__n")).otherwise(0))
    seen = hits.groupBy("tokens", "verdict").agg((right / F.sum("__n")).alias("__held"))
    good = (seen.join(base, "verdict").where((F.col("__held") >= min_confidence)
                                             & (F.col("__held") > F.col("__v") / total)))
    return rules.join(good.select("tokens", "verdict"), ["tokens", "verdict"], "left_semi")


def match(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``__tokens`` with the verdict of its best mined rule (sets without one
    are absent)."""
    listed = token_sets.select("__tokens", F.explode("__tokens").alias("rare"))
    hits = (listed.join(rules, "rare")
            .where(F.size(F.array_intersect("tokens", "__tokens")) == F.size("tokens")))
    order = F.struct(-F.col("confidence"), -F.col("support"), F.size("tokens"), F.col("tokens"), F.col("verdict"))
    return hits.groupBy("__tokens").agg(
        F.min_by(F.struct("verdict", "tokens", "confidence"), order).alias("__best"))


def judge_urls(pages: DataFrame, labelled: DataFrame | None, rules: list[tuple[str, str]] | None = None,
               id_col: str = "page_id", url_col: str = "url", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """id, host, path, rule, verdict, mined_rule, confidence.

    ``labelled``: (id, ``block`` boolean) of some ids of ``pages``.
    """
    rows = parsed(pages, url_col, id_col)
    fit = fitting_rule(F.col("__host"), F.col("__path"), RULES if rules is None else rules)
    rows = rows.withColumn("__fixed", fit)
    learn = rows.select("__id", "__tokens")
    if labelled is None:
        labelled = pages.sparkSession.createDataFrame([], "id long, block boolean")
    lab = labelled.toDF("__lid", "__block").where(F.col("__block").isNotNull())
    learn = (learn.join(lab, F.col("__id") == F.col("__lid"))
             .select("__tokens", F.when(F.col("__block"), "block").otherwise("allow").alias("__verdict"),
                     (F.pmod(F.xxhash64("__id"), F.lit(FOLDS)) == 0).alias("__out")))
    mined, majority = mine(learn.where(~F.col("__out")), min_support, min_confidence)
    mined = confirmed(mined, learn.where("__out"), min_confidence)
    sets = rows.where(F.col("__fixed").isNull() & (F.size("__tokens") > 0)).select("__tokens").distinct()
    best = match(sets, mined)
    out = rows.join(best, "__tokens", "left")
    return out.select(
        F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("__fixed.rule").alias("rule"),
        F.coalesce("__fixed.verdict", "__best.verdict", F.lit(majority)).alias("verdict"),
        F.when(F.col("__fixed").isNull(), F.array_join("__best.tokens", " ")).alias("mined_rule"),
        F.when(F.col("__fixed").isNull(), F.col("__best.confidence")).alias("confidence"))
