"""Contract validation (H1-H11) as Spark jobs.

Shape of the work, whatever the number of checks:

* one ``agg`` over the data: row count, NULL counts, range violations and
  rule violations for every column/rule at once (map-side partial
  aggregation, one row out);
* one exact duplicate count: a full-row ``groupBy`` (partial aggregation
  combines a hot group of copies before the shuffle);
* per column with allowed values: distinct unexpected values, counted, and
  the first ten sorted (a bounded top-k, never an unbounded ``collect_set``).

The raw text layer can be checked as it is: a text column is parsed for
ranges, allowed values and rules (what cannot be parsed is skipped by ranges
and allowed values and violates its rules), while NULL counts see the text.

The duplicate and allowed-value results enter the one metrics row as
scalar subqueries (no joins), and the row is turned into finding rows with
``inline``: nothing but metadata (column names) is decided on the driver.
Messages follow the reference report texts.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.contract import TRIP_CONTRACT, ColumnSpec, Contract
from tripflow.functions.exact import round_half_up
from tripflow.functions.guards import require
from tripflow.sources.raw import typed

log = logging.getLogger(__name__)

ERROR, WARNING = "error", "warning"
FAILED = "FAILED"
FINDING_FIELDS = ["severity", "check", "column", "message", "violation_count", "null_fraction"]
FINDING_SCHEMA = T.StructType([
    T.StructField("severity", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("violation_count", T.LongType()),
    T.StructField("null_fraction", T.DoubleType()),
])


def bound_text(spec: ColumnSpec, value) -> str:
    """The bound as the report prints it (int, float or timestamp)."""
    if spec.type == "integer":
        return str(int(value))
    if spec.type == "float":
        return str(float(value))
    return str(value)


def _number(name: str) -> Column:
    """A column as a double; NaN is no value, infinities and huge ones are."""
    x = F.expr(f"try_cast(`{name}` AS DOUBLE)")
    return F.when(~F.isnan(x), x)


def comparable(spec: ColumnSpec) -> Column:
    """The column as its bounds compare with it, as it came: unparsable text
    and NaN are NULL, while values that aggregates leave out (infinities, 1e12
    and more) count as what they are."""
    if spec.type == "timestamp":
        return F.expr(f"try_cast(`{spec.name}` AS TIMESTAMP_NTZ)")
    return _number(spec.name)


def parsed(df: DataFrame, spec: ColumnSpec) -> Column:
    """The column as a value, also where ``df`` holds it as text."""
    if not isinstance(df.schema[spec.name].dataType, T.StringType):
        return F.col(spec.name)
    if spec.type == "integer":
        return F.expr(f"try_cast(try_cast(`{spec.name}` AS DOUBLE) AS BIGINT)").alias(spec.name)
    return _number(spec.name).alias(spec.name) if spec.type == "float" else typed(spec.name)


def parsed_columns(df: DataFrame, contract: Contract, *more: Column) -> DataFrame:
    """``df`` with its contract columns parsed, and the columns ``more``."""
    known = {c.name: parsed(df, c) for c in contract.columns if c.name in df.columns}
    return df.select(*[known.get(c, F.col(c)) for c in df.columns], *more)


def bound_lit(spec: ColumnSpec, value) -> Column:
    if spec.type == "timestamp":
        return F.lit(str(value)).cast("timestamp_ntz")
    return F.lit(float(value))


def pct_text(frac: Column, decimals: int) -> Column:
    """Python's ``{x:.Np%}``: the fraction as a percent with N decimals."""
    return F.format_string(f"%.{decimals}f%%", round_half_up(frac * 100.0, decimals))


def resolvable_rules(df: DataFrame, contract: Contract):
    """Rules whose expression resolves against ``df``; others are skipped
    with a log line (the reference does the same)."""
    df = parsed_columns(df, contract)
    ok = []
    for rule in contract.rules:
        try:
            df.select(F.expr(rule.expr)).schema  # noqa: B018 - analysis only
            ok.append(rule)
        except Exception as e:  # noqa: BLE001
            log.warning("Could not evaluate rule %r: %s", rule.name, e)
    return ok


def metrics(df: DataFrame, contract: Contract = TRIP_CONTRACT, by: Sequence[str] = ()) -> DataFrame:
    """One row (a group of ``by``): every count the checks need, in a single
    aggregate."""
    present = [c for c in contract.columns if c.name in df.columns]
    nulls = [F.col(c.name).isNull().alias(f"__null__{c.name}") for c in present]
    ranged = [comparable(c).alias(f"__range__{c.name}") for c in present
              if c.min_value is not None or c.max_value is not None]
    df = parsed_columns(df, contract, *nulls, *ranged)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for spec in present:
        aggs.append(F.count_if(F.col(f"__null__{spec.name}")).alias(f"nulls__{spec.name}"))
        if spec.min_value is not None:
            aggs.append(F.count_if(F.col(f"__range__{spec.name}") < bound_lit(spec, spec.min_value))
                        .alias(f"below__{spec.name}"))
        if spec.max_value is not None:
            aggs.append(F.count_if(F.col(f"__range__{spec.name}") > bound_lit(spec, spec.max_value))
                        .alias(f"above__{spec.name}"))
    for rule in resolvable_rules(df, contract):
        aggs.append(F.count_if(~F.coalesce(F.expr(rule.expr), F.lit(False)))
                    .alias(f"rule__{rule.name}"))
    if by:
        # whether there is any is all that a verdict needs, not which
        aggs += [F.count_if(F.col(s.name).isNotNull() & ~F.col(s.name).isin(list(s.allowed_values)))
                 .alias(f"n_unexpected__{s.name}") for s in present if s.allowed_values]
    return df.groupBy(*by).agg(*aggs)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first copy of each distinct row (NULL = NULL),
    and the number of distinct rows.  Exact, one scan: grouping by all columns
    combines the copies of a hot row map-side."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_rows"))


def unexpected_values(df: DataFrame, spec: ColumnSpec, k: int = 10) -> DataFrame:
    """One row: the number of distinct values outside the allowed list, and
    the first ``k`` of them sorted, as the report prints them (``[6]``)."""
    c = F.col(spec.name)
    bad = df.select(parsed(df, spec)).where(c.isNotNull() & ~c.isin(list(spec.allowed_values))).distinct()
    top = bad.orderBy(c).limit(k)
    return top.agg(
        F.concat(F.lit("["), F.array_join(
            F.transform(F.array_sort(F.collect_list(c)), lambda x: x.cast("string")), ", "),
            F.lit("]")).alias(f"unexpected__{spec.name}")).select(
        bad.agg(F.count(F.lit(1))).scalar().alias(f"n_unexpected__{spec.name}"),
        f"unexpected__{spec.name}")


def _finding(fired: Column, severity: str, check: str, column: str | None, message: Column,
             violation_count: Column | None = None, null_fraction: Column | None = None) -> Column:
    return F.struct(
        fired.alias("fired"),
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        message.alias("message"),
        (violation_count if violation_count is not None else F.lit(None)).cast("bigint")
        .alias("violation_count"),
        (null_fraction if null_fraction is not None else F.lit(None)).cast("double")
        .alias("null_fraction"))


def validate(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """All findings (errors and warnings) of ``df`` against ``contract``."""
    allowed = [c for c in contract.columns if c.name in df.columns and c.allowed_values]
    extra = {"duplicate_rows": duplicate_rows(df).select("duplicate_rows").scalar()}
    for spec in allowed:
        top = unexpected_values(df, spec)
        for c in top.columns:
            extra[c] = top.select(c).scalar()
    m = metrics(df, contract).withColumns(extra)
    return (m.select(F.inline(F.array(*_checks(df, contract))))
            .where(F.col("fired")).select(*FINDING_FIELDS))


def verdicts(df: DataFrame, day: Column, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """H11 for every run date at once: the status that the contract gives the
    rows of each date, and whether its load proceeds.

    One aggregate by date for all counts, one for the copies of rows; the dates
    join the two.  Rows without a date are a group of their own.
    """
    columns = df.columns
    dated = df.withColumn("__day", day)
    copies = dated.groupBy("__day", *columns).agg(F.count(F.lit(1)).alias("__copies"))
    dup = copies.groupBy(F.col("__day").alias("__d")).agg(F.sum(F.col("__copies") - 1).alias("duplicate_rows"))
    m = metrics(dated, contract, by=["__day"]).join(dup, F.col("__day").eqNullSafe(F.col("__d")))
    for spec in contract.columns:
        if spec.allowed_values and spec.name in columns:
            m = m.withColumn(f"unexpected__{spec.name}", F.lit(""))
    found = F.filter(F.array(*_checks(df, contract)), lambda x: x["fired"])
    of = lambda severity: F.size(F.filter("__found", lambda x: x["severity"] == severity)).cast("bigint")
    return (m.withColumn("__found", found)
            .select(F.col("__day").alias("run_date"), "n_rows", of(ERROR).alias("error_count"),
                    of(WARNING).alias("warning_count"))
            .withColumn("status", _status())
            .withColumn("proceed", F.col("status") != FAILED))


def _checks(df: DataFrame, contract: Contract) -> list[Column]:
    """Every finding that the contract knows for the columns of ``df``, over a
    row of ``metrics`` with the duplicate and allowed-value results; ``fired``
    tells whether it holds."""
    present = [c for c in contract.columns if c.name in df.columns]
    missing = sorted(set(contract.column_names) - set(df.columns))
    allowed = [c for c in present if c.allowed_values]
    n = F.col("n_rows")
    col = F.col
    found: list[Column] = []
    # H1: missing columns (metadata only)
    for name in missing:
        found.append(_finding(F.lit(True), ERROR, "column_exists", name,
                              F.lit(f"Required column '{name}' is missing")))
    # H2: row count
    found.append(_finding(
        n < contract.min_row_count, ERROR, "min_row_count", None,
        F.format_string("Dataset has %s rows — below minimum %s",
                        F.format_number(n, 0), F.lit(f"{contract.min_row_count:,}"))))
    # H3/H4: NULL fractions
    for spec in present:
        frac = col(f"nulls__{spec.name}").cast("double") / F.nullif(n, F.lit(0))
        if not spec.nullable:
            found.append(_finding(
                frac > 0, ERROR, "not_nullable", spec.name,
                F.format_string(f"'{spec.name}' must not be null — %s nulls found",
                                pct_text(frac, 1)), null_fraction=frac))
        else:
            found.append(_finding(
                frac > contract.max_null_fraction, WARNING, "high_null_fraction", spec.name,
                F.format_string(f"'{spec.name}' has %s nulls (threshold "
                                f"{contract.max_null_fraction * 100:.0f}%%)", pct_text(frac, 1)),
                null_fraction=frac))
    # H5: ranges
    for spec in present:
        for kind, value, word in (("min_value", spec.min_value, "below min"),
                                  ("max_value", spec.max_value, "above max")):
            if value is None:
                continue
            cnt = col(f"{'below' if kind == 'min_value' else 'above'}__{spec.name}")
            found.append(_finding(
                cnt > 0, WARNING, kind, spec.name,
                F.format_string(f"%d rows {word} {bound_text(spec, value)} in '{spec.name}'", cnt),
                violation_count=cnt))
    # H6: allowed values
    for spec in allowed:
        found.append(_finding(
            col(f"n_unexpected__{spec.name}") > 0, WARNING, "allowed_values", spec.name,
            F.format_string(f"Unexpected values in '{spec.name}': %s",
                            col(f"unexpected__{spec.name}"))))
    # H7: duplicates
    dup_frac = col("duplicate_rows").cast("double") / F.nullif(n, F.lit(0))
    found.append(_finding(
        F.coalesce(dup_frac > contract.max_duplicate_fraction, F.lit(False)), WARNING,
        "duplicate_fraction", None,
        F.format_string(f"Duplicate fraction %s exceeds threshold "
                        f"{contract.max_duplicate_fraction * 100:.0f}%%", pct_text(dup_frac, 2))))
    # H8: quality rules
    for rule in resolvable_rules(df, contract):
        cnt = col(f"rule__{rule.name}")
        found.append(_finding(
            cnt > 0, ERROR if rule.severity == "error" else WARNING, rule.name, None,
            F.format_string(f"Rule '{rule.name}' violated by %d rows", cnt),
            violation_count=cnt))
    return found


def null_fractions(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """H3/H4 metrics: NULL count and fraction of every present contract column."""
    m = metrics(df, contract)
    n = F.col("n_rows")
    rows = [F.struct(F.lit(c.name).alias("column"),
                     F.lit(c.nullable).alias("nullable"),
                     F.col(f"nulls__{c.name}").alias("null_count"),
                     (F.col(f"nulls__{c.name}").cast("double") / F.nullif(n, F.lit(0)))
                     .alias("null_fraction"))
            for c in contract.columns if c.name in df.columns]
    return m.select(F.inline(F.array(*rows)))


def range_violations(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """H5 metrics: rows below each minimum and above each maximum."""
    m = metrics(df, contract)
    rows = []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        for kind, value, prefix in (("min_value", c.min_value, "below"),
                                    ("max_value", c.max_value, "above")):
            if value is not None:
                rows.append(F.struct(F.lit(c.name).alias("column"), F.lit(kind).alias("bound"),
                                     F.lit(bound_text(c, value)).alias("bound_value"),
                                     F.col(f"{prefix}__{c.name}").alias("violation_count")))
    return m.select(F.inline(F.array(*rows)))


def allowed_values(df: DataFrame, contract: Contract = TRIP_CONTRACT, k: int = 10) -> DataFrame:
    """H6: per constrained column, the first ``k`` unexpected values."""
    out = None
    for spec in contract.columns:
        if spec.name not in df.columns or not spec.allowed_values:
            continue
        one = unexpected_values(df, spec, k).select(
            F.lit(spec.name).alias("column"),
            F.col(f"n_unexpected__{spec.name}").alias("unexpected_count"),
            F.col(f"unexpected__{spec.name}").alias("unexpected_values"))
        out = one if out is None else out.unionByName(one)
    return out


def duplicate_fraction(df: DataFrame) -> DataFrame:
    """H7 metrics: rows, distinct rows, duplicate fraction."""
    dups = duplicate_rows(df)
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumns({c: dups.select(c).scalar() for c in ("distinct_rows", "duplicate_rows")})
            .select("n_rows", "distinct_rows", "duplicate_rows",
                    (F.col("duplicate_rows").cast("double") / F.nullif(F.col("n_rows"), F.lit(0)))
                    .alias("duplicate_fraction")))


def quality_rules(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """H8 metrics: violations per rule (NULL counts as violated)."""
    rules = resolvable_rules(df, contract)
    m = metrics(df, contract)
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                     F.col(f"rule__{r.name}").alias("violation_count")) for r in rules]
    return m.select(F.inline(F.array(*rows)))


SUMMARY_FIELDS = ["status", "error_count", "warning_count", "dataset", "schema_version"]


def _status() -> Column:
    return (F.when(F.col("error_count") > 0, FAILED)
            .when(F.col("warning_count") > 0, "WARNED").otherwise("PASSED"))


def _summarise(findings: DataFrame, dataset: str, contract: Contract, *more: Column) -> DataFrame:
    errors = F.count_if(F.col("severity") == ERROR)
    warnings = F.count_if(F.col("severity") == WARNING)
    return (findings.agg(errors.alias("error_count"), warnings.alias("warning_count"), *more)
            .withColumns({
                "status": _status(),
                "dataset": F.lit(dataset),
                "schema_version": F.lit(contract.version)}))


def summary(findings: DataFrame, dataset: str, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Status and counts (one row)."""
    return _summarise(findings, dataset, contract).select(*SUMMARY_FIELDS)


def report(findings: DataFrame, dataset: str, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """The whole report as one row, from one aggregate over the
    findings (their number is bounded by the contract, not by the data)."""
    f = F.struct("check", "column", "message", "violation_count", "null_fraction")
    return (_summarise(findings, dataset, contract,
                       F.collect_list(F.when(F.col("severity") == ERROR, f)).alias("errors"),
                       F.collect_list(F.when(F.col("severity") == WARNING, f)).alias("warnings"))
            .select("status", "error_count", "warning_count", "errors", "warnings",
                    F.lit(None).cast("string").alias("report_path"), "dataset",
                    "schema_version", F.localtimestamp().alias("validated_at")))


REPORT_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("error_count", T.LongType()),
    T.StructField("warning_count", T.LongType()),
    *(T.StructField(c, T.ArrayType(T.StructType(FINDING_SCHEMA.fields[1:]))) for c in ("errors", "warnings")),
    *(T.StructField(c, T.StringType()) for c in ("report_path", "dataset", "schema_version")),
    T.StructField("validated_at", T.TimestampNTZType())])


def read_reports(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Written reports, one row each, the findings nested as they were written."""
    return spark.read.schema(REPORT_SCHEMA).json(paths)


def report_findings(reports: DataFrame) -> DataFrame:
    """One row a finding of each report; a report without any has one row."""
    tagged = lambda c, s: F.transform(c, lambda x: F.struct(F.lit(s).alias("severity"), x.alias("f")))
    rows = reports.select("dataset", "status", "error_count", "warning_count", F.explode_outer(
        F.concat(tagged("errors", ERROR), tagged("warnings", WARNING))).alias("x"))
    return rows.select("dataset", "status", "error_count", "warning_count", "x.severity", "x.f.*")


def gated(df: DataFrame, summary_df: DataFrame) -> DataFrame:
    """H11 in the plan: ``df``, whose job fails where the summary says FAILED
    (or is not there), so that what it writes is not written."""
    status = summary_df.agg(F.max("status")).scalar()
    errors = summary_df.agg(F.max("error_count")).scalar()
    return require(df, status != FAILED, F.concat(
        F.lit("Schema validation FAILED — "), F.coalesce(errors.cast("string"), F.lit("no")), F.lit(" hard errors")))


def write_report(report_df: DataFrame, path: str) -> None:
    """One JSON document per validation run; ``report_path`` records
    where it was written.  The report is one row, so one small file."""
    (report_df.withColumn("report_path", F.lit(path))
     .coalesce(1).write.mode("overwrite").json(path))


class ValidationFailed(ValueError):
    pass


def assert_valid(summary_df: DataFrame) -> str:
    """Raise on FAILED, pass warnings.  Reads one summary row."""
    row = summary_df.first()
    if row["status"] == FAILED:
        raise ValidationFailed(f"Schema validation FAILED — {row['error_count']} hard errors")
    return row["status"]
