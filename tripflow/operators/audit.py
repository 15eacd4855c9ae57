"""Run audit (K3) and the freshness gate (K1).

``pipeline_runs`` is append-only: every attempt appends one row; readers
take the latest row per ``run_id``.  "Latest" is an aggregate
(``max`` of a struct led by ``completed_at``), which combines map-side, so
a run id with very many attempts never lands in one sort partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contract import PIPELINE_RUNS_SCHEMA

SUCCESS, FAILED = "success", "failed"
AUDIT_COLS = PIPELINE_RUNS_SCHEMA.fieldNames()


def audit_record(spark: SparkSession, run_id: str, execution_date: str,
                 started_at: dt.datetime, completed_at: dt.datetime, raw_row_count: int,
                 clean_row_count: int, validation_status: str, status: str) -> DataFrame:
    """One audit row (run metadata, built on the driver)."""
    row = (run_id, dt.date.fromisoformat(execution_date), started_at, completed_at,
           int(raw_row_count), int(clean_row_count), validation_status, status)
    return spark.createDataFrame([row], PIPELINE_RUNS_SCHEMA)


def append_audit(record: DataFrame, path: str) -> None:
    record.select(*AUDIT_COLS).write.mode("append").parquet(path)


def audit_latest(audit: DataFrame) -> DataFrame:
    """K3: the latest row of every run id (ties broken by the other columns)."""
    rest = [c for c in AUDIT_COLS if c not in ("run_id", "completed_at")]
    latest = F.max(F.struct("completed_at", *rest)).alias("r")
    return audit.groupBy("run_id").agg(latest).select(
        "run_id", *[F.col(f"r.{c}").alias(c) for c in AUDIT_COLS if c != "run_id"]
    ).select(*AUDIT_COLS)


def fresh_dates(batch_dates: DataFrame, audit: DataFrame,
                date_col: str = "run_date") -> DataFrame:
    """K1: dates of the batch with no successful run in the audit."""
    done = (audit.where(F.col("status") == SUCCESS)
            .select(F.col("execution_date").alias(date_col)).distinct())
    return batch_dates.select(date_col).distinct().join(done, date_col, "left_anti")
