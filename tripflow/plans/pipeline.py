"""One daily run, end to end, as Spark jobs that communicate through tables.

    ingest -> raw CSV (per run date) -> typed Parquet staging
           -> validate the text (one aggregate + duplicate count + top-10 distinct) -> gate
           -> strict filter (clean / dead letter; rows of other dates are dead letter)
           -> features + zone joins -> trips table and daily facts, written beside the
              live ones and published together (``operators/snapshots.py``)
           -> load counts -> audit row -> analytics views

Every step reads the previous step's *written* table, so a lost executor
recomputes from the last table instead of from the source, and the typed
staging copy means the CSV text is parsed exactly once.  A load replaces the
run date in all tables at once: running a date twice leaves one copy, and a
run that fails half way leaves every table as it was.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contract import STRICT, TAXI_TRIPS_SCHEMA, TRIP_CONTRACT
from tripflow.operators import aggregates as agg
from tripflow import files
from tripflow.operators import audit as aud
from tripflow.operators import snapshots as snap
from tripflow.operators import tables as tbl
from tripflow.operators import validate as val
from tripflow.operators.clean import row_gate, split_clean_dead, split_other_dates
from tripflow.operators.enrich import derive_features
from tripflow.operators.zones import join_zones, read_zone_lookup, zone_fallback
from tripflow.plans import analytics as an
from tripflow.sources import raw as rawsrc

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Table locations under one root (a shared file system on a cluster)."""
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def raw(self) -> str:
        return self.path("raw")

    def staging(self, run_date: str) -> str:
        return self.path(f"staging/run_date={run_date}")

    def broken(self, run_date: str) -> str:
        return self.path(f"broken_lines/run_date={run_date}")

    def report(self, run_date: str) -> str:
        return self.path(f"validation_reports/run_date={run_date}")


def _zones(spark: SparkSession, zone_path: str | None) -> DataFrame | None:
    if zone_path and files.exists(spark, zone_path):
        return read_zone_lookup(spark, zone_path)
    log.warning("Zone lookup not found at %s - zones fall back to 'unknown'", zone_path)
    return None


def transform(clean: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Strict features + zone joins (or the fallback), in table order."""
    featured = derive_features(clean, STRICT)
    joined = join_zones(featured, zones, dedupe=True) if zones is not None \
        else zone_fallback(featured)
    return joined.select(*TAXI_TRIPS_SCHEMA.fieldNames())


def build_facts(trips: DataFrame) -> dict[str, DataFrame]:
    """The daily facts; shares are of their own date, so that they do not
    depend on which dates are loaded together."""
    return {"agg_by_zone": agg.zone_aggregates(trips),
            "agg_by_hour": agg.hourly_demand(trips),
            "agg_payment": agg.payment_breakdown(trips, within="pickup_date")}


@contextmanager
def audited(spark: SparkSession, run_date: str, layout: Layout) -> Iterator[dict]:
    """The run's metrics, which become one audit row however the run ends."""
    started = dt.datetime.now()
    metrics = {"run_id": f"run_{run_date.replace('-', '')}", "run_date": run_date, "status": "failed"}
    try:
        yield metrics
    finally:
        rec = aud.audit_record(
            spark, metrics["run_id"], run_date, started, dt.datetime.now(),
            metrics.get("raw_row_count", 0), metrics.get("clean_row_count", 0),
            metrics.get("validation_status", "N/A"), metrics["status"])
        aud.append_audit(rec, layout.path("pipeline_runs"))


def create_tables(spark: SparkSession, layout: Layout) -> None:
    """The tables outside the manifest, empty where they do not exist yet (those
    in it read as empty before their first load)."""
    tbl.init_table(spark, "pipeline_runs", layout.path("pipeline_runs"))
    tbl.init_table(spark, "dead_letter", layout.path("dead_letter"), ["run_date"])


def process(spark: SparkSession, run_date: str, layout: Layout, zones: DataFrame | None,
            min_rows: int, metrics: dict, keep: int = 1) -> None:
    """Everything behind ingest: the raw text of one run date to its tables, of
    which the last ``keep`` versions stay readable."""
    create_tables(spark, layout)
    raw_path = f"{layout.raw}/run_date={run_date}"
    text, broken = rawsrc.split_corrupt(rawsrc.read_raw_text(spark, raw_path))
    # parse the CSV once into typed Parquet; later steps read this copy
    raw_rows = tbl.write_table(rawsrc.cast_trips_lenient(text), layout.staging(run_date))
    staged = spark.read.parquet(layout.staging(run_date))
    metrics["corrupt_row_count"] = tbl.write_table(broken, layout.broken(run_date))
    broken = spark.read.schema("raw_line string").parquet(layout.broken(run_date))
    metrics["raw_row_count"] = raw_rows + metrics["corrupt_row_count"]

    # validate the text as it came + gate (FAILED raises; warnings pass)
    val.write_report(val.report(val.validate(text), raw_path), layout.report(run_date))
    summary = spark.read.json(layout.report(run_date))
    row = summary.select("status").first()
    metrics["validation_status"] = row["status"]
    val.assert_valid(summary.select("status", "error_count"))

    if not row_gate(staged, min_rows):
        metrics.update(status="skipped", clean_row_count=0)
        return

    # clean / dead letter, features, zones -> trips table
    clean, dead = split_clean_dead(staged, STRICT)
    clean, stray = split_other_dates(clean, run_date)
    corrupt = broken.withColumn("reject_reasons", F.array(F.lit("corrupt_line")))
    (dead.unionByName(stray).unionByName(corrupt, allowMissingColumns=True)
     .withColumn("run_date", F.lit(run_date).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(layout.path("dead_letter")))
    load = snap.Load(spark, layout.root)
    # the gate is also a condition of the write itself
    metrics["clean_row_count"] = load.write("taxi_trips", val.gated(transform(clean, zones), summary))
    # the facts read the trips just written, not the raw rows again
    for name, fact in build_facts(load.read("taxi_trips")).items():
        load.write(name, fact)
    load.commit([run_date])
    snap.vacuum(spark, layout.root, keep)

    counts = tbl.load_counts(read_tables(spark, layout)["taxi_trips"], run_date).first()
    metrics.update(loaded_rows=counts["loaded_rows"], total_rows=counts["total_rows"],
                   status="success")


def run(spark: SparkSession, run_date: str, layout: Layout, source_path: str | None = None,
        zone_path: str | None = None, min_rows: int = TRIP_CONTRACT.min_row_count,
        synthetic_rows: int = 5000) -> dict:
    """Run one date; returns the run metrics (the audit row's values)."""
    with audited(spark, run_date, layout) as metrics:
        # ingest: source choice, raw text layer for the run date
        df, metrics["source"] = rawsrc.ingest(spark, run_date, source_path, synthetic_rows)
        rawsrc.write_raw_csv(df, layout.raw, run_date)
        process(spark, run_date, layout, _zones(spark, zone_path), min_rows, metrics)
    return metrics


TABLES = (*snap.MANAGED, "pipeline_runs", "dead_letter")


def read_tables(spark: SparkSession, layout: Layout, version: int | None = None) -> dict[str, DataFrame]:
    """The trips and their facts, all of one version (the latest unless given)."""
    return snap.read(spark, layout.root, version=version)


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """A10: the written tables as session views under their table names, so
    report SQL written against ``taxi_trips``, ``agg_by_zone``, ... runs as is
    in ``spark.sql`` (Parquet scans, with pruning and pushdown as for the
    DataFrame API).  Tables not written yet are skipped; returns the names."""
    found = read_tables(spark, layout) if snap.versions(spark, layout.root) else {}
    for name in set(TABLES) - set(snap.MANAGED):
        if files.exists(spark, layout.path(name)):
            found[name] = tbl.read_table(spark, name, layout.path(name))
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return sorted(found)


def analytics(spark: SparkSession, layout: Layout, run_date: str) -> dict[str, DataFrame]:
    """The report queries over the loaded tables (lazy DataFrames)."""
    tables = read_tables(spark, layout)
    trips, zone, hour, pay = (tables[name] for name in (
        "taxi_trips", "agg_by_zone", "agg_by_hour", "agg_payment"))
    return {
        "top_zones": an.top_zones(zone),
        "hourly_heatmap": an.hourly_heatmap(hour),
        "payment_share": an.payment_share(pay),
        "borough_leaderboard": an.borough_leaderboard(zone),
        "distance_split": an.distance_split(trips),
        "fare_anomalies": an.fare_anomalies(trips),
        "pipeline_health": an.pipeline_health(trips),
        "health_for_date": an.health_for_date(trips, run_date),
        "top_hours": an.top_hours(trips),
        "revenue_by_payment": an.revenue_by_payment(trips),
        "time_of_day_breakdown": an.time_of_day_breakdown(trips),
    }


def run_summary(spark: SparkSession, layout: Layout, run_date: str) -> DataFrame:
    """The final record of a run: its latest audit row plus the rows
    loaded for its date (a partition-pruned count, as a scalar subquery)."""
    run_id = f"run_{run_date.replace('-', '')}"
    latest = aud.audit_latest(spark.read.parquet(layout.path("pipeline_runs"))) \
        .where(F.col("run_id") == run_id)
    loaded = tbl.load_counts(read_tables(spark, layout)["taxi_trips"], run_date)
    return latest.withColumn("loaded_rows", loaded.select("loaded_rows").scalar())


def run_batch_profile(spark: SparkSession, staged: DataFrame, out_root: str) -> DataFrame:
    """A9 + E4-E6: the batch profile's outputs from typed raw trips.

    Writes ``trips`` (batch features), ``agg_by_zone`` (per date and location
    id) and ``agg_by_hour``; the facts read the written trips, not the raw
    input again.  Returns the one-row transform summary (E6), computed in one
    pass over the raw rows.
    """
    from tripflow.contract import BATCH
    from tripflow.operators.clean import filter_rows

    featured = derive_features(filter_rows(staged, BATCH), BATCH)
    tbl.write_table(featured, f"{out_root}/trips")
    trips = spark.read.parquet(f"{out_root}/trips")
    tbl.write_table(agg.location_aggregates_batch(trips), f"{out_root}/agg_by_zone")
    tbl.write_table(agg.hourly_batch(trips), f"{out_root}/agg_by_hour")
    return agg.transform_summary(derive_features(staged, BATCH), BATCH)
