"""Named queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame that reads the
given tables (trips are derived from ``lineitem``, zones from ``supplier``),
so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contract import BATCH, PINNED_DAY, STRICT, TRIP_CONTRACT
from tripflow.functions.exact import avg_fixed
from tripflow.operators import aggregates as agg
from tripflow.operators import audit as aud
from tripflow.operators import tables as tbl
from tripflow.operators import validate as val
from tripflow.operators.clean import (filter_stats, is_clean, reject_reason_counts,
                                      row_gate_by_date, row_gate_plan, split_clean_dead)
from tripflow.operators.enrich import derive_features
from tripflow.operators.zones import parse_zone_lookup, zone_fallback
from tripflow.plans import analytics as an
from tripflow.plans import lake
from tripflow.plans.trips import (build_taxi_trips, clean_trips, daily_fact, featured_trips,
                                  raw_day, raw_trips, taxi_trips, zones)
from tripflow.sources import raw as rawsrc
from tripflow.sources.fixture import EXTREME_EXPRS, FAULTY_AGAIN, FAULTY_EXPRS, table
from tripflow.sources.synthetic import synthetic_trips

Query = Callable[[SparkSession, str], DataFrame]
FEATURE_COLS = ["trip_duration_min", "avg_speed_mph", "tip_pct", "time_of_day", "pickup_date",
                "pickup_hour", "payment_label"]


def _cast_trips(spark, d):
    return rawsrc.cast_trips(rawsrc.as_text(raw_trips(spark, d)))


def _cast_trips_lenient(spark, d):
    return rawsrc.cast_trips_lenient(rawsrc.as_text(raw_trips(spark, d)))


def _day_slice(spark, d):
    return rawsrc.day_slice(raw_day(spark, d, PINNED_DAY), PINNED_DAY)


def _standardise(spark, d):
    source = rawsrc.to_source_layout(raw_trips(spark, d), extra={
        "store_and_fwd_flag": F.when(F.col("VendorID") == 1, "N").otherwise("Y"),
        "extra": F.col("total_amount") - F.col("fare_amount") - F.col("tip_amount")})
    return rawsrc.standardise_columns(source)


def _synthetic(spark, d):
    ids = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    return synthetic_trips(ids, PINNED_DAY)


def _ingest_summary(spark, d):
    rows = rawsrc.ingest_plan(rawsrc.standardise_columns(_day_slice(spark, d)), _synthetic(spark, d))
    return rawsrc.source_summary(rows.withColumn("run_date", F.lit(PINNED_DAY).cast("date")))


def _zone_lookup(spark, d):
    text = zones(spark, d).select(F.col("location_id").cast("string").alias("LocationID"),
                                  F.col("borough").alias("Borough"),
                                  F.col("zone_name").alias("Zone"))
    return parse_zone_lookup(text)


def _filter_stats(spark, d):
    return filter_stats(raw_trips(spark, d), (STRICT, BATCH))


def _features(profile):
    def run(spark, d):
        return featured_trips(spark, d, profile)
    return run


def _zone_fallback(spark, d):
    return zone_fallback(featured_trips(spark, d, STRICT))


def _agg_by_zone(spark, d):
    return agg.zone_aggregates(taxi_trips(spark, d))


def _agg_by_hour(spark, d):
    return agg.hourly_demand(taxi_trips(spark, d))


def _agg_payment(spark, d):
    return agg.payment_breakdown(taxi_trips(spark, d))


def _transform_summary(spark, d):
    return agg.transform_summary(derive_features(raw_trips(spark, d), BATCH), BATCH)


def _core_queries() -> dict[str, Query]:
    return {
        # A. sources
        "cast_trips": _cast_trips,
        "cast_trips_lenient": _cast_trips_lenient,
        "day_slice": _day_slice,
        "standardise_columns": _standardise,
        "synthetic_trips": _synthetic,
        "ingest_summary": _ingest_summary,
        "zone_lookup": _zone_lookup,
        # B. filters
        "filter_strict": lambda s, d: clean_trips(s, d, STRICT),
        "filter_batch": lambda s, d: clean_trips(s, d, BATCH),
        "filter_stats": _filter_stats,
        "row_gate_day": lambda s, d: row_gate_plan(_day_slice(s, d)),
        "row_gate": lambda s, d: row_gate_by_date(raw_trips(s, d)),
        # C. features, D. joins
        "features_strict": _features(STRICT),
        "features_batch": _features(BATCH),
        "zone_fallback": _zone_fallback,
        "zone_join": build_taxi_trips,
        # E. aggregates
        "agg_by_zone": _agg_by_zone,
        "agg_by_hour": _agg_by_hour,
        "agg_payment": _agg_payment,
        "agg_by_location": lambda s, d: agg.location_aggregates_batch(featured_trips(s, d, BATCH)),
        "agg_by_hour_batch": lambda s, d: agg.hourly_batch(featured_trips(s, d, BATCH)),
        "transform_summary": _transform_summary,
        # G. analytics
        # the report queries read the staged daily facts, as in the daily run
        "top_zones": lambda s, d: an.top_zones(daily_fact(s, d, "agg_by_zone")),
        "hourly_heatmap": lambda s, d: an.hourly_heatmap(daily_fact(s, d, "agg_by_hour")),
        "payment_share": lambda s, d: an.payment_share(daily_fact(s, d, "agg_payment")),
        "borough_leaderboard": lambda s, d: an.borough_leaderboard(
            daily_fact(s, d, "agg_by_zone")),
        "distance_split": lambda s, d: an.distance_split(taxi_trips(s, d)),
        "fare_anomalies": lambda s, d: an.fare_anomalies(taxi_trips(s, d)),
        "pipeline_health": lambda s, d: an.pipeline_health(taxi_trips(s, d)),
        "health_for_date": lambda s, d: an.health_for_date(taxi_trips(s, d), PINNED_DAY),
        "top_hours": lambda s, d: an.top_hours(taxi_trips(s, d)),
        "revenue_by_payment": lambda s, d: an.revenue_by_payment(taxi_trips(s, d)),
        "time_of_day_breakdown": lambda s, d: an.time_of_day_breakdown(taxi_trips(s, d)),
    }


# ---- validation, dead letters, reload, audit, run summary ----

DATASET = "trips"


def _dead(spark, d):
    return split_clean_dead(raw_trips(spark, d), STRICT)[1]


def _dead_letter(spark, d):
    return _dead(spark, d).withColumn("reject_reasons", F.array_join("reject_reasons", ","))


def _reloaded(spark, d):
    """The trips table after a double append of the pinned day (the
    reference's non-idempotent load) is repaired by one reload."""
    trips = taxi_trips(spark, d)
    batch = trips.where(F.col("pickup_date") == F.lit(PINNED_DAY).cast("date"))
    existing = trips.unionByName(batch)
    return tbl.reload(existing, batch, PINNED_DAY)


def derived_audit(spark, d):
    """Audit rows derived from the trips: one run per pickup date; every run
    has a failed first attempt, runs up to the pinned day a successful retry."""
    per_day = (raw_trips(spark, d)
               .groupBy(F.to_date("tpep_pickup_datetime").alias("execution_date"))
               .agg(F.count(F.lit(1)).alias("raw_row_count"),
                    F.count_if(is_clean(STRICT)).alias("clean_row_count")))
    day = F.col("execution_date").cast("timestamp_ntz")
    hour = F.expr("INTERVAL 1 HOUR")
    first = F.struct(day.alias("started_at"), (day + hour).alias("completed_at"),
                     F.lit(0).cast("bigint").alias("clean_row_count"),
                     F.lit("WARNED").alias("validation_status"), F.lit(aud.FAILED).alias("status"))
    retry = F.struct((day + hour).alias("started_at"), (day + hour * 2).alias("completed_at"),
                     F.col("clean_row_count"), F.lit("WARNED").alias("validation_status"),
                     F.lit(aud.SUCCESS).alias("status"))
    attempts = F.when(F.col("execution_date") <= F.lit(PINNED_DAY).cast("date"),
                      F.array(first, retry)).otherwise(F.array(first))
    return (per_day.select("execution_date", "raw_row_count", F.explode(attempts).alias("a"))
            .select(F.concat(F.lit("run_"), F.date_format("execution_date", "yyyyMMdd"))
                    .alias("run_id"), "execution_date", "a.started_at", "a.completed_at",
                    "raw_row_count", "a.clean_row_count", "a.validation_status", "a.status")
            .select(*aud.AUDIT_COLS))


def _fresh_dates(spark, d):
    dates = raw_trips(spark, d).select(F.to_date("tpep_pickup_datetime").alias("run_date"))
    return aud.fresh_dates(dates, derived_audit(spark, d))


def _faulty(spark, d):
    trips = raw_trips(spark, d).select(*[F.expr(e).alias(n) for n, e in FAULTY_EXPRS])
    return trips.unionAll(trips.where(FAULTY_AGAIN))


def _extreme(spark, d):
    return raw_trips(spark, d).select(*[F.expr(e).alias(n) for n, e in EXTREME_EXPRS])


def _reports(spark, d):
    """Three datasets validated, their reports written as JSON and read back."""
    trips = raw_trips(spark, d)
    fair = clean_trips(spark, d, STRICT).where("total_amount >= fare_amount + tip_amount - 0.01")
    root = lake.folder(spark, "reports")
    for name, df in (("fair", fair), ("trips", trips), ("faulty", _faulty(spark, d))):
        val.write_report(val.report(val.validate(df), name), f"{root}/{name}")
    return val.report_findings(val.read_reports(spark, [f"{root}/{n}" for n in ("fair", "trips", "faulty")]))


def _per_date(spark, d):
    """One row per pickup date: too few rows for the contract."""
    rest = [c for c in TRIP_CONTRACT.column_names if c != rawsrc.PICKUP]
    return (raw_trips(spark, d).groupBy(F.to_date(rawsrc.PICKUP))
            .agg(F.min(rawsrc.PICKUP).alias(rawsrc.PICKUP), *[F.max(c).alias(c) for c in rest])
            .select(*TRIP_CONTRACT.column_names))


def _run_summary(spark, d):
    raw = raw_trips(spark, d)
    clean = clean_trips(spark, d, STRICT)
    status = val.summary(val.validate(raw), DATASET)
    cleaned = clean.agg(F.count(F.lit(1)).alias("clean_rows"),
                        avg_fixed("fare_amount", 2, 2).alias("avg_fare"))
    loaded = tbl.load_counts(_reloaded(spark, d), PINNED_DAY)
    # each step's metric is a scalar subquery of that step's own plan
    return raw.agg(F.count(F.lit(1)).alias("raw_rows")).select(
        "raw_rows",
        cleaned.select("clean_rows").scalar().alias("clean_rows"),
        cleaned.select("avg_fare").scalar().alias("avg_fare"),
        status.select("status").scalar().alias("validation_status"),
        status.select("warning_count").scalar().alias("validation_warnings"),
        loaded.select("loaded_rows").scalar().alias("loaded_rows"))


_MORE: dict[str, Query] = {
    # D4
    "run_summary": _run_summary,
    # F. load
    "idempotent_reload": _reloaded,
    "load_counts": lambda s, d: tbl.load_counts(_reloaded(s, d), PINNED_DAY),
    # H. validation
    "validate": lambda s, d: val.validate(raw_trips(s, d)),
    "validate_faulty": lambda s, d: val.validate(rawsrc.as_text(_faulty(s, d))),
    "validate_text_extremes": lambda s, d: val.validate(rawsrc.as_text(_extreme(s, d))),
    "validation_reports": _reports,
    "gate_by_date": lambda s, d: val.verdicts(raw_trips(s, d), F.to_date(rawsrc.PICKUP)),
    "gate_by_date_faulty": lambda s, d: val.verdicts(_faulty(s, d), F.to_date(rawsrc.PICKUP)),
    "validate_too_few": lambda s, d: val.validate(_per_date(s, d)),
    "null_fractions": lambda s, d: val.null_fractions(raw_trips(s, d)),
    "range_violations": lambda s, d: val.range_violations(raw_trips(s, d)),
    "allowed_values": lambda s, d: val.allowed_values(raw_trips(s, d)),
    "duplicate_fraction": lambda s, d: val.duplicate_fraction(raw_trips(s, d)),
    "quality_rules": lambda s, d: val.quality_rules(raw_trips(s, d)),
    "validation_summary": lambda s, d: val.summary(val.validate(raw_trips(s, d)), DATASET),
    # K. dead letter, audit, freshness
    "dead_letter": _dead_letter,
    "reject_reason_counts": lambda s, d: reject_reason_counts(_dead(s, d)),
    "fresh_dates": _fresh_dates,
    "audit_latest": lambda s, d: aud.audit_latest(derived_audit(s, d)),
}



def queries() -> dict[str, Query]:
    reg = _core_queries()
    reg.update(_MORE)
    reg.update(lake.queries())
    return reg
