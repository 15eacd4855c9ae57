"""Composable trip plans over a directory of source tables.

``raw_trips`` and ``taxi_trips`` are the two staged tables of the pipeline
(typed raw trips; cleaned, enriched, zone-joined trips partitioned by
``pickup_date``): Spark derives them from the source tables once per input
version and the queries read them, as the daily run does.  Everything else
is a lazy plan on top, so filters and column pruning reach the Parquet scan
of the staged tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contract import STRICT, TAXI_TRIPS_SCHEMA
from tripflow.operators.clean import filter_rows
from tripflow.operators.enrich import derive_features
from tripflow.operators.zones import join_zones, unique_zones
from tripflow.plans.staged import staged
from tripflow.sources.fixture import load_trips, load_zones

DAY = "staged_day"
PICKUP = "tpep_pickup_datetime"
TRIP_INPUTS = ("lineitem",)
ZONE_INPUTS = ("supplier", "nation", "region")


def source_paths(sf_dir: str, names) -> list[str]:
    return [f"{sf_dir}/{n}.parquet" for n in names]


def _staged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw trips, staged once from ``lineitem`` and partitioned by the
    pickup's date (``DAY``)."""
    def build() -> DataFrame:
        return load_trips(spark, sf_dir).withColumn(DAY, F.to_date(PICKUP))

    return staged(spark, "raw_trips", build, source_paths(sf_dir, TRIP_INPUTS), partition_by=[DAY],
                  cluster_by=[PICKUP])


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw trips."""
    return _staged_raw(spark, sf_dir).drop(DAY)


def raw_day(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """A3 on the staged raw trips: one partition is read."""
    return _staged_raw(spark, sf_dir).where(F.col(DAY) == F.lit(day).cast("date")).drop(DAY)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension, one row a location id, staged once: a table whose
    bytes the planner knows when it chooses how to join it."""
    return staged(spark, "zones", lambda: unique_zones(load_zones(spark, sf_dir)), source_paths(sf_dir, ZONE_INPUTS))


def clean_trips(spark: SparkSession, sf_dir: str, profile: str = STRICT) -> DataFrame:
    return filter_rows(raw_trips(spark, sf_dir), profile)


def featured_trips(spark: SparkSession, sf_dir: str, profile: str = STRICT) -> DataFrame:
    return derive_features(clean_trips(spark, sf_dir, profile), profile)


def enrich(clean: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Strict features + both zone joins, in the analytics table's order."""
    joined = join_zones(derive_features(clean, STRICT), zone_dim)
    return joined.select(*TAXI_TRIPS_SCHEMA.fieldNames())


def build_taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytics trips table computed from the raw layer (lazy)."""
    return enrich(clean_trips(spark, sf_dir, STRICT), zones(spark, sf_dir))


def taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytics trips table, staged and partitioned by ``pickup_date``, the
    day by which the raw trips already lie."""
    return staged(spark, "taxi_trips", lambda: build_taxi_trips(spark, sf_dir),
                  source_paths(sf_dir, TRIP_INPUTS + ZONE_INPUTS), partition_by=["pickup_date"],
                  cluster_by=["tpep_pickup_datetime"], laid_out=True)


def daily_fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A daily fact table (``agg_by_zone``, ``agg_by_hour``, ``agg_payment``)
    staged once from the trips table and partitioned by ``pickup_date``, as
    the daily run writes it: the report queries read the small facts, not
    the trips."""
    from tripflow.operators import aggregates as agg

    builders = {"agg_by_zone": agg.zone_aggregates, "agg_by_hour": agg.hourly_demand,
                "agg_payment": agg.payment_breakdown}
    return staged(spark, name, lambda: builders[name](taxi_trips(spark, sf_dir)),
                  source_paths(sf_dir, TRIP_INPUTS + ZONE_INPUTS), partition_by=["pickup_date"])
