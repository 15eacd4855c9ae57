"""Queries over layers that Spark writes from the given tables: versioned loads,
the raw CSV layer, the choice of sources, and catalog tables read by SQL text.

Each call writes into a folder of its own under the session's
``spark.checkpoint.dir`` and returns a plan over what it wrote; the catalog
tables are kept for the next report over the same input.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.contract import PINNED_DAY, RAW_TEXT_SCHEMA, STRICT, TAXI_TRIPS_SCHEMA, TRIP_CONTRACT
from tripflow.operators import daily_stats as stats
from tripflow.operators import dimension
from tripflow.operators import snapshots as snap
from tripflow.plans import report_sql
from tripflow.plans.pipeline import build_facts
from tripflow.plans.staged import input_signature, staged
from tripflow.plans.trips import (TRIP_INPUTS, ZONE_INPUTS, daily_fact, featured_trips, raw_trips, source_paths,
                                  taxi_trips, zones)
from tripflow.session import ensure_checkpoint_dir
from tripflow.sources import raw as rawsrc
from tripflow.sources.fixture import table
from tripflow.sources.synthetic import synthetic_trips

CLEARED_DAY = "2024-01-20"
BUCKET_ROWS = 2_000_000  # trips of a bucket, which one task sorts in memory


def folder(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripflow-{what}-{uuid.uuid4().hex}"


def _load(spark: SparkSession, root: str, trips: DataFrame) -> snap.Load:
    load = snap.Load(spark, root)
    load.write("taxi_trips", trips, laid_out=True)
    for name, fact in build_facts(load.read("taxi_trips")).items():
        load.write(name, fact)
    return load


def atomic_load(spark: SparkSession, d: str) -> DataFrame:
    """F1 over trips and facts together: a load of all dates, one of the pinned
    day's rows twice that is abandoned before its commit, a reload of the pinned
    day and one of a day without rows; the tables' rows and trips per date."""
    root, trips = folder(spark, "lake"), taxi_trips(spark, d)
    _load(spark, root, trips).commit()
    day = trips.where(F.col("pickup_date") == F.lit(PINNED_DAY).cast("date"))
    _load(spark, root, day.unionAll(day))
    _load(spark, root, day).commit([PINNED_DAY])
    _load(spark, root, day.limit(0)).commit([CLEARED_DAY])
    tables = snap.read(spark, root)
    trips_in = {"taxi_trips": F.count(F.lit(1)), "agg_by_zone": F.sum("total_trips"),
                "agg_by_hour": F.sum("trip_count"), "agg_payment": F.sum("trips")}
    out = None
    for name, n in trips_in.items():
        one = tables[name].groupBy("pickup_date").agg(F.count(F.lit(1)).alias("n_rows"), n.alias("trips")).select(
            F.lit(name).alias("table_name"), "pickup_date", "n_rows", "trips")
        out = one if out is None else out.unionAll(one)
    return out


def write_lines(trips: DataFrame, root: str) -> None:
    """The raw CSV layer of all dates, one folder a run date, as lines of text:
    most plain, some with every field quoted, some short, some long."""
    names = TRIP_CONTRACT.column_names
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    kind = (F.col("dropoff_location_id") * 31 + F.col("payment_type") * 7 + F.coalesce("vendor_id", F.lit(0))) % 10
    line = (F.when(kind == 0, F.concat(F.lit('"'), F.concat_ws('","', *fields), F.lit('"')))
            .when(kind == 1, F.concat_ws(",", *fields[:9]))
            .when(kind == 2, F.concat_ws(",", *fields, F.lit("x"), F.lit("y")))
            .otherwise(F.concat_ws(",", *fields)))
    # one column named like the header, written as it is
    (trips.select(line.alias(",".join(names)), F.to_date(rawsrc.PICKUP).alias("run_date"))
     .write.partitionBy("run_date").option("header", True).option("sep", "\u0001").option("quote", "").csv(root))


def raw_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """A1 + A7: the raw layer written as text and scanned under its schema:
    well-formed lines typed, the others with their number of fields."""
    root = folder(spark, "raw")
    write_lines(raw_trips(spark, d), root)
    schema = T.StructType([*RAW_TEXT_SCHEMA.fields, T.StructField("run_date", T.DateType()),
                           T.StructField(rawsrc.CORRUPT, T.StringType())])
    lines, broken = rawsrc.split_corrupt(rawsrc.read_lines(spark, root, schema))
    typed = lines.select(*[rawsrc.typed(c) for c in TRIP_CONTRACT.column_names], "run_date",
                         F.lit(False).alias("corrupt"), F.lit(None).cast("int").alias("n_fields"))
    return typed.unionByName(broken.select("run_date", F.lit(True).alias("corrupt"),
                                           rawsrc.n_fields(F.col("raw_line")).alias("n_fields")),
                             allowMissingColumns=True)


def source_choice(spark: SparkSession, d: str) -> DataFrame:
    """A6 for many run dates: the monthly source where it has the date, else the
    generator; rows per date and source tag."""
    ids = table(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                                             F.date_add(F.lit("2024-01-20").cast("date"),
                                                        (F.col("l_orderkey") % 20).cast("int")).alias("day"))
    real = rawsrc.standardise_columns(rawsrc.to_source_layout(raw_trips(spark, d)))
    return rawsrc.source_summary(rawsrc.ingest_dates(real, synthetic_trips(ids, F.col("day"))))


def catalog(spark: SparkSession, d: str) -> str:
    """The catalog database of an input, created and filled on first use; its
    DDL runs every time and leaves rows alone."""
    database = f"tripflow_{input_signature(spark, source_paths(d, TRIP_INPUTS + ZONE_INPUTS))}"
    location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{database}"
    report_sql.create_tables(spark, database, location)
    for name in report_sql.CATALOG_TABLES:
        if spark.table(f"`{database}`.`{name}`").isEmpty():
            report_sql.load(taxi_trips(spark, d) if name == "taxi_trips" else daily_fact(spark, d, name), database, name,
                            laid_out=True)
    return database


def _report(name: str, spark: SparkSession, d: str) -> DataFrame:
    return report_sql.report(spark, catalog(spark, d), name)


def moments(spark: SparkSession, d: str) -> DataFrame:
    """The daily moments, staged from the trips table."""
    return staged(spark, "daily_moments", lambda: stats.daily_moments(taxi_trips(spark, d)),
                  source_paths(d, TRIP_INPUTS + ZONE_INPUTS), partition_by=["pickup_date"])


def bits(spark: SparkSession, d: str) -> DataFrame:
    """The daily bitmaps, staged from the trips table and its zone fact."""
    return staged(spark, "distinct_bits", lambda: stats.distinct_bits(
        taxi_trips(spark, d), daily_fact(spark, d, "agg_by_zone"), zones(spark, d)),
        source_paths(d, TRIP_INPUTS + ZONE_INPUTS), partition_by=["pickup_date"])


def zone_join_bucketed(spark: SparkSession, d: str, buckets: int = 8) -> DataFrame:
    """D1 + D2 for a large dimension: trips and zones stored bucketed by pickup
    location and salt, joined side by side; the dropoff join is salted too.
    There are ``buckets`` at least, and more for many trips."""
    database, key = catalog(spark, d), "pickup_location_id"
    buckets = max(buckets, math.ceil(raw_trips(spark, d).count() / BUCKET_ROWS))  # counted from the files' footers
    trips, dim = featured_trips(spark, d, STRICT), zones(spark, d)
    place = lambda name: f"{ensure_checkpoint_dir(spark).rstrip('/')}/{database}/{name}"
    tables = [f"`{database}`.`{name}`" for name in ("trips_by_pickup", "zones_by_pickup")]
    if not all(spark.catalog.tableExists(t) for t in tables):
        hot = dimension.hot_keys(trips, key)
        for table_name, side in zip(tables, (dimension.salted(trips, key, hot),
                                             dimension.replicated(dimension.role(dim, "pickup"), key, hot)), strict=True):
            dimension.store_bucketed(side, table_name, [key, dimension.SALT], buckets,
                                     place(table_name.split("`")[3]))
    left, right = (spark.table(t) for t in tables)
    once, drop = dimension.join_salted(left, right.hint("merge"), key), "dropoff_location_id"
    hot = dimension.hot_keys(trips, drop)
    both = dimension.join_salted(dimension.salted(once, drop, hot),
                                 dimension.replicated(dimension.role(dim, "dropoff"), drop, hot), drop)
    return both.select(*TAXI_TRIPS_SCHEMA.fieldNames())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"atomic_load": atomic_load, "raw_csv_scan": raw_csv_scan, "source_choice": source_choice,
            "zone_join_bucketed": zone_join_bucketed,
            "facts_pipeline_health": lambda s, d: stats.pipeline_health(moments(s, d), bits(s, d)),
            "facts_health_for_date": lambda s, d: stats.health_for_date(moments(s, d), bits(s, d), PINNED_DAY),
            "facts_fare_anomalies": lambda s, d: stats.fare_anomalies(taxi_trips(s, d), moments(s, d)),
            "facts_weekly_health": lambda s, d: stats.weekly_health(moments(s, d), bits(s, d)),
            **{f"sql_{name}": partial(_report, name) for name in report_sql.REPORTS}}
