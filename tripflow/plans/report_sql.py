"""The tables in the catalog and the reports as SQL text over them.

The DDL is ``CREATE TABLE IF NOT EXISTS``: running it again changes nothing.
Tables are Parquet, partitioned by ``pickup_date``, at places of the caller's
choice; rows go in with a dynamic partition overwrite, which also enters the
partitions in the catalog, so SQL prunes them like the DataFrame plans do.

The seven reports are plain SQL for ``spark.sql``; rounding and averages follow
``functions/exact.py``: units are added as integers, then rounded half up.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from tripflow.contract import ANOMALY_SIGMAS, TABLE_SCHEMAS
from tripflow.files import small_splits
from tripflow.operators.tables import DATE_COL

CATALOG_TABLES = ("taxi_trips", "agg_by_zone", "agg_by_hour", "agg_payment")


def ddl(name: str, database: str, location: str) -> str:
    """The statement that creates a table where it does not exist yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLE_SCHEMAS[name].fields)
    return (f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
            f"PARTITIONED BY ({DATE_COL}) LOCATION '{location}/{name}'")


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """The database and its tables; safe to run again."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}/{database}'")
    for name in CATALOG_TABLES:
        spark.sql(ddl(name, database, location))


def load(df: DataFrame, database: str, name: str, laid_out: bool = False) -> None:
    """Replace the dates that ``df`` brings; the others stay.  Rows scanned from
    a table partitioned by date (``laid_out``) are not shuffled again."""
    spark = df.sparkSession
    columns = spark.table(f"`{database}`.`{name}`").columns
    rows = df.select(*columns)
    with small_splits(spark) if laid_out else nullcontext():
        ((rows if laid_out else rows.hint("rebalance", DATE_COL)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").insertInto(f"`{database}`.`{name}`"))


def report(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A report over the catalog tables of a database."""
    tables = {t: f"`{database}`.`{t}`" for t in CATALOG_TABLES}
    return spark.sql(REPORTS[name].format(**tables))


def _mean(x: str, digits: int, out: int) -> str:
    """Average of a value with ``digits`` decimals, half up to ``out`` of them."""
    scale = f"/ 1e{digits - out}D" if digits >= out else f"* 1e{out - digits}D"
    return (f"floor(cast(sum(cast(round({x} * 1e{digits}D) AS BIGINT)) AS DOUBLE) / nullif(count({x}), 0) {scale} "
            f"+ 0.5D) / 1e{out}D")


def _ratio(x: str, out: int) -> str:
    """Average of any double in steps of 1e-6, half up to ``out`` decimals."""
    return (f"floor(cast(sum(cast(floor({x} * 1e6D + 0.5D) AS DECIMAL(38,0))) AS DOUBLE) / nullif(count({x}), 0) "
            f"/ 1e{6 - out}D + 0.5D) / 1e{out}D")


def _total(x: str, digits: int = 2) -> str:
    return f"cast(sum(cast(round({x} * 1e{digits}D) AS BIGINT)) AS DOUBLE) / 1e{digits}D"


def _share(part: str, whole: str, out: int = 1) -> str:
    return f"floor({part} * 100D / nullif({whole}, 0) * 1e{out}D + 0.5D) / 1e{out}D"


_CENTS = "cast(round(fare_amount * 100D) AS BIGINT)"

REPORTS = {
    "top_zones": f"""
        SELECT pickup_zone, pickup_borough, sum(total_trips) AS total_trips,
               {_total('total_revenue')} AS total_revenue, {_mean('avg_fare', 2, 2)} AS avg_fare
        FROM {{agg_by_zone}}
        GROUP BY pickup_zone, pickup_borough
        ORDER BY total_trips DESC, pickup_zone NULLS LAST, pickup_borough NULLS LAST
        LIMIT 10""",
    "hourly_heatmap": f"""
        SELECT pickup_hour, time_of_day, sum(trip_count) AS trips, {_mean('avg_fare', 2, 2)} AS avg_fare,
               {_share('sum(trip_count)', '(SELECT sum(trip_count) FROM {agg_by_hour})')} AS pct_of_daily_trips
        FROM {{agg_by_hour}}
        GROUP BY pickup_hour, time_of_day
        ORDER BY pickup_hour""",
    "payment_share": f"""
        SELECT payment_label, sum(trips) AS total_trips, {_mean('avg_tip_pct', 2, 2)} AS avg_tip_pct,
               {_share('sum(trips)', '(SELECT sum(trips) FROM {agg_payment})')} AS market_share_pct
        FROM {{agg_payment}}
        GROUP BY payment_label
        ORDER BY total_trips DESC, payment_label""",
    "borough_leaderboard": f"""
        SELECT pickup_borough, sum(total_trips) AS total_trips, {_total('total_revenue')} AS total_revenue,
               {_mean('avg_fare', 2, 2)} AS avg_fare, {_mean('avg_distance_mi', 2, 2)} AS avg_distance_mi,
               {_mean('avg_speed_mph', 1, 1)} AS avg_speed_mph
        FROM {{agg_by_zone}}
        WHERE pickup_borough IS NOT NULL
        GROUP BY pickup_borough
        ORDER BY total_revenue DESC, pickup_borough""",
    "distance_split": f"""
        SELECT CASE WHEN trip_distance < 1 THEN 'under_1mi' WHEN trip_distance < 3 THEN '1_to_3mi'
                    WHEN trip_distance < 10 THEN '3_to_10mi' ELSE 'over_10mi' END AS distance_bucket,
               count(*) AS trips, {_mean('fare_amount', 2, 2)} AS avg_fare, {_ratio('tip_pct', 2)} AS avg_tip_pct,
               {_ratio('trip_duration_min', 1)} AS avg_duration_min
        FROM {{taxi_trips}}
        GROUP BY distance_bucket
        ORDER BY min(trip_distance) NULLS LAST""",
    "fare_anomalies": f"""
        WITH moments AS (
            SELECT cast(count(fare_amount) AS DOUBLE) AS n, cast(sum({_CENTS}) AS DOUBLE) AS s1,
                   cast(sum(cast({_CENTS} AS DECIMAL(38,0)) * cast({_CENTS} AS DECIMAL(38,0))) AS DOUBLE) AS s2
            FROM {{taxi_trips}}),
        stats AS (
            SELECT s1 / n / 100D AS mean_fare, sqrt((s2 - s1 * s1 / n) / nullif(n - 1D, 0D)) / 100D AS std_fare
            FROM moments)
        SELECT tpep_pickup_datetime, pickup_zone, dropoff_zone, trip_distance, fare_amount, total_amount,
               floor((fare_amount - (SELECT mean_fare FROM stats)) / (SELECT std_fare FROM stats) * 100D + 0.5D) / 100D
               AS z_score
        FROM {{taxi_trips}}
        WHERE fare_amount > (SELECT mean_fare FROM stats) + {ANOMALY_SIGMAS} * (SELECT std_fare FROM stats)
        ORDER BY fare_amount DESC, tpep_pickup_datetime, pickup_zone NULLS LAST, dropoff_zone NULLS LAST,
                 trip_distance, total_amount
        LIMIT 20""",
    "pipeline_health": f"""
        SELECT pickup_date, count(*) AS row_count, {_mean('fare_amount', 2, 2)} AS avg_fare,
               min(tpep_pickup_datetime) AS earliest_pickup, max(tpep_pickup_datetime) AS latest_pickup,
               count(DISTINCT pickup_zone) AS unique_zones, count_if(fare_amount <= 0) AS zero_fare_count
        FROM {{taxi_trips}}
        GROUP BY pickup_date
        ORDER BY pickup_date DESC""",
}
