import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tripflow.contract import RAW_TRIPS_SCHEMA

BASE = dict(vendor_id=1, tpep_pickup_datetime=dt.datetime(2024, 1, 15, 10, 0, 0),
            tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 10, 20, 0), passenger_count=1,
            trip_distance=3.0, rate_code_id=1, fare_amount=15.0, tip_amount=3.0,
            total_amount=20.0, payment_type=1, pickup_location_id=1, dropoff_location_id=2)


def trip(**kw) -> tuple:
    row = dict(BASE)
    row.update(kw)
    return tuple(row[f.name] for f in RAW_TRIPS_SCHEMA.fields)


def trips_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([trip(**r) for r in rows], RAW_TRIPS_SCHEMA)
