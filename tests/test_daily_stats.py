"""Daily facts merge to what the trips give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow.operators import daily_stats as stats
from tripflow.plans import analytics as an
from tripflow.plans import lake
from tripflow.plans.trips import taxi_trips, zones


@pytest.fixture
def facts(spark, sf0001):
    return taxi_trips(spark, sf0001), lake.moments(spark, sf0001), lake.bits(spark, sf0001)


def test_reports_read_facts_only(spark, sf0001, facts):
    trips, moments, bits = facts
    assert stats.pipeline_health(moments, bits).collect() == an.pipeline_health(trips).collect()
    for day in ("2024-01-15", "2030-01-01"):
        assert stats.health_for_date(moments, bits, day).collect() == an.health_for_date(trips, day).collect()
    assert stats.fare_bounds(moments).collect() == an.fare_stats(trips).collect()
    assert stats.fare_anomalies(trips, moments).collect() == an.fare_anomalies(trips).collect()
    plan = stats.pipeline_health(moments, bits)._jdf.queryExecution().executedPlan().toString()
    assert "trip_distance" not in plan and "taxi_trips" not in plan


def test_any_dates_merge_exactly(facts):
    trips, moments, bits = facts
    for lo, hi in (("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-11"), ("2024-01-09", "2024-01-09")):
        on = F.col("pickup_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        some = trips.where(on)
        got = stats.distinct_counts(bits.where(on)).first()
        assert got.unique_locations == some.select("pickup_location_id").distinct().count()
        assert got.unique_zones == some.select(F.count_distinct("pickup_zone")).first()[0]
        assert stats.fare_bounds(moments.where(on)).collect() == an.fare_stats(some).collect()


def test_adding_a_date_adds_its_rows_only(spark, sf0001, facts):
    trips, moments, bits = facts
    last = F.col("pickup_date") == F.lit("2024-01-31").cast("date")
    parts = [stats.daily_moments(trips.where(c)) for c in (~last, last)]
    assert sorted(map(str, parts[0].unionByName(parts[1]).collect())) == sorted(map(str, moments.select(*parts[0].columns).collect()))


def test_ids_of_any_size_and_sign_and_names_without_id(spark, sf0001):
    ids = [1, 2, 32768, 32769, 65536, -1, -32768, 0, 2_000_000_000, None, 1]
    rows = [(dt.date(2024, 1, 1 + i % 2), i, f"z{i}" if i is not None and i % 3 else "unknown", None) for i in ids if i is not None]
    rows += [(dt.date(2024, 1, 1), None, None, None)]
    trips = spark.createDataFrame(rows, "pickup_date date, pickup_location_id int, pickup_zone string, pickup_borough string")
    dim = spark.createDataFrame([(i, f"z{i}", "b") for i in ids if i is not None and i % 3] + [(7, "z1", "b")],
                                "location_id int, zone_name string, borough string")
    fact = trips.groupBy("pickup_date", "pickup_zone").agg(F.count(F.lit(1)).alias("total_trips"))
    bits = stats.distinct_bits(trips, fact, dim)
    one = stats.distinct_counts(bits).first()
    assert one.unique_locations == len({i for i in ids if i is not None})
    assert one.unique_zones == trips.select(F.count_distinct("pickup_zone")).first()[0]
    by = {r["__0"]: r for r in stats.distinct_counts(bits, F.col("pickup_date")).collect()}
    for day, r in by.items():
        of = trips.where(F.col("pickup_date") == F.lit(day))
        assert r.unique_locations == of.select(F.count_distinct("pickup_location_id")).first()[0]
        assert r.unique_zones == of.select(F.count_distinct("pickup_zone")).first()[0]
    empty = stats.distinct_counts(bits.limit(0)).first()
    assert (empty.unique_locations, empty.unique_zones) == (0, 0)
