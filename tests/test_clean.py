import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import trips_df
from tripflow.operators.clean import (filter_rows, filter_stats, reject_reason_counts,
                                      row_gate, row_gate_by_date, split_clean_dead)

PICK = dt.datetime(2024, 1, 15, 10, 0, 0)


@pytest.mark.parametrize("value,kept", [(0.0, False), (0.009, False), (0.01, True),
                                        (500.0, True), (500.01, False), (None, False)])
def test_strict_distance_bounds(spark, value, kept):
    df = trips_df(spark, [dict(trip_distance=value)])
    assert filter_rows(df, "strict").count() == int(kept)


@pytest.mark.parametrize("value,kept", [(-0.01, False), (0.0, True), (1000.0, True),
                                        (1000.01, False)])
def test_strict_fare_bounds(spark, value, kept):
    df = trips_df(spark, [dict(fare_amount=value)])
    assert filter_rows(df, "strict").count() == int(kept)


@pytest.mark.parametrize("value,kept", [(0, False), (1, True), (9, True), (10, False),
                                        (None, False)])
def test_strict_passenger_bounds(spark, value, kept):
    df = trips_df(spark, [dict(passenger_count=value)])
    assert filter_rows(df, "strict").count() == int(kept)


def test_strict_vendor_total_and_order(spark):
    df = trips_df(spark, [dict(vendor_id=6), dict(total_amount=-0.01),
                          dict(tpep_dropoff_datetime=PICK), dict()])
    assert filter_rows(df, "strict").count() == 1


def test_batch_profile_treats_null_as_zero(spark):
    df = trips_df(spark, [dict(fare_amount=0.0), dict(fare_amount=None), dict(passenger_count=None),
                          dict(trip_distance=None), dict(vendor_id=6, fare_amount=2000.0),
                          dict(tpep_pickup_datetime=None)])
    # vendor 6 and an uncapped fare pass in batch, everything else is removed
    assert filter_rows(df, "batch").count() == 1
    # strict keeps the zero fare (inclusive range) and drops vendor 6 / fare 2000
    assert [r.fare_amount for r in filter_rows(df, "strict").collect()] == [0.0]


def test_clean_plus_dead_is_raw_and_disjoint(spark, sf0001):
    from tripflow.plans.trips import raw_trips
    raw = raw_trips(spark, sf0001)
    clean, dead = split_clean_dead(raw, "strict")
    assert clean.count() == 4275
    assert clean.count() + dead.count() == raw.count()
    assert dead.where(F.size("reject_reasons") == 0).count() == 0
    reasons = {r["reason"] for r in reject_reason_counts(dead).collect()}
    assert "known_vendor" in reasons and "fare_in_range" in reasons


def test_filter_stats(spark, sf0001):
    from tripflow.plans.trips import raw_trips
    row = filter_stats(raw_trips(spark, sf0001), "batch").first()
    assert (row.rows_before, row.rows_after) == (6000, 4368)
    assert row.rows_removed == 1632 and row.removed_pct == 27.2


def test_row_gate(spark):
    df = trips_df(spark, [dict()] * 99)
    assert not row_gate(df, 100)
    assert row_gate(df.union(trips_df(spark, [dict()])), 100)
    by_date = row_gate_by_date(df).first()
    assert by_date.raw_rows == 99 and by_date.proceed is False
