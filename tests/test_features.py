import datetime as dt

import pytest

from helpers import trips_df
from tripflow.operators.enrich import derive_features
from tripflow.plans.analytics import distance_split


@pytest.mark.parametrize("hour,label", [(5, "night"), (6, "morning"), (11, "morning"),
                                        (12, "afternoon"), (16, "afternoon"), (17, "evening"),
                                        (21, "evening"), (22, "night")])
def test_time_of_day(spark, hour, label):
    p = dt.datetime(2024, 1, 15, hour, 30, 0)
    df = trips_df(spark, [dict(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=5))])
    for profile in ("strict", "batch"):
        row = derive_features(df, profile).first()
        assert row.time_of_day == label and row.pickup_hour == hour


def test_payment_labels(spark):
    codes = [0, 1, 2, 3, 4, 5, None]
    df = trips_df(spark, [dict(payment_type=c) for c in codes])
    got = sorted((r.payment_type is None, r.payment_type or 0, r.payment_label)
                 for r in derive_features(df, "strict").collect())
    labels = [g[2] for g in got]
    assert labels == ["unknown", "credit_card", "cash", "no_charge", "dispute", "unknown", "unknown"]


def test_strict_duration_truncates_each_end(spark):
    p = dt.datetime(2024, 1, 15, 10, 0, 0, 900000)
    d = dt.datetime(2024, 1, 15, 10, 1, 1, 100000)
    df = trips_df(spark, [dict(tpep_pickup_datetime=p, tpep_dropoff_datetime=d, trip_distance=1.0)])
    strict = derive_features(df, "strict").first()
    assert strict.trip_duration_min == 61 / 60.0
    assert strict.avg_speed_mph == 1.0 / (61 / 60.0 / 60.0)
    batch = derive_features(df, "batch").first()
    assert batch.trip_duration_min == 1.0  # 60.2 s -> 1.0033 min -> 1.0
    assert batch.avg_speed_mph == 60.0
    assert batch.pickup_date == "2024-01-15"
    assert strict.pickup_date == dt.date(2024, 1, 15)


def test_zero_duration_and_zero_fare(spark):
    p = dt.datetime(2024, 1, 15, 10, 0, 0)
    df = trips_df(spark, [dict(tpep_pickup_datetime=p, tpep_dropoff_datetime=p, fare_amount=0.0),
                          dict(fare_amount=None, tip_amount=1.0),
                          dict(fare_amount=10.0, tip_amount=None)])
    rows = derive_features(df, "strict").collect()
    assert rows[0].avg_speed_mph is None and rows[0].tip_pct == 0.0
    assert rows[1].tip_pct == 0.0
    assert rows[2].tip_pct is None


def test_distance_buckets(spark):
    values = [0.99, 1.0, 2.99, 3.0, 9.99, 10.0, None]
    df = derive_features(trips_df(spark, [dict(trip_distance=v) for v in values]), "strict")
    got = [(r.distance_bucket, r.trips) for r in distance_split(df).collect()]
    # ordered by the bucket's shortest trip; NULL distance lands in over_10mi
    assert got == [("under_1mi", 1), ("1_to_3mi", 2), ("3_to_10mi", 2), ("over_10mi", 2)]
