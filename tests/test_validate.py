import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import trips_df
from tripflow.contract import TRIP_CONTRACT, QualityRule
from tripflow.operators import validate as val
from tripflow.plans.trips import raw_trips


def _findings(df, contract=TRIP_CONTRACT):
    return {(r.check, r.column): r for r in val.validate(df, contract).collect()}


def test_report_messages_match_reference_texts(spark):
    p = dt.datetime(2024, 1, 15, 10, 0, 0)
    rows = ([dict()] * 100 + [dict(fare_amount=-1.0, total_amount=-0.5)] * 3
            + [dict(tip_amount=-1.0)] * 2 + [dict(vendor_id=6)]
            + [dict(tpep_dropoff_datetime=p)] * 4)
    f = _findings(trips_df(spark, rows))
    assert f[("min_value", "fare_amount")].message == "3 rows below min 0.0 in 'fare_amount'"
    assert f[("min_value", "fare_amount")].violation_count == 3
    assert f[("min_value", "tip_amount")].message == "2 rows below min 0.0 in 'tip_amount'"
    assert f[("allowed_values", "vendor_id")].message == "Unexpected values in 'vendor_id': [6]"
    assert f[("dropoff_after_pickup", None)].message == \
        "Rule 'dropoff_after_pickup' violated by 4 rows"
    # -0.5 >= -1 + 3 - 0.01 is false for the three negative-fare rows only
    assert f[("total_gte_fare_plus_tip", None)].violation_count == 3
    assert all(r.severity == "warning" for r in f.values())
    summary = val.summary(val.validate(trips_df(spark, rows)), "x").first()
    # the 100 identical base rows also trip the duplicate check
    assert f[("duplicate_fraction", None)].severity == "warning"
    assert (summary.status, summary.error_count, summary.warning_count) == ("WARNED", 0, 7)


def test_min_row_count_boundary(spark):
    f99 = _findings(trips_df(spark, [dict()] * 99))
    assert f99[("min_row_count", None)].message == "Dataset has 99 rows — below minimum 100"
    assert f99[("min_row_count", None)].severity == "error"
    assert ("min_row_count", None) not in _findings(trips_df(spark, [dict()] * 100))


def test_not_nullable_and_null_threshold(spark):
    rows = [dict()] * 84 + [dict(passenger_count=None)] * 16
    f = _findings(trips_df(spark, rows + [dict(tpep_pickup_datetime=None)]))
    assert f[("not_nullable", "tpep_pickup_datetime")].message == \
        "'tpep_pickup_datetime' must not be null — 1.0% nulls found"
    assert f[("not_nullable", "tpep_pickup_datetime")].severity == "error"
    # 16/101 = 15.8% > 15 % -> warning; 15 of 100 = 15 % is not above the threshold
    assert f[("high_null_fraction", "passenger_count")].message == \
        "'passenger_count' has 15.8% nulls (threshold 15%)"
    f15 = _findings(trips_df(spark, [dict()] * 85 + [dict(passenger_count=None)] * 15))
    assert ("high_null_fraction", "passenger_count") not in f15
    summary = val.summary(val.validate(trips_df(spark, rows + [dict(tpep_pickup_datetime=None)])),
                          "x")
    assert summary.first().status == "FAILED"
    with pytest.raises(val.ValidationFailed):
        val.assert_valid(summary)


def test_missing_column_and_unresolvable_rule(spark):
    df = trips_df(spark, [dict()] * 100).drop("rate_code_id", "tip_amount")
    contract = TRIP_CONTRACT.__class__(**{**TRIP_CONTRACT.__dict__, "rules": TRIP_CONTRACT.rules + (
        QualityRule("unknown_col", "no_such_column > 0", "error"),)})
    f = _findings(df, contract)
    assert f[("column_exists", "rate_code_id")].message == "Required column 'rate_code_id' is missing"
    assert ("column_exists", "tip_amount") in f
    assert ("unknown_col", None) not in f  # skipped, like the reference
    # the total rule names tip_amount, which is missing -> skipped as well
    assert ("total_gte_fare_plus_tip", None) not in f


def test_rule_over_nulls_counts_as_violated(spark):
    f = _findings(trips_df(spark, [dict()] * 100 + [dict(total_amount=None)]))
    assert f[("total_gte_fare_plus_tip", None)].violation_count == 1


def test_duplicates_variant(spark, sf0001):
    trips = raw_trips(spark, sf0001)
    variant = trips.unionAll(trips.where(F.col("pickup_location_id") % 10 == 0))
    row = val.duplicate_fraction(variant).first()
    assert round(row.duplicate_fraction, 4) == 0.0833
    f = _findings(variant)
    assert f[("duplicate_fraction", None)].message == \
        "Duplicate fraction 8.33% exceeds threshold 5%"


def test_fixture_findings_sf0001(spark, sf0001):
    f = _findings(raw_trips(spark, sf0001))
    assert f[("min_value", "fare_amount")].violation_count == 92
    assert f[("min_value", "tip_amount")].violation_count == 56
    assert f[("min_value", "total_amount")].violation_count == 93
    assert f[("max_value", "fare_amount")].violation_count == 28
    assert f[("dropoff_after_pickup", None)].violation_count == 97
    assert f[("total_gte_fare_plus_tip", None)].violation_count == 111


def test_report_sink(spark, sf0001, tmp_path):
    findings = val.validate(raw_trips(spark, sf0001))
    val.write_report(val.report(findings, "trips"), str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report")).first()
    assert back.status == "WARNED" and back.schema_version == "1.0"
    assert len(back.warnings) == back.warning_count and back.errors == []
    assert back.report_path == str(tmp_path / "report") and back.dataset == "trips"
    assert back.validated_at is not None


def test_duplicate_count_equals_distinct(spark, sf0001):
    trips = raw_trips(spark, sf0001)
    variant = trips.unionAll(trips.where(F.col("pickup_location_id") % 10 == 0)) \
        .unionAll(trips.limit(7)).unionAll(trips.limit(7))
    got = val.duplicate_rows(variant).first()
    assert got.duplicate_rows + got.distinct_rows == variant.count()
    assert got.distinct_rows == trips.distinct().count()


def test_duplicate_count_with_a_hot_group_of_copies(spark, sf0001):
    """A third of all rows are copies of one row: they are counted
    exactly (partial aggregation combines the copies before the shuffle)."""
    trips = raw_trips(spark, sf0001)
    n = trips.count()
    one = trips.orderBy("tpep_pickup_datetime", "fare_amount", "pickup_location_id").limit(1)
    copies = one.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("_k")
    hot = trips.unionAll(copies)
    got = val.duplicate_rows(hot).first()
    base = val.duplicate_rows(trips).first()
    assert got.duplicate_rows == base.duplicate_rows + n // 2
    assert got.distinct_rows == base.distinct_rows


def _text(spark, rows):
    base = {"vendor_id": "1", "tpep_pickup_datetime": "2024-01-15 10:00:00",
            "tpep_dropoff_datetime": "2024-01-15 10:20:00", "passenger_count": "1", "trip_distance": "3.0",
            "rate_code_id": "1", "fare_amount": "15.0", "tip_amount": "3.0", "total_amount": "20.0",
            "payment_type": "1", "pickup_location_id": "1", "dropoff_location_id": "2"}
    names = list(base)
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows],
                                 ", ".join(f"{n} string" for n in names))


def test_text_layer_tells_null_from_unparsable(spark):
    names = ["vendor_id", "passenger_count", "trip_distance", "fare_amount", "tpep_pickup_datetime"]
    for bad in ("abc", "NaN", "Infinity"):
        text = _text(spark, [{}] * 120 + [{n: bad} for n in names])
        found = _findings(text)
        assert not any(check in ("not_nullable", "high_null_fraction") for check, _ in found)
        nulls = {r.column: r.null_count for r in val.null_fractions(text).collect()}
        assert set(nulls.values()) == {0}
    found = _findings(_text(spark, [{}] * 120 + [{"tpep_pickup_datetime": None}]))
    assert found[("not_nullable", "tpep_pickup_datetime")].severity == "error"


def test_unexpected_count_is_the_true_number(spark):
    df = _text(spark, [{"vendor_id": str(v)} for v in range(1, 181)])
    row = {r.column: r for r in val.allowed_values(df).collect()}["vendor_id"]
    assert row.unexpected_count == 178
    assert row.unexpected_values == "[" + ", ".join(map(str, range(3, 13))) + "]"
    assert ("allowed_values", "vendor_id") in _findings(df)


def test_every_finding_fires(spark):
    df = _text(spark, [{"passenger_count": None}, {"passenger_count": None}, {}, {}]).drop("payment_type")
    found = _findings(df)
    assert found[("column_exists", "payment_type")].severity == "error"
    assert found[("min_row_count", None)].severity == "error"
    assert ("high_null_fraction", "passenger_count") in found and ("duplicate_fraction", None) in found
    assert val.summary(val.validate(df), "t").first().status == "FAILED"
