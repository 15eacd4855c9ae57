from decimal import ROUND_FLOOR, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.functions.exact import avg_fixed, avg_ratio, pct, round_half_up, sum_fixed


def _half_up(x: Decimal, n: int) -> float:
    """floor(x * 10^n + 0.5) / 10^n in exact decimal arithmetic (ties go up,
    also for negative values: the documented rounding rule)."""
    scaled = (x.scaleb(n) + Decimal("0.5")).to_integral_value(rounding=ROUND_FLOOR)
    return float(scaled.scaleb(-n))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-100000, max_value=100000), min_size=1, max_size=60))
def test_avg_fixed_is_exact_mean_of_cents(spark, cents):
    df = spark.createDataFrame([(c / 100.0,) for c in cents], "x double")
    got = df.agg(avg_fixed("x", 2, 2).alias("a"), sum_fixed("x", 2).alias("s")).first()
    mean = Decimal(sum(cents)) / Decimal(len(cents)) / 100
    assert got.a == _half_up(mean, 2) or abs(got.a - _half_up(mean, 2)) < 1e-9
    assert got.s == sum(cents) / 100.0


def test_independent_of_partitioning(spark, sf0001):
    from tripflow.plans.trips import taxi_trips
    t = taxi_trips(spark, sf0001)
    aggs = [avg_fixed("fare_amount", 2, 2).alias("f"), avg_ratio("tip_pct", 2).alias("t"),
            avg_ratio("avg_speed_mph", 1).alias("s"), sum_fixed("total_amount", 2).alias("r")]
    a = t.repartition(1).agg(*aggs).first()
    b = t.repartition(7, "pickup_hour").agg(*aggs).first()
    assert a == b


def test_round_half_up_and_pct(spark):
    row = spark.range(1).select(round_half_up(F.lit(2.125), 2).alias("r"),
                                pct(F.lit(1), F.lit(8), 1).alias("p"),
                                pct(F.lit(1), F.lit(0), 1).alias("z")).first()
    assert row.r == 2.13 and row.p == 12.5 and row.z is None
