from pyspark.sql import functions as F

from tripflow.operators.clean import filter_rows
from tripflow.plans import pipeline
from tripflow.plans.trips import raw_trips, zones
from tripflow.sources import raw as rawsrc
from tripflow.streaming import landing

RUN = "2024-01-15"


def _source(spark, sf0001, tmp_path):
    src = str(tmp_path / "monthly")
    rawsrc.to_source_layout(raw_trips(spark, sf0001)).write.parquet(src)
    zpath = str(tmp_path / "zones.csv")
    (zones(spark, sf0001).select(F.col("location_id").alias("LocationID"),
                                 F.col("borough").alias("Borough"), F.col("zone_name").alias("Zone"))
     .coalesce(1).write.option("header", True).csv(zpath))
    return src, zpath


def test_daily_run_is_idempotent(spark, sf0001, tmp_path):
    src, zpath = _source(spark, sf0001, tmp_path)
    layout = pipeline.Layout(str(tmp_path / "lake"))
    m1 = pipeline.run(spark, RUN, layout, src, zpath)
    m2 = pipeline.run(spark, RUN, layout, src, zpath)
    assert m1["status"] == m2["status"] == "success" and m1["source"] == "real"
    assert m1["validation_status"] == "WARNED"
    day_rows = rawsrc.day_slice(raw_trips(spark, sf0001), RUN).count()
    assert m1["raw_row_count"] == day_rows
    assert m1["loaded_rows"] == m2["loaded_rows"] == m2["total_rows"]
    trips = spark.read.parquet(layout.path("taxi_trips"))
    hours = spark.read.parquet(layout.path("agg_by_hour"))
    zone = spark.read.parquet(layout.path("agg_by_zone"))
    n = trips.count()
    assert hours.agg(F.sum("trip_count")).first()[0] == n == zone.agg(F.sum("total_trips")).first()[0]
    heat = pipeline.analytics(spark, layout, RUN)["hourly_heatmap"]
    assert abs(heat.agg(F.sum("pct_of_daily_trips")).first()[0] - 100) < 1.5
    rs = pipeline.run_summary(spark, layout, RUN).first()
    assert rs.status == "success" and rs.loaded_rows == n
    runs = spark.read.parquet(layout.path("pipeline_runs"))
    assert runs.count() == 2
    dead = spark.read.parquet(layout.path("dead_letter"))
    assert dead.count() + n == m1["raw_row_count"]
    # the same tables answer SQL by name
    assert set(pipeline.register_views(spark, layout)) == set(pipeline.TABLES)
    by_sql = spark.sql(
        "SELECT pickup_borough, SUM(total_trips) AS total_trips FROM agg_by_zone "
        "WHERE pickup_borough IS NOT NULL GROUP BY pickup_borough").collect()
    board = pipeline.analytics(spark, layout, RUN)["borough_leaderboard"].collect()
    assert {(r.pickup_borough, r.total_trips) for r in by_sql} == \
        {(r.pickup_borough, r.total_trips) for r in board}
    day = spark.sql(f"SELECT COUNT(*) AS n FROM taxi_trips WHERE pickup_date = DATE'{RUN}'")
    assert day.first().n == m1["loaded_rows"]


def test_synthetic_fallback_without_zones(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    m = pipeline.run(spark, "2026-06-29", layout, None, None, synthetic_rows=1000)
    assert m["source"] == "synthetic" and m["status"] == "success"
    top = pipeline.analytics(spark, layout, "2026-06-29")["top_zones"].first()
    assert top.pickup_zone == "unknown" and top.pickup_borough is None


def test_gate_skips_small_run(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    m = pipeline.run(spark, "2026-06-29", layout, None, None, synthetic_rows=150, min_rows=200)
    assert m["status"] == "skipped"


def test_landing_stream_replays_idempotently(spark, sf0001, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    trips = raw_trips(spark, sf0001)
    for day in ("2024-01-14", "2024-01-15"):
        rawsrc.write_raw_csv(rawsrc.day_slice(trips, day), layout.raw, day)
    q = landing.start(spark, layout, str(tmp_path / "ckpt"))
    q.awaitTermination()
    loaded = spark.read.parquet(layout.path("taxi_trips"))
    first = loaded.count()
    assert first > 0
    # a fresh checkpoint replays every file: the tables do not change
    q2 = landing.start(spark, layout, str(tmp_path / "ckpt2"))
    q2.awaitTermination()
    assert spark.read.parquet(layout.path("taxi_trips")).count() == first
    hours = spark.read.parquet(layout.path("agg_by_hour"))
    assert hours.agg(F.sum("trip_count")).first()[0] == first
    dead = spark.read.parquet(layout.path("dead_letter"))
    days = rawsrc.day_slice(trips, "2024-01-14").count() + rawsrc.day_slice(trips, "2024-01-15").count()
    assert dead.count() + first == days
    assert spark.read.parquet(layout.path("pipeline_runs")).count() == 4


def test_batch_profile_outputs(spark, sf0001, tmp_path):
    out = str(tmp_path / "batch")
    summary = pipeline.run_batch_profile(spark, raw_trips(spark, sf0001), out).first()
    trips = spark.read.parquet(f"{out}/trips")
    assert trips.count() == summary.clean_row_count == 4368
    assert summary.removed_rows == 6000 - 4368
    hours = spark.read.parquet(f"{out}/agg_by_hour")
    assert hours.agg(F.sum("trip_count")).first()[0] == 4368
    zone = spark.read.parquet(f"{out}/agg_by_zone")
    assert zone.agg(F.sum("total_trips")).first()[0] == 4368
    assert dict(trips.dtypes)["pickup_date"] == "string"


def _csv(df, layout, day):
    rawsrc.write_raw_csv(df, layout.raw, day)


def _process(spark, layout, day):
    with pipeline.audited(spark, day, layout) as m:
        pipeline.process(spark, day, layout, None, 100, m)
    return m


def test_run_loads_its_own_date(spark, sf0001, tmp_path):
    src, zpath = _source(spark, sf0001, tmp_path)
    m = pipeline.run(spark, "2024-01-20", pipeline.Layout(str(tmp_path / "lake")), src, zpath)
    assert m["status"] == "success" and m["loaded_rows"] == m["clean_row_count"] > 0


def test_stray_rows_leave_other_dates_alone(spark, sf0001, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    trips = raw_trips(spark, sf0001)
    first, second = (rawsrc.day_slice(trips, d) for d in ("2024-01-15", "2024-01-16"))
    _csv(first, layout, "2024-01-15")
    n = _process(spark, layout, "2024-01-15")["loaded_rows"]
    stray = filter_rows(first).limit(1)
    _csv(second.unionByName(stray), layout, "2024-01-16")
    m = _process(spark, layout, "2024-01-16")
    assert m["total_rows"] == n + m["loaded_rows"]
    dead = spark.read.parquet(layout.path("dead_letter"))
    assert dead.where(F.array_contains("reject_reasons", "other_date")).count() == 1


def test_first_run_with_every_row_rejected(spark, sf0001, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    day = rawsrc.day_slice(raw_trips(spark, sf0001), RUN).withColumn("fare_amount", F.lit(-1.0))
    _csv(day, layout, RUN)
    m = _process(spark, layout, RUN)
    assert m["status"] == "success" and m["loaded_rows"] == m["total_rows"] == 0
    assert pipeline.analytics(spark, layout, RUN)["top_zones"].count() == 0
    pipeline.register_views(spark, layout)
    assert spark.sql("SELECT * FROM agg_by_hour").count() == 0


def test_bad_numbers_neither_crash_nor_count(spark, sf0001, tmp_path):
    day = rawsrc.day_slice(raw_trips(spark, sf0001), RUN)
    text = rawsrc.as_text(day)
    numeric = [c for c, t in day.dtypes if t in ("int", "double")]
    one = rawsrc.as_text(filter_rows(day)).limit(1)
    bad = one.limit(0)
    for value in ("NaN", "Infinity", "-Infinity", "abc", "1e300"):
        for c in numeric:
            bad = bad.unionByName(one.withColumn(c, F.lit(value)))
    layout = pipeline.Layout(str(tmp_path / "lake"))
    text.unionByName(bad).write.option("header", True).csv(f"{layout.raw}/run_date={RUN}")
    m = _process(spark, layout, RUN)
    assert m["status"] == "success"
    for name in ("agg_by_zone", "agg_by_hour", "agg_payment"):
        table = spark.read.parquet(layout.path(name))
        for c, t in table.dtypes:
            if t == "double":
                assert table.where(F.abs(F.col(c)) > 1e7).count() == 0
    pipeline.run_batch_profile(spark, spark.read.parquet(layout.staging(RUN)), str(tmp_path / "batch")).collect()
