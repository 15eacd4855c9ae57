"""DuckDB oracle SQL: an independent second implementation of every query.

The driver runs these next to the Spark queries at sf0.01 and compares row
counts, schemas and value hashes.  The SQL shares only the fixture formulas
and the contract constants with the Spark side; every operator is written
again here, by hand, as plain SQL.
"""

from __future__ import annotations

from tripflow.contract import PINNED_DAY
from tripflow.plans.report_sql import REPORTS
from tripflow.sources.fixture import EXTREME_EXPRS, FAULTY_AGAIN, FAULTY_EXPRS, duckdb_fixture_ctes

P, D = "tpep_pickup_datetime", "tpep_dropoff_datetime"


# ---- exact arithmetic, same operation order as tripflow.functions.exact ----

def r(x: str, n: int) -> str:
    return f"(floor(({x}) * 1e{n} + 0.5e0) / 1e{n})"


def avg_fixed(x: str, d: int, o: int) -> str:
    op = f"/ 1e{d - o}" if d >= o else f"* 1e{o - d}"
    return (f"(floor(CAST(sum(CAST(round(({x}) * 1e{d}) AS BIGINT)) AS DOUBLE) "
            f"/ NULLIF(count({x}), 0) {op} + 0.5e0) / 1e{o})")


def avg_ratio(x: str, o: int) -> str:
    return (f"(floor(CAST(sum(CAST(floor(({x}) * 1e6 + 0.5e0) AS DECIMAL(38,0))) AS DOUBLE) "
            f"/ NULLIF(count({x}), 0) / 1e{6 - o} + 0.5e0) / 1e{o})")


def sum_fixed(x: str, d: int) -> str:
    return f"(CAST(sum(CAST(round(({x}) * 1e{d}) AS BIGINT)) AS DOUBLE) / 1e{d})"


def pct(part: str, whole: str, o: int) -> str:
    return f"(floor(({part}) * 100e0 / NULLIF({whole}, 0) * 1e{o} + 0.5e0) / 1e{o})"


STRICT_PRED = (f"{D} > {P} AND trip_distance BETWEEN 0.01 AND 500 "
               "AND fare_amount BETWEEN 0 AND 1000 AND total_amount >= 0 "
               "AND passenger_count BETWEEN 1 AND 9 AND vendor_id IN (1, 2)")
BATCH_PRED = (f"{P} IS NOT NULL AND {D} IS NOT NULL AND {D} > {P} "
              "AND coalesce(trip_distance, 0) > 0 AND coalesce(fare_amount, 0) > 0 "
              "AND coalesce(passenger_count, 0) > 0")

TOD = (f"CASE WHEN hour({P}) BETWEEN 6 AND 11 THEN 'morning' "
       f"WHEN hour({P}) BETWEEN 12 AND 16 THEN 'afternoon' "
       f"WHEN hour({P}) BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END")
PAYLABEL = ("CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' "
            "WHEN 3 THEN 'no_charge' WHEN 4 THEN 'dispute' ELSE 'unknown' END")
STRICT_DUR = f"(date_diff('second', {P}, {D}) / 60e0)"
BATCH_DUR = r(f"date_diff('microsecond', {P}, {D}) / 6e7", 2)

RAW_COLS = ("vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
            "trip_distance, rate_code_id, fare_amount, tip_amount, total_amount, payment_type, "
            "pickup_location_id, dropoff_location_id")
TRIPS_COLS = ("vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
              "trip_distance, rate_code_id, fare_amount, tip_amount, total_amount, payment_type, "
              "payment_label, pickup_location_id, dropoff_location_id, pickup_zone, pickup_borough, "
              "dropoff_zone, dropoff_borough, trip_duration_min, avg_speed_mph, tip_pct, "
              "time_of_day, pickup_hour, pickup_date")


def _ctes() -> str:
    return f"""{duckdb_fixture_ctes()},
clean_strict AS (SELECT * FROM trips WHERE {STRICT_PRED}),
clean_batch AS (SELECT * FROM trips WHERE {BATCH_PRED}),
feat_strict0 AS (SELECT *, {STRICT_DUR} AS trip_duration_min FROM clean_strict),
feat_strict AS (SELECT *,
  CASE WHEN trip_duration_min > 0 THEN trip_distance / (trip_duration_min / 60e0) END AS avg_speed_mph,
  CASE WHEN fare_amount > 0 THEN (tip_amount / fare_amount) * 100 ELSE 0e0 END AS tip_pct,
  {TOD} AS time_of_day,
  CAST({P} AS DATE) AS pickup_date,
  CAST(hour({P}) AS INTEGER) AS pickup_hour,
  {PAYLABEL} AS payment_label
 FROM feat_strict0),
feat_batch0 AS (SELECT *, {BATCH_DUR} AS trip_duration_min FROM clean_batch),
feat_batch AS (SELECT *,
  CASE WHEN trip_duration_min > 0 THEN {r('trip_distance / (trip_duration_min / 60e0)', 2)} END AS avg_speed_mph,
  CASE WHEN fare_amount > 0 THEN {r('tip_amount / fare_amount * 100', 2)} ELSE 0e0 END AS tip_pct,
  {TOD} AS time_of_day,
  strftime({P}, '%Y-%m-%d') AS pickup_date,
  CAST(hour({P}) AS INTEGER) AS pickup_hour,
  {PAYLABEL} AS payment_label
 FROM feat_batch0),
taxi_trips AS (SELECT {TRIPS_COLS} FROM (
  SELECT f.*, pz.zone_name AS pickup_zone, pz.borough AS pickup_borough,
         dz.zone_name AS dropoff_zone, dz.borough AS dropoff_borough
  FROM feat_strict f
  LEFT JOIN zones pz ON f.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON f.dropoff_location_id = dz.location_id)),
agg_by_zone AS (SELECT pickup_date, pickup_zone, pickup_borough,
  count(*) AS total_trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('tip_pct', 2)} AS avg_tip_pct,
  {avg_ratio('trip_distance', 2)} AS avg_distance_mi,
  {avg_ratio('trip_duration_min', 1)} AS avg_duration_min,
  {avg_ratio('avg_speed_mph', 1)} AS avg_speed_mph,
  {sum_fixed('total_amount', 2)} AS total_revenue
 FROM taxi_trips GROUP BY pickup_date, pickup_zone, pickup_borough),
agg_by_hour AS (SELECT pickup_date, pickup_hour, time_of_day,
  count(*) AS trip_count,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_fixed('passenger_count', 0, 1)} AS avg_passengers
 FROM taxi_trips GROUP BY pickup_date, pickup_hour, time_of_day),
agg_payment AS (SELECT pickup_date, payment_label, trips, avg_tip_pct,
  {pct('trips', 'sum(trips) OVER ()', 1)} AS pct_of_total
 FROM (SELECT pickup_date, payment_label, count(*) AS trips,
  {avg_ratio('tip_pct', 2)} AS avg_tip_pct
  FROM taxi_trips GROUP BY pickup_date, payment_label))"""


def q(body: str) -> str:
    return f"WITH {_ctes()}\n{body}"


def _text_cast(col: str, kind: str) -> str:
    if kind == "int":
        return f"TRY_CAST(TRY_CAST(CAST({col} AS VARCHAR) AS DOUBLE) AS INTEGER) AS {col}"
    if kind == "double":
        return f"TRY_CAST(CAST({col} AS VARCHAR) AS DOUBLE) AS {col}"
    return f"TRY_CAST(CAST({col} AS VARCHAR) AS TIMESTAMP) AS {col}"


_KINDS = (("vendor_id", "int"), (P, "ts"), (D, "ts"), ("passenger_count", "int"),
          ("trip_distance", "double"), ("rate_code_id", "int"), ("fare_amount", "double"),
          ("tip_amount", "double"), ("total_amount", "double"), ("payment_type", "int"),
          ("pickup_location_id", "int"), ("dropoff_location_id", "int"))
CAST_SELECT = ", ".join(_text_cast(c, k) for c, k in _KINDS)

DAY_PRED = (f"{P} >= TIMESTAMP '{PINNED_DAY} 00:00:00' "
            f"AND {P} < TIMESTAMP '{PINNED_DAY} 00:00:00' + INTERVAL 1 DAY")


def _filter_stats(profile: str, pred: str) -> str:
    return (f"SELECT '{profile}' AS profile, rows_before, rows_after, "
            f"rows_before - rows_after AS rows_removed, "
            f"{pct('rows_before - rows_after', 'greatest(rows_before, 1)', 1)} AS removed_pct "
            f"FROM (SELECT count(*) AS rows_before, "
            f"count(*) FILTER (WHERE coalesce({pred}, false)) AS rows_after FROM trips)")


def _stats_cte() -> str:
    cents = "CAST(round(fare_amount * 1e2) AS BIGINT)"
    n = "CAST(count(fare_amount) AS DOUBLE)"
    s1 = f"CAST(sum({cents}) AS DOUBLE)"
    s2 = f"CAST(sum(CAST({cents} AS DECIMAL(38,0)) * CAST({cents} AS DECIMAL(38,0))) AS DOUBLE)"
    return (f"stats AS (SELECT {s1} / {n} / 100e0 AS mean_fare, "
            f"sqrt(({s2} - {s1} * {s1} / {n}) / NULLIF({n} - 1e0, 0e0)) / 100e0 AS std_fare "
            f"FROM taxi_trips)")


def _core_oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["cast_trips"] = q(f"SELECT {CAST_SELECT} FROM trips")
    out["cast_trips_lenient"] = out["cast_trips"]
    out["day_slice"] = q(f"SELECT {RAW_COLS} FROM trips WHERE {DAY_PRED}")
    out["standardise_columns"] = q(f"SELECT {RAW_COLS} FROM trips")
    out["ingest_summary"] = q(
        f"SELECT DATE '{PINNED_DAY}' AS run_date, 'real' AS source, count(*) AS row_count "
        f"FROM trips WHERE {DAY_PRED}")
    out["zone_lookup"] = q("SELECT location_id, zone_name, borough FROM zones")
    out["filter_strict"] = q(f"SELECT {RAW_COLS} FROM clean_strict")
    out["filter_batch"] = q(f"SELECT {RAW_COLS} FROM clean_batch")
    out["filter_stats"] = q(_filter_stats("strict", STRICT_PRED) + " UNION ALL "
                            + _filter_stats("batch", BATCH_PRED))
    out["row_gate"] = q(f"SELECT CAST({P} AS DATE) AS run_date, count(*) AS raw_rows, "
                        f"count(*) >= 100 AS proceed FROM trips GROUP BY 1")
    feat_cols = ("trip_duration_min, avg_speed_mph, tip_pct, time_of_day, pickup_date, "
                 "pickup_hour, payment_label")
    out["features_strict"] = q(f"SELECT {RAW_COLS}, {feat_cols} FROM feat_strict")
    out["features_batch"] = q(f"SELECT {RAW_COLS}, {feat_cols} FROM feat_batch")
    out["zone_fallback"] = q(
        f"SELECT {RAW_COLS}, {feat_cols}, 'unknown' AS pickup_zone, "
        f"CAST(NULL AS VARCHAR) AS pickup_borough, 'unknown' AS dropoff_zone, "
        f"CAST(NULL AS VARCHAR) AS dropoff_borough FROM feat_strict")
    out["zone_join"] = q("SELECT * FROM taxi_trips")
    out["agg_by_zone"] = q("SELECT * FROM agg_by_zone")
    out["agg_by_hour"] = q("SELECT * FROM agg_by_hour")
    out["agg_payment"] = q("SELECT * FROM agg_payment")
    out["agg_by_location"] = q(f"""SELECT pickup_date, pickup_location_id,
  count(fare_amount) AS total_trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('tip_pct', 2)} AS avg_tip_pct,
  {avg_ratio('trip_distance', 2)} AS avg_distance,
  {avg_ratio('trip_duration_min', 2)} AS avg_duration,
  {sum_fixed('total_amount', 2)} AS total_revenue
 FROM feat_batch GROUP BY pickup_date, pickup_location_id""")
    out["agg_by_hour_batch"] = q(f"""SELECT pickup_date, pickup_hour, time_of_day,
  count(fare_amount) AS trip_count,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_fixed('passenger_count', 0, 2)} AS avg_passengers
 FROM feat_batch GROUP BY pickup_date, pickup_hour, time_of_day""")
    out["transform_summary"] = q(f"""SELECT
  (SELECT count(*) FROM feat_batch) AS clean_row_count,
  (SELECT count(*) FROM trips) - (SELECT count(*) FROM feat_batch) AS removed_rows,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('trip_distance', 2)} AS avg_distance_mi,
  {avg_ratio('trip_duration_min', 2)} AS avg_duration_min,
  count(DISTINCT pickup_location_id) AS unique_zones
 FROM feat_batch""")
    # ---- analytics (G1-G11) ----
    out["top_zones"] = q(f"""SELECT pickup_zone, pickup_borough,
  CAST(sum(total_trips) AS BIGINT) AS total_trips,
  {sum_fixed('total_revenue', 2)} AS total_revenue,
  {avg_fixed('avg_fare', 2, 2)} AS avg_fare
 FROM agg_by_zone GROUP BY pickup_zone, pickup_borough
 ORDER BY total_trips DESC, pickup_zone ASC NULLS LAST, pickup_borough ASC NULLS LAST LIMIT 10""")
    out["hourly_heatmap"] = q(f"""SELECT pickup_hour, time_of_day,
  CAST(sum(trip_count) AS BIGINT) AS trips,
  {avg_fixed('avg_fare', 2, 2)} AS avg_fare,
  {pct('sum(trip_count)', 'sum(sum(trip_count)) OVER ()', 1)} AS pct_of_daily_trips
 FROM agg_by_hour GROUP BY pickup_hour, time_of_day ORDER BY pickup_hour""")
    out["payment_share"] = q(f"""SELECT payment_label,
  CAST(sum(trips) AS BIGINT) AS total_trips,
  {avg_fixed('avg_tip_pct', 2, 2)} AS avg_tip_pct,
  {pct('sum(trips)', 'sum(sum(trips)) OVER ()', 1)} AS market_share_pct
 FROM agg_payment GROUP BY payment_label ORDER BY total_trips DESC""")
    out["borough_leaderboard"] = q(f"""SELECT pickup_borough,
  CAST(sum(total_trips) AS BIGINT) AS total_trips,
  {sum_fixed('total_revenue', 2)} AS total_revenue,
  {avg_fixed('avg_fare', 2, 2)} AS avg_fare,
  {avg_fixed('avg_distance_mi', 2, 2)} AS avg_distance_mi,
  {avg_fixed('avg_speed_mph', 1, 1)} AS avg_speed_mph
 FROM agg_by_zone WHERE pickup_borough IS NOT NULL
 GROUP BY pickup_borough ORDER BY total_revenue DESC""")
    out["distance_split"] = q(f"""SELECT
  CASE WHEN trip_distance < 1 THEN 'under_1mi' WHEN trip_distance < 3 THEN '1_to_3mi'
       WHEN trip_distance < 10 THEN '3_to_10mi' ELSE 'over_10mi' END AS distance_bucket,
  count(*) AS trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('tip_pct', 2)} AS avg_tip_pct,
  {avg_ratio('trip_duration_min', 1)} AS avg_duration_min
 FROM taxi_trips GROUP BY 1 ORDER BY min(trip_distance)""")
    out["fare_anomalies"] = (
        f"WITH {_ctes()},\n{_stats_cte()}\n"
        f"""SELECT tpep_pickup_datetime, pickup_zone, dropoff_zone, trip_distance, fare_amount,
  total_amount, {r('(fare_amount - mean_fare) / std_fare', 2)} AS z_score
 FROM taxi_trips, stats WHERE fare_amount > mean_fare + 3 * std_fare
 ORDER BY fare_amount DESC, tpep_pickup_datetime, pickup_zone NULLS LAST,
  dropoff_zone NULLS LAST, trip_distance, total_amount LIMIT 20""")
    out["pipeline_health"] = q(f"""SELECT pickup_date, count(*) AS row_count,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  min({P}) AS earliest_pickup, max({P}) AS latest_pickup,
  count(DISTINCT pickup_zone) AS unique_zones,
  count(*) FILTER (WHERE fare_amount <= 0) AS zero_fare_count
 FROM taxi_trips GROUP BY pickup_date ORDER BY pickup_date DESC""")
    out["health_for_date"] = q(f"""SELECT count(*) AS "rows",
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('trip_distance', 2)} AS avg_dist_mi,
  count(DISTINCT pickup_location_id) AS unique_zones
 FROM taxi_trips WHERE pickup_date = DATE '{PINNED_DAY}'""")
    out["top_hours"] = q(f"""SELECT pickup_hour, count(*) AS trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare
 FROM taxi_trips GROUP BY pickup_hour ORDER BY trips DESC, pickup_hour LIMIT 5""")
    out["revenue_by_payment"] = q(f"""SELECT payment_label, count(*) AS trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {sum_fixed('total_amount', 2)} AS total_revenue
 FROM taxi_trips GROUP BY payment_label ORDER BY trips DESC""")
    out["time_of_day_breakdown"] = q(f"""SELECT time_of_day, count(*) AS trips,
  {avg_fixed('fare_amount', 2, 2)} AS avg_fare,
  {avg_ratio('trip_duration_min', 1)} AS avg_mins
 FROM taxi_trips GROUP BY time_of_day ORDER BY trips DESC""")
    return out


# ---- validation (H), dead letters (K2), reload (F1/F2), audit (K1/K3), D4 ----

from tripflow.contract import TRIP_CONTRACT  # noqa: E402

STRICT_CHECKS = (
    ("dropoff_after_pickup", f"{D} > {P}"),
    ("distance_in_range", "trip_distance BETWEEN 0.01 AND 500"),
    ("fare_in_range", "fare_amount BETWEEN 0 AND 1000"),
    ("total_non_negative", "total_amount >= 0"),
    ("passengers_in_range", "passenger_count BETWEEN 1 AND 9"),
    ("known_vendor", "vendor_id IN (1, 2)"),
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _bound_sql(spec, v) -> str:
    if spec.type == "timestamp":
        return f"TIMESTAMP '{v}'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def _bound_text(spec, v) -> str:
    if spec.type == "integer":
        return str(int(v))
    if spec.type == "float":
        return str(float(v))
    return str(v)


def _typed(spec) -> str:
    if spec.type == "timestamp":
        return f"TRY_CAST({spec.name} AS TIMESTAMP)"
    return f"CASE WHEN NOT isnan(TRY_CAST({spec.name} AS DOUBLE)) THEN TRY_CAST({spec.name} AS DOUBLE) END"


def _metrics_cte(src: str = "trips", missing: tuple = ()) -> str:
    parts = ["count(*) AS n_rows"]
    present = [c for c in TRIP_CONTRACT.columns if c.name not in missing]
    for c in present:
        parts.append(f"count(*) FILTER (WHERE {c.name} IS NULL) AS nulls__{c.name}")
        if c.min_value is not None:
            parts.append(f"count(*) FILTER (WHERE ({_typed(c)}) < {_bound_sql(c, c.min_value)}) "
                         f"AS below__{c.name}")
        if c.max_value is not None:
            parts.append(f"count(*) FILTER (WHERE ({_typed(c)}) > {_bound_sql(c, c.max_value)}) "
                         f"AS above__{c.name}")
    for rule in TRIP_CONTRACT.rules:
        parts.append(f"count(*) FILTER (WHERE NOT coalesce({rule.expr}, false)) "
                     f"AS rule__{rule.name}")
    cols = ", ".join(c.name for c in present)
    unexp = []
    for c in present:
        if c.allowed_values:
            allowed = ", ".join(str(v) for v in c.allowed_values)
            unexp.append(
                f"unexp__{c.name} AS (SELECT count(*) AS n_unexpected__{c.name}, "
                f"'[' || coalesce(string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FILTER (WHERE r <= 10), '') || ']' "
                f"AS unexpected__{c.name} FROM (SELECT v, row_number() OVER (ORDER BY v) AS r FROM "
                f"(SELECT DISTINCT {c.name} AS v FROM {src} "
                f"WHERE {c.name} IS NOT NULL AND {c.name} NOT IN ({allowed}))))")
    return (f"m AS (SELECT {', '.join(parts)} FROM {src}),\n"
            f"dup AS (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows, "
            f"count(*) AS distinct_rows FROM (SELECT count(*) AS c FROM {src} GROUP BY {cols})),\n"
            + ",\n".join(unexp))


def _pct_text(frac: str, n: int) -> str:
    return f"printf('%.{n}f%%', {r(f'({frac}) * 100e0', n)})"


def _findings_cte(missing: tuple = ()) -> str:
    t = TRIP_CONTRACT
    present = [c for c in t.columns if c.name not in missing]
    frm = "FROM m, dup" + "".join(f", unexp__{c.name}" for c in present if c.allowed_values)
    sel = []

    def add(fired, sev, check, column, message, vc="CAST(NULL AS BIGINT)",
            nf="CAST(NULL AS DOUBLE)"):
        col = lit(column) if column else "CAST(NULL AS VARCHAR)"
        sel.append(f"SELECT {lit(sev)} AS severity, {lit(check)} AS \"check\", {col} AS \"column\", "
                   f"{message} AS message, CAST({vc} AS BIGINT) AS violation_count, "
                   f"CAST({nf} AS DOUBLE) AS null_fraction {frm} WHERE {fired}")

    for name in missing:
        add("true", "error", "column_exists", name, lit(f"Required column '{name}' is missing"))
    add(f"n_rows < {t.min_row_count}", "error", "min_row_count", None,
        f"format('Dataset has {{:,}} rows — below minimum {t.min_row_count:,}', n_rows)")
    for c in present:
        frac = f"CAST(nulls__{c.name} AS DOUBLE) / NULLIF(n_rows, 0)"
        if not c.nullable:
            add(f"{frac} > 0", "error", "not_nullable", c.name,
                f"{lit(chr(39) + c.name + chr(39) + ' must not be null — ')} || "
                f"{_pct_text(frac, 1)} || ' nulls found'", nf=frac)
        else:
            add(f"{frac} > {t.max_null_fraction}", "warning", "high_null_fraction", c.name,
                f"{lit(chr(39) + c.name + chr(39) + ' has ')} || {_pct_text(frac, 1)} || "
                f"{lit(f' nulls (threshold {t.max_null_fraction * 100:.0f}%)')}", nf=frac)
    for c in present:
        for kind, v, word, pre in (("min_value", c.min_value, "below min", "below"),
                                   ("max_value", c.max_value, "above max", "above")):
            if v is None:
                continue
            cnt = f"{pre}__{c.name}"
            add(f"{cnt} > 0", "warning", kind, c.name,
                f"CAST({cnt} AS VARCHAR) || "
                f"{lit(f' rows {word} {_bound_text(c, v)} in ' + chr(39) + c.name + chr(39))}",
                vc=cnt)
    for c in present:
        if c.allowed_values:
            add(f"n_unexpected__{c.name} > 0", "warning", "allowed_values", c.name,
                f"{lit(f'Unexpected values in ' + chr(39) + c.name + chr(39) + ': ')} "
                f"|| unexpected__{c.name}")
    dfrac = "CAST(duplicate_rows AS DOUBLE) / NULLIF(n_rows, 0)"
    add(f"coalesce({dfrac} > {t.max_duplicate_fraction}, false)", "warning",
        "duplicate_fraction", None,
        f"'Duplicate fraction ' || {_pct_text(dfrac, 2)} || "
        f"{lit(f' exceeds threshold {t.max_duplicate_fraction * 100:.0f}%')}")
    for rule in t.rules:
        cnt = f"rule__{rule.name}"
        add(f"{cnt} > 0", "error" if rule.severity == "error" else "warning", rule.name, None,
            f"{lit(f'Rule {chr(39)}{rule.name}{chr(39)} violated by ')} || CAST({cnt} AS VARCHAR) "
            f"|| ' rows'", vc=cnt)
    return "findings AS (\n" + "\nUNION ALL\n".join(sel) + ")"


def _summary_cte() -> str:
    return ("vsum AS (SELECT CASE WHEN error_count > 0 THEN 'FAILED' WHEN warning_count > 0 "
            "THEN 'WARNED' ELSE 'PASSED' END AS status, error_count, warning_count, "
            f"'trips' AS dataset, {lit(TRIP_CONTRACT.version)} AS schema_version FROM ("
            "SELECT count(*) FILTER (WHERE severity = 'error') AS error_count, "
            "count(*) FILTER (WHERE severity = 'warning') AS warning_count FROM findings))")


def _gate_sql(name: str, rows: str, missing: tuple, *ctes: str) -> str:
    """Error and warning counts of each date, check by check."""
    t = TRIP_CONTRACT
    present = [c for c in t.columns if c.name not in missing]
    errors, warnings = [f"n_rows < {t.min_row_count}", *["true" for _ in missing]], []
    m = ["count(*) AS n_rows"]
    for c in present:
        m.append(f"count(*) FILTER (WHERE {c.name} IS NULL)::DOUBLE / count(*) AS nul_{c.name}")
        if c.nullable:
            warnings.append(f"nul_{c.name} > {t.max_null_fraction}")
        else:
            errors.append(f"nul_{c.name} > 0")
        for tag, v, op in (("lo", c.min_value, "<"), ("hi", c.max_value, ">")):
            if v is not None:
                m.append(f"count(*) FILTER (WHERE ({_typed(c)}) {op} {_bound_sql(c, v)}) AS {tag}_{c.name}")
                warnings.append(f"{tag}_{c.name} > 0")
        if c.allowed_values:
            m.append(f"count(*) FILTER (WHERE {c.name} NOT IN {tuple(c.allowed_values)}) AS odd_{c.name}")
            warnings.append(f"odd_{c.name} > 0")
    for rule in t.rules:
        m.append(f"count(*) FILTER (WHERE NOT coalesce({rule.expr}, false)) AS rule_{rule.name}")
        (errors if rule.severity == "error" else warnings).append(f"rule_{rule.name} > 0")
    cols = ", ".join(c.name for c in present)
    warnings.append(f"(n_rows - n_distinct)::DOUBLE / n_rows > {t.max_duplicate_fraction}")
    count = lambda conditions: " + ".join(f"CAST({c} AS BIGINT)" for c in conditions)
    return _wq(*ctes, f"src AS ({rows})",
               f"m AS (SELECT CAST({P} AS DATE) AS run_date, {', '.join(m)} FROM src GROUP BY 1)",
               f"u AS (SELECT run_date, count(*) AS n_distinct FROM (SELECT DISTINCT CAST({P} AS DATE) AS run_date, "
               f"{cols} FROM src) GROUP BY 1)",
               f"c AS (SELECT m.run_date, n_rows, {count(errors)} AS error_count, {count(warnings)} AS warning_count "
               f"FROM m JOIN u ON m.run_date IS NOT DISTINCT FROM u.run_date)") + (
        "SELECT run_date, n_rows, error_count, warning_count, CASE WHEN error_count > 0 THEN 'FAILED' "
        "WHEN warning_count > 0 THEN 'WARNED' ELSE 'PASSED' END AS status, error_count = 0 AS proceed FROM c")


def _reload_ctes() -> str:
    return (f"batch AS (SELECT * FROM taxi_trips WHERE pickup_date = DATE '{PINNED_DAY}'),\n"
            f"existing AS (SELECT * FROM taxi_trips UNION ALL SELECT * FROM batch),\n"
            f"reloaded AS (SELECT * FROM existing WHERE pickup_date NOT IN "
            f"(SELECT pickup_date FROM batch UNION SELECT DATE '{PINNED_DAY}') "
            f"UNION ALL SELECT * FROM batch)")


def _audit_cte() -> str:
    clean = STRICT_PRED
    return (f"per_day AS (SELECT CAST({P} AS DATE) AS execution_date, count(*) AS raw_row_count, "
            f"count(*) FILTER (WHERE coalesce({clean}, false)) AS clean_row_count "
            f"FROM trips GROUP BY 1),\n"
            f"audit AS (SELECT 'run_' || strftime(execution_date, '%Y%m%d') AS run_id, "
            f"execution_date, CAST(execution_date AS TIMESTAMP) AS started_at, "
            f"CAST(execution_date AS TIMESTAMP) + INTERVAL 1 HOUR AS completed_at, raw_row_count, "
            f"CAST(0 AS BIGINT) AS clean_row_count, 'WARNED' AS validation_status, "
            f"'failed' AS status FROM per_day\n"
            f" UNION ALL SELECT 'run_' || strftime(execution_date, '%Y%m%d'), execution_date, "
            f"CAST(execution_date AS TIMESTAMP) + INTERVAL 1 HOUR, "
            f"CAST(execution_date AS TIMESTAMP) + INTERVAL 2 HOUR, raw_row_count, "
            f"clean_row_count, 'WARNED', 'success' FROM per_day "
            f"WHERE execution_date <= DATE '{PINNED_DAY}')")


def _wq(*ctes: str) -> str:
    return f"WITH {_ctes()},\n" + ",\n".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    out = _core_oracle_sql()
    val = (_metrics_cte(), _findings_cte())
    out["validate"] = _wq(*val) + "SELECT * FROM findings"
    faulty = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in FAULTY_EXPRS) + " FROM trips"
    out["validate_faulty"] = _wq(
        f"once AS ({faulty})", f"faulty AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE {FAULTY_AGAIN})",
        _metrics_cte("faulty", ("payment_type",)), _findings_cte(("payment_type",))) + "SELECT * FROM findings"
    per_date = ", ".join(f"{'min' if c == P else 'max'}({c}) AS {c}" for c in TRIP_CONTRACT.column_names)
    out["validate_too_few"] = _wq(
        f"few AS (SELECT {per_date} FROM trips GROUP BY CAST({P} AS DATE))",
        _metrics_cte("few"), _findings_cte()) + "SELECT * FROM findings"
    extreme = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in EXTREME_EXPRS) + " FROM trips"
    out["validate_text_extremes"] = _wq(
        f"extreme AS ({extreme})", _metrics_cte("extreme"), _findings_cte()) + "SELECT * FROM findings"
    fair = f"SELECT * FROM clean_strict WHERE {TRIP_CONTRACT.rules[1].expr}"
    faulty_twice = f"SELECT * FROM once UNION ALL SELECT * FROM once WHERE {FAULTY_AGAIN}"
    reports = [("fair", (f"fair AS ({fair})",), "fair", ()), ("trips", (), "trips", ()),
               ("faulty", (f"once AS ({faulty})", f"faulty AS ({faulty_twice})"), "faulty", ("payment_type",))]
    out["validation_reports"] = "\nUNION ALL\n".join(
        "SELECT * FROM (" + _wq(*ctes, _metrics_cte(src, gone), _findings_cte(gone), _summary_cte())
        + f"SELECT {lit(name)} AS dataset, status, error_count, warning_count, severity, \"check\", \"column\", "
        "message, violation_count, null_fraction FROM vsum LEFT JOIN findings ON true)"
        for name, ctes, src, gone in reports)
    out["gate_by_date"] = _gate_sql("trips", "SELECT * FROM trips", ())
    out["gate_by_date_faulty"] = _gate_sql("faulty", faulty_twice, ("payment_type",), f"once AS ({faulty})")
    out["validation_summary"] = _wq(*val, _summary_cte()) + "SELECT * FROM vsum"
    out["null_fractions"] = _wq(_metrics_cte()) + "\nUNION ALL\n".join(
        f"SELECT {lit(c.name)} AS \"column\", {str(c.nullable).lower()} AS nullable, "
        f"nulls__{c.name} AS null_count, CAST(nulls__{c.name} AS DOUBLE) / NULLIF(n_rows, 0) "
        f"AS null_fraction FROM m" for c in TRIP_CONTRACT.columns)
    rv = []
    for c in TRIP_CONTRACT.columns:
        for kind, v, pre in (("min_value", c.min_value, "below"), ("max_value", c.max_value, "above")):
            if v is not None:
                rv.append(f"SELECT {lit(c.name)} AS \"column\", {lit(kind)} AS bound, "
                          f"{lit(_bound_text(c, v))} AS bound_value, {pre}__{c.name} "
                          f"AS violation_count FROM m")
    out["range_violations"] = _wq(_metrics_cte()) + "\nUNION ALL\n".join(rv)
    out["allowed_values"] = _wq(_metrics_cte()) + "\nUNION ALL\n".join(
        f"SELECT {lit(c.name)} AS \"column\", n_unexpected__{c.name} AS unexpected_count, "
        f"unexpected__{c.name} AS unexpected_values FROM unexp__{c.name}"
        for c in TRIP_CONTRACT.columns if c.allowed_values)
    out["duplicate_fraction"] = _wq(_metrics_cte()) + (
        "SELECT n_rows, distinct_rows, duplicate_rows, "
        "CAST(duplicate_rows AS DOUBLE) / NULLIF(n_rows, 0) AS duplicate_fraction FROM m, dup")
    out["quality_rules"] = _wq(_metrics_cte()) + "\nUNION ALL\n".join(
        f"SELECT {lit(rl.name)} AS rule, {lit(rl.severity)} AS severity, rule__{rl.name} "
        f"AS violation_count FROM m" for rl in TRIP_CONTRACT.rules)
    reasons = ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN {lit(n)} END"
                        for n, p in STRICT_CHECKS)
    out["dead_letter"] = q(f"SELECT {RAW_COLS}, concat_ws(',', {reasons}) AS reject_reasons "
                           f"FROM trips WHERE NOT coalesce({STRICT_PRED}, false)")
    out["reject_reason_counts"] = q("\nUNION ALL\n".join(
        f"SELECT {lit(n)} AS reason, count(*) AS rejected_rows FROM trips "
        f"WHERE NOT coalesce({p}, false) GROUP BY reason" for n, p in STRICT_CHECKS))
    out["idempotent_reload"] = _wq(_reload_ctes()) + "SELECT * FROM reloaded"
    load = (f"SELECT count(*) FILTER (WHERE pickup_date = DATE '{PINNED_DAY}') AS loaded_rows, "
            f"count(*) AS total_rows FROM reloaded")
    out["load_counts"] = _wq(_reload_ctes()) + load
    out["audit_latest"] = _wq(_audit_cte()) + (
        "SELECT run_id, execution_date, started_at, completed_at, raw_row_count, "
        "clean_row_count, validation_status, status FROM (SELECT *, row_number() OVER "
        "(PARTITION BY run_id ORDER BY completed_at DESC) AS rn FROM audit) WHERE rn = 1")
    out["fresh_dates"] = _wq(_audit_cte()) + (
        f"SELECT DISTINCT CAST({P} AS DATE) AS run_date FROM trips WHERE CAST({P} AS DATE) "
        f"NOT IN (SELECT execution_date FROM audit WHERE status = 'success')")
    out["run_summary"] = _wq(*val, _summary_cte(), _reload_ctes()) + (
        "SELECT (SELECT count(*) FROM trips) AS raw_rows, "
        "(SELECT count(*) FROM clean_strict) AS clean_rows, "
        f"(SELECT {avg_fixed('fare_amount', 2, 2)} FROM clean_strict) AS avg_fare, "
        "(SELECT status FROM vsum) AS validation_status, "
        "(SELECT warning_count FROM vsum) AS validation_warnings, "
        f"(SELECT count(*) FILTER (WHERE pickup_date = DATE '{PINNED_DAY}') FROM reloaded) "
        "AS loaded_rows")
    out["synthetic_trips"] = _synthetic_sql()
    out.update(_lake_sql(out))
    return out


# ---- queries over written layers (plans/lake.py) ----

CLEARED_DAY = "2024-01-20"


def _lake_sql(core: dict[str, str]) -> dict[str, str]:
    out: dict[str, str] = {}
    live = f"WHERE pickup_date <> DATE '{CLEARED_DAY}'"
    out["atomic_load"] = _wq("x AS (SELECT 1)") + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, pickup_date, count(*) AS n_rows, CAST({n} AS BIGINT) AS trips "
        f"FROM {t} {live} GROUP BY pickup_date"
        for t, n in (("taxi_trips", "count(*)"), ("agg_by_zone", "sum(total_trips)"),
                     ("agg_by_hour", "sum(trip_count)"), ("agg_payment", "sum(trips)")))
    kind = "(dropoff_location_id * 31 + payment_type * 7 + coalesce(vendor_id, 0)) % 10"
    broken = f"({kind} IN (1, 2))"
    cols = ", ".join(f"CASE WHEN NOT {broken} THEN {c} END AS {c}" for c in TRIP_CONTRACT.column_names)
    out["raw_csv_scan"] = q(
        f"SELECT {cols}, CAST({P} AS DATE) AS run_date, {broken} AS corrupt, "
        f"CASE {kind} WHEN 1 THEN 9 WHEN 2 THEN 14 END AS n_fields FROM trips")
    out["zone_join_bucketed"] = core["zone_join"]
    out["row_gate_day"] = q(f"SELECT least(count(*), 100) AS rows_seen, count(*) >= 100 AS proceed "
                            f"FROM trips WHERE {DAY_PRED}")
    fallback = "DATE '2024-01-20' + CAST(l_orderkey % 20 AS INTEGER)"
    out["source_choice"] = _wq(
        f"days AS (SELECT DISTINCT CAST({P} AS DATE) AS run_date FROM trips)",
        f"tagged AS (SELECT CAST({P} AS DATE) AS run_date, 'real' AS source FROM trips UNION ALL "
        f"SELECT {fallback}, 'synthetic' FROM lineitem WHERE {fallback} NOT IN (SELECT run_date FROM days))") + (
        "SELECT run_date, source, count(*) AS row_count FROM tagged GROUP BY run_date, source")
    for name in ("pipeline_health", "health_for_date", "fare_anomalies"):
        out[f"facts_{name}"] = core[name]
    out["facts_weekly_health"] = q(
        "SELECT CAST(date_trunc('week', pickup_date) AS DATE) AS week, count(*) AS row_count, "
        f"{avg_fixed('fare_amount', 2, 2)} AS avg_fare, count(DISTINCT pickup_location_id) AS unique_locations, "
        "count(DISTINCT pickup_zone) AS unique_zones FROM taxi_trips GROUP BY 1")
    for name in REPORTS:
        out[f"sql_{name}"] = core[name]
    return out


# ---- synthetic trips (A5): the same integer-hash generator in SQL ----

def _synthetic_sql() -> str:
    from tripflow.sources import synthetic as syn

    p = syn.PRIME
    ks = range(1, 15)
    x0 = ", ".join(f"(id * 48271 + {k * 69621} + 12345) % {p} AS x{k}" for k in ks)
    steps = []
    for i in range(3):
        body = ", ".join(f"(x{k} * x{k} + id + {7 + i}) % {p} AS x{k}" for k in ks)
        steps.append(f"s{i + 1} AS (SELECT id, {body} FROM s{i})")
    us = ", ".join(f"x{k} / {float(p)!r}e0 AS u{k}" for k in ks)

    def f(v: float) -> str:
        text = repr(float(v))
        return text if "e" in text else text + "e0"  # a DOUBLE literal

    def clip(e: str, lo: float, hi: float) -> str:
        return f"least(greatest({e}, {f(lo)}), {f(hi)})"

    def choice(vals, u: str) -> str:
        return f"[{', '.join(str(v) for v in vals)}][CAST(floor({u} * {len(vals)}) AS BIGINT) + 1]"

    share = f"({f(syn.TIP_SHARE[0])} + {f(syn.TIP_SHARE[1] - syn.TIP_SHARE[0])} * u7)"
    extra = f"({f(syn.EXTRA_RANGE[0])} + {f(syn.EXTRA_RANGE[1] - syn.EXTRA_RANGE[0])} * u8)"
    dur = clip(f"{f(-syn.DURATION_MEAN_MIN)} * ln(1 - u2)", *syn.DURATION_CLIP)
    dist = r(clip(f"{f(-syn.DISTANCE_MEAN_MI)} * ln(1 - u3)", *syn.DISTANCE_CLIP), 2)
    normal = f"(sqrt(-2.0e0 * ln(1 - u4)) * cos({f(2 * 3.141592653589793)} * u5))"
    base = f"TIMESTAMP '{PINNED_DAY} 00:00:00'"
    lo, hi = syn.LOCATIONS
    return f"""WITH s0 AS (SELECT id, {x0} FROM (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem)),
{', '.join(steps)},
u AS (SELECT id, {us} FROM s3),
g AS (SELECT
  {choice(syn.VENDORS, 'u9')} AS vendor_id,
  {base} + to_seconds(CAST(floor(u1 * 86400) AS BIGINT)) AS tpep_pickup_datetime,
  {base} + to_seconds(CAST(floor(u1 * 86400) AS BIGINT))
    + to_microseconds(CAST(round({r(f'{dur} * 60.0e0', 6)} * 1e6) AS BIGINT)) AS tpep_dropoff_datetime,
  {choice(syn.PASSENGERS, 'u10')} AS passenger_count,
  {dist} AS trip_distance,
  {choice(syn.RATE_CODES, 'u11')} AS rate_code_id,
  {choice(syn.PAYMENT_TYPES, 'u12')} AS payment_type,
  CAST({lo} + floor(u13 * {hi - lo + 1}) AS INTEGER) AS pickup_location_id,
  CAST({lo} + floor(u14 * {hi - lo + 1}) AS INTEGER) AS dropoff_location_id,
  {normal} AS _normal, {share} AS _share, {extra} AS _extra, u6 AS _u6
 FROM u),
g2 AS (SELECT *, {r(clip(f'{f(syn.FARE_BASE)} + {f(syn.FARE_PER_MILE)} * trip_distance + {f(syn.FARE_NOISE_SD)} * _normal', *syn.FARE_CLIP), 2)} AS fare_amount FROM g),
g3 AS (SELECT *, CASE WHEN _u6 < {f(syn.TIP_PROBABILITY)} THEN {r('fare_amount * _share', 2)} ELSE 0e0 END AS tip_amount FROM g2)
SELECT vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
  rate_code_id, fare_amount, tip_amount, {r('fare_amount + tip_amount + _extra', 2)} AS total_amount,
  payment_type, pickup_location_id, dropoff_location_id FROM g3"""
