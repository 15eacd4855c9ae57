"""The trip data contract and the table schemas.

Everything in the "fixed values" blocks below must equal the reference's
contract and labels for results to match; they are stated plainly, in the
contract's own order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str  # "integer" | "float" | "timestamp"
    nullable: bool = True
    min_value: object = None
    max_value: object = None
    allowed_values: tuple = ()


@dataclass(frozen=True)
class QualityRule:
    name: str
    expr: str  # a Spark SQL boolean expression over the raw columns
    severity: str = "warning"


@dataclass(frozen=True)
class Contract:
    version: str
    dataset: str
    columns: tuple[ColumnSpec, ...]
    rules: tuple[QualityRule, ...]
    max_null_fraction: float
    min_row_count: int
    max_duplicate_fraction: float

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


# --- fixed values: the trip contract (column order, bounds, rules, thresholds) ---
TRIP_CONTRACT = Contract(
    version="1.0",
    dataset="nyc_yellow_taxi_trips",
    columns=(
        ColumnSpec("vendor_id", "integer", True, allowed_values=(1, 2)),
        ColumnSpec("tpep_pickup_datetime", "timestamp", False,
                   "2020-01-01 00:00:00", "2027-12-31 23:59:59"),
        ColumnSpec("tpep_dropoff_datetime", "timestamp", False),
        ColumnSpec("passenger_count", "integer", True, 0, 9),
        ColumnSpec("trip_distance", "float", True, 0.0, 500.0),
        ColumnSpec("rate_code_id", "integer", True),
        ColumnSpec("fare_amount", "float", True, 0.0, 1000.0),
        ColumnSpec("tip_amount", "float", True, 0.0),
        ColumnSpec("total_amount", "float", True, 0.0, 2000.0),
        ColumnSpec("payment_type", "integer", True),
        ColumnSpec("pickup_location_id", "integer", True),
        ColumnSpec("dropoff_location_id", "integer", True),
    ),
    rules=(
        QualityRule("dropoff_after_pickup",
                    "tpep_dropoff_datetime > tpep_pickup_datetime", "warning"),
        QualityRule("total_gte_fare_plus_tip",
                    "total_amount >= fare_amount + tip_amount - 0.01", "warning"),
    ),
    max_null_fraction=0.15,
    min_row_count=100,
    max_duplicate_fraction=0.05,
)

# --- fixed values: source column renames (monthly source name -> contract name) ---
SOURCE_RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# --- fixed values: payment labels; any other code (or NULL) is "unknown" ---
PAYMENT_LABELS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}
UNKNOWN_PAYMENT = "unknown"

# --- fixed values: time of day by pickup hour (inclusive ranges); else "night" ---
TIME_OF_DAY = (("morning", 6, 11), ("afternoon", 12, 16), ("evening", 17, 21))
NIGHT = "night"

# --- fixed values: distance buckets (upper bound exclusive); else "over_10mi" ---
DISTANCE_BUCKETS = (("under_1mi", 1), ("1_to_3mi", 3), ("3_to_10mi", 10))
LONGEST_BUCKET = "over_10mi"

# --- fixed values: strict row filter bounds (inclusive) ---
STRICT_DISTANCE = (0.01, 500)
STRICT_FARE = (0, 1000)
STRICT_PASSENGERS = (1, 9)
STRICT_VENDORS = (1, 2)

# --- fixed values: zone fallback label when no lookup exists ---
UNKNOWN_ZONE = "unknown"

# --- fixed values: the day the monthly source is sliced to ---
PINNED_DAY = "2024-01-15"

# --- fixed values: anomaly threshold in standard deviations ---
ANOMALY_SIGMAS = 3

STRICT, BATCH = "strict", "batch"

INT_COLUMNS = [c.name for c in TRIP_CONTRACT.columns if c.type == "integer"]
FLOAT_COLUMNS = [c.name for c in TRIP_CONTRACT.columns if c.type == "float"]
TS_COLUMNS = [c.name for c in TRIP_CONTRACT.columns if c.type == "timestamp"]

_SPARK_TYPE = {"integer": T.IntegerType(), "float": T.DoubleType(),
               "timestamp": T.TimestampNTZType()}

# Raw text layer: every contract column as a nullable string (CSV is read
# against this schema, never inferred).
RAW_TEXT_SCHEMA = T.StructType(
    [T.StructField(c.name, T.StringType(), True) for c in TRIP_CONTRACT.columns])

# Typed raw trips.
RAW_TRIPS_SCHEMA = T.StructType(
    [T.StructField(c.name, _SPARK_TYPE[c.type], True) for c in TRIP_CONTRACT.columns])

ZONE_TEXT_SCHEMA = T.StructType([
    T.StructField("LocationID", T.StringType(), True),
    T.StructField("Borough", T.StringType(), True),
    T.StructField("Zone", T.StringType(), True),
])

ZONES_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType(), True),
    T.StructField("zone_name", T.StringType(), True),
    T.StructField("borough", T.StringType(), True),
])


_TYPES = {"INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
          "STRING": T.StringType(), "DATE": T.DateType(),
          "TIMESTAMP_NTZ": T.TimestampNTZType()}


def _struct(spec: str) -> T.StructType:
    """``"name TYPE, ..."`` -> StructType (all fields nullable)."""
    fields = [f.split() for f in spec.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


# Output tables (column order of the analytics layer).
TAXI_TRIPS_SCHEMA = _struct(
    "vendor_id INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
    "passenger_count INT, trip_distance DOUBLE, rate_code_id INT, fare_amount DOUBLE, "
    "tip_amount DOUBLE, total_amount DOUBLE, payment_type INT, payment_label STRING, "
    "pickup_location_id INT, dropoff_location_id INT, pickup_zone STRING, pickup_borough STRING, "
    "dropoff_zone STRING, dropoff_borough STRING, trip_duration_min DOUBLE, avg_speed_mph DOUBLE, "
    "tip_pct DOUBLE, time_of_day STRING, pickup_hour INT, pickup_date DATE")

AGG_BY_ZONE_SCHEMA = _struct(
    "pickup_date DATE, pickup_zone STRING, pickup_borough STRING, total_trips BIGINT, "
    "avg_fare DOUBLE, avg_tip_pct DOUBLE, avg_distance_mi DOUBLE, avg_duration_min DOUBLE, "
    "avg_speed_mph DOUBLE, total_revenue DOUBLE")

AGG_BY_HOUR_SCHEMA = _struct(
    "pickup_date DATE, pickup_hour INT, time_of_day STRING, trip_count BIGINT, "
    "avg_fare DOUBLE, avg_passengers DOUBLE")

AGG_PAYMENT_SCHEMA = _struct(
    "pickup_date DATE, payment_label STRING, trips BIGINT, avg_tip_pct DOUBLE, "
    "pct_of_total DOUBLE")

PIPELINE_RUNS_SCHEMA = _struct(
    "run_id STRING, execution_date DATE, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, "
    "raw_row_count BIGINT, clean_row_count BIGINT, validation_status STRING, status STRING")

DEAD_LETTER_SCHEMA = T.StructType(
    [*RAW_TRIPS_SCHEMA.fields, T.StructField("reject_reasons", T.ArrayType(T.StringType()), True),
     T.StructField("raw_line", T.StringType(), True), T.StructField("run_date", T.DateType(), True)])

TABLE_SCHEMAS = {
    "taxi_trips": TAXI_TRIPS_SCHEMA,
    "agg_by_zone": AGG_BY_ZONE_SCHEMA,
    "agg_by_hour": AGG_BY_HOUR_SCHEMA,
    "agg_payment": AGG_PAYMENT_SCHEMA,
    "pipeline_runs": PIPELINE_RUNS_SCHEMA,
    "dead_letter": DEAD_LETTER_SCHEMA,
}
