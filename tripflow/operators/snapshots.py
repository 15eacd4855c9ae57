"""F1 for several tables at once: a load is visible whole or not at all.

A table is a folder of loads, a load a folder of date partitions::

    <root>/taxi_trips/load=<id>/pickup_date=2024-01-15/part-*.parquet
    <root>/agg_by_hour/load=<id>/pickup_date=2024-01-15/part-*.parquet
    <root>/_manifests/v=00000007/part-*.json, _SUCCESS

The manifest of a version names, for every table and date, the load that holds
its rows.  A load writes all its tables beside the live ones, in a folder of its
own that no manifest names; then one Spark job writes the next manifest, in
which the load's dates (and its run date, also where a table has no row for it)
take the place of earlier ones.  The ``_SUCCESS`` mark that ends this job is the
commit: a manifest without it counts for nothing.  So whatever fails, and
wherever, readers find all tables as before the load or all as after it, and a
load that is tried again starts from there.

Readers name the version they want or take the latest once for all tables.
Superseded and abandoned loads are removed by ``vacuum``; versions that should
stay readable are its ``keep``.

One load at a time writes to a root (a second one that publishes the same
version fails, its tables stay unnamed).  The driver holds the manifest alone:
one row per table and date, as many as there are partitions to list.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import files
from tripflow.contract import TABLE_SCHEMAS
from tripflow.operators.tables import DATE_COL

MANAGED = ("taxi_trips", "agg_by_zone", "agg_by_hour", "agg_payment")
MANIFEST_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()), T.StructField(DATE_COL, T.DateType()),
    T.StructField("load", T.StringType()), T.StructField("rows", T.LongType())])
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of a NULL


def _manifest_path(root: str, version: int) -> str:
    return f"{root}/_manifests/v={version:08d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, oldest first."""
    marks = files.matching(spark, f"{root}/_manifests/v=*/_SUCCESS")
    return [int(re.search(r"v=(\d+)/_SUCCESS$", m)[1]) for m in marks]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The manifest of a version (the latest unless given); empty before the
    first load."""
    if version is None:
        version = max(versions(spark, root), default=None)
    if version is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(_manifest_path(root, version))


def _read(spark: SparkSession, root: str, name: str, paths: list[str]) -> DataFrame:
    schema = TABLE_SCHEMAS[name]
    if not paths:
        return spark.createDataFrame([], schema)
    with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return (spark.read.schema(with_load).option("basePath", f"{root}/{name}").parquet(*paths)
            .select(*schema.fieldNames()))


def _partition(root: str, name: str, load: str, date: dt.date | None) -> str:
    return f"{root}/{name}/load={load}/{DATE_COL}={NULL_DATE if date is None else date}"


def read(spark: SparkSession, root: str, names: Iterable[str] = MANAGED,
         version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version: the latest when called, unless given.

    The date partitions are given to the scan by name, so a typed date
    predicate prunes them, and later loads do not change what is read.
    """
    entries = manifest(spark, root, version).collect()
    return {name: _read(spark, root, name, sorted(
        _partition(root, name, e["load"], e[DATE_COL]) for e in entries if e["table"] == name)) for name in names}


class Load:
    """A load in progress.  Nothing it writes is visible before ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.id = uuid.uuid4().hex
        self.written: list[str] = []

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}/load={self.id}"

    def write(self, name: str, batch: DataFrame, laid_out: bool = False) -> int:
        """Write a table's rows beside the live ones; returns their number.
        A few files a date, a hot date split over several tasks.  A batch that
        is scanned from a table partitioned by date (``laid_out``) is written
        split by split, without a shuffle."""
        obs = Observation(f"load_{name}")
        batch = batch.select(*TABLE_SCHEMAS[name].fieldNames())
        with files.small_splits(self.spark) if laid_out else nullcontext():
            ((batch if laid_out else batch.hint("rebalance", F.col(DATE_COL)))
             .observe(obs, F.count(F.lit(1)).alias("rows"))
             .write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(DATE_COL).parquet(self._path(name)))
        self.written.append(name)
        return int(obs.get["rows"])

    def read(self, name: str) -> DataFrame:
        """What this load has written of a table."""
        schema = TABLE_SCHEMAS[name]
        return self.spark.read.schema(schema).parquet(self._path(name)).select(*schema.fieldNames())

    def entries(self) -> DataFrame:
        """Manifest rows of this load (counted from the files' footers)."""
        out = self.spark.createDataFrame([], MANIFEST_SCHEMA)
        for name in self.written:
            out = out.unionByName(self.read(name).groupBy(DATE_COL).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), DATE_COL, F.lit(self.id).alias("load"), "rows"))
        return out

    def commit(self, run_dates: Iterable[str] = ()) -> int:
        """Publish the load: its dates and ``run_dates`` are replaced in all
        managed tables.  Returns the new version."""
        have = versions(self.spark, self.root)
        tried = [int(p.rsplit("=", 1)[1]) for p in files.matching(self.spark, f"{self.root}/_manifests/v=*")]
        version = max([*have, *tried], default=0) + 1
        new = self.entries()
        dates = new.select(DATE_COL)
        for day in run_dates:
            dates = dates.unionByName(self.spark.range(1).select(F.lit(day).cast("date").alias(DATE_COL)))
        gone = dates.distinct().withColumnRenamed(DATE_COL, "__date")
        old = manifest(self.spark, self.root, max(have, default=None)) if have else new.limit(0)
        kept = old.join(gone, F.col(DATE_COL).eqNullSafe(F.col("__date")), "left_anti")
        (kept.unionByName(new).coalesce(1)
         .write.mode("errorifexists").json(_manifest_path(self.root, version)))
        return version


def vacuum(spark: SparkSession, root: str, keep: int = 1, names: Iterable[str] = MANAGED) -> int:
    """Remove what the last ``keep`` versions do not name: superseded date
    partitions, loads that were never committed, and older manifests.  Returns
    the number of partitions removed.  A reader of a version that goes fails;
    it never reads something else."""
    have = versions(spark, root)
    stay = set(have[-keep:])
    named = {(e["table"], e["load"], NULL_DATE if e[DATE_COL] is None else str(e[DATE_COL]))
             for v in stay for e in manifest(spark, root, v).collect()}
    removed = 0
    for path in files.matching(spark, f"{root}/_manifests/v=*"):
        if int(path.rsplit("=", 1)[1]) not in stay and have:
            files.delete(spark, path)
    for name in names:
        for path in files.matching(spark, f"{root}/{name}/load=*/{DATE_COL}=*"):
            load, date = re.search(rf"load=([^/]+)/{DATE_COL}=([^/]+)$", path).groups()
            if (name, load, date) not in named:
                files.delete(spark, path)
                removed += 1
        live = {load for table, load, _ in named if table == name}
        for path in files.matching(spark, f"{root}/{name}/load=*"):
            if path.rsplit("=", 1)[1] not in live:
                files.delete(spark, path)
    return removed
