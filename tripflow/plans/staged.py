"""Tables Spark derives once from the source tables and reuses.

The daily pipeline never recomputes upstream steps: it writes the typed raw
trips and the enriched trips table once and every later step reads them.
The named queries work the same way: ``staged`` writes a derived table under
the session's ``spark.checkpoint.dir`` (the shared folder on a cluster) and
returns a read of it.  The table name carries a signature of the inputs
(paths, sizes, modification times) and of the package source, so a changed
source table or changed code builds a new table.
Reading a written table also cuts the lineage: a lost executor recomputes
from it, not from the sources.
"""

from __future__ import annotations

import functools
import hashlib
import pathlib
import uuid
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from tripflow.files import at as _fs
from tripflow.files import small_splits
from tripflow.session import ensure_checkpoint_dir


@functools.cache
def code_version() -> str:
    """Hash of this package's source (the text operators stage nothing here):
    changed code never reads a table that older code staged."""
    root = pathlib.Path(__file__).resolve().parents[1]
    h = hashlib.sha1()
    for f in sorted(p for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm"):
        h.update(str(f.relative_to(root)).encode())
        h.update(f.read_bytes())
    return h.hexdigest()


def input_signature(spark: SparkSession, paths: list[str], version: str | None = None) -> str:
    """Code version plus either the caller's version tag of the inputs or,
    without one, each input's size and modification time (a recursive
    listing: one call on HDFS, a full listing on an object store, so a
    caller with millions of input files passes ``version``)."""
    parts = [code_version()]
    if version is not None:
        return hashlib.sha1("\n".join(parts + [f"version|{version}"]).encode()).hexdigest()[:16]
    for p in paths:
        fs, hpath = _fs(spark, p)
        st = fs.getFileStatus(hpath)
        size = fs.getContentSummary(hpath).getLength()
        parts.append(f"{st.getPath().toString()}|{size}|{st.getModificationTime()}")
    return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:16]


def staged(spark: SparkSession, name: str, build: Callable[[], DataFrame], inputs: list[str],
           partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
           version: str | None = None, laid_out: bool = False) -> DataFrame:
    """``build()`` written once per input version, then read back.

    A partitioned table is shuffled with the ``REBALANCE`` hint on its
    partition columns: AQE sizes the write tasks at run time, coalescing
    small dates and splitting a hot date along map-output blocks into
    advisory-size pieces (even when a third of all rows share one date, or
    are exact copies), so each date is written as a few files of a useful
    size, never by one task.  No sampling pass over the input is needed (as
    range partitioning would).  Within a task rows are sorted by
    ``partition_by + cluster_by`` (a local sort), so each file covers a
    narrow time range and row-group statistics prune time filters.

    ``laid_out`` says that ``build()`` scans, without a shuffle, a table that
    already lies by the same partitions.  Each of its splits is then written as
    it is read, as one file: no row is shuffled again.
    """
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/tripflow-staged/{name}-{input_signature(spark, inputs, version)}"
    fs, final = _fs(spark, path)
    if not fs.exists(final):
        df = build()
        if partition_by:
            df = df if laid_out else df.hint("rebalance", *partition_by)
            df = df.sortWithinPartitions(*partition_by, *(cluster_by or []))
        # static: a full rewrite of a private directory (dynamic partition
        # overwrite is the session default for reloads)
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with small_splits(spark) if laid_out else nullcontext():
            writer.parquet(tmp)
        # publish with one rename; if another session published first, keep
        # theirs (a rename onto an existing directory would nest into it)
        _, tmp_path = _fs(spark, tmp)
        if fs.exists(final) or not fs.rename(tmp_path, final):
            fs.delete(tmp_path, True)
    return spark.read.parquet(path)
