"""Incremental processing of landed raw files with Structured Streaming.

The reference runs once a day on a schedule.  The Spark-native equivalent
is a file-source stream over the raw layer run with
``trigger(availableNow=True)``: each start processes exactly the run dates
of which files landed since the last start (the checkpoint remembers which),
then stops.  ``foreachBatch`` takes each of these dates through the steps of
the daily run (``pipeline.process``): validation, gate, dead letter, tables,
facts and an audit row.  A date is read whole from the raw layer, so files
that land later complete it, and a micro-batch that is replayed after a
failure leaves the tables as if it had run once.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.contract import RAW_TEXT_SCHEMA, TRIP_CONTRACT
from tripflow.operators.validate import ValidationFailed
from tripflow.plans.pipeline import Layout, audited, process

log = logging.getLogger(__name__)

LANDED_SCHEMA = T.StructType(list(RAW_TEXT_SCHEMA.fields)
                             + [T.StructField("run_date", T.StringType(), True)])


def process_batch(spark: SparkSession, layout: Layout, zones: DataFrame | None,
                  text: DataFrame, min_rows: int = TRIP_CONTRACT.min_row_count) -> None:
    """Run every date of which the micro-batch holds rows (one per landed
    folder; their names are all that the driver reads).  A date that fails its
    contract is audited as failed, and the others go on."""
    for row in text.select("run_date").distinct().orderBy("run_date").collect():
        try:
            with audited(spark, row["run_date"], layout) as metrics:
                process(spark, row["run_date"], layout, zones, min_rows, metrics)
        except ValidationFailed as e:
            log.warning("%s: %s", row["run_date"], e)


def start(spark: SparkSession, layout: Layout, checkpoint: str, zones: DataFrame | None = None,
          min_rows: int = TRIP_CONTRACT.min_row_count) -> StreamingQuery:
    """Process every newly landed ``raw/run_date=*/`` file, then stop."""
    text = (spark.readStream.schema(LANDED_SCHEMA)
            .option("header", True).option("basePath", layout.raw)
            .csv(f"{layout.raw}/run_date=*"))
    return (text.writeStream
            .foreachBatch(lambda df, _: process_batch(spark, layout, zones, df, min_rows))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
