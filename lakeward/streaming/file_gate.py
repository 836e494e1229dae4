"""Gate batches as their files arrive (Structured Streaming).

The stream watches a landing folder for observed-schema sidecars
(``<batch>.schema.json``); each micro-batch of newly arrived sidecars is one
gate run whose ``run_id`` is derived from the query name, the checkpoint's
query id and the epoch. A restarted query replays its last epoch with the
same ``run_id``: batches it recorded keep their decision and their data is
replaced, others are decided. The checkpoint location is required and must
outlive the application. A batch held for its values or header is recorded
in the quarantine table and does not stop the stream.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB

SIDECAR = ".schema.json"
logger = logging.getLogger(__name__)


def sidecar_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("text").option("wholetext", "true")
              .option("pathGlobFilter", f"*{SIDECAR}"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select("value", F.col("_metadata.file_path").alias("file_path"))


def observed_from_sidecars(raw: DataFrame, dataset: str) -> DataFrame:
    """Sidecar text rows -> the gate's observed relation."""
    suffix = re.escape(SIDECAR) + "$"
    path = F.regexp_replace("file_path", r"^file:/+", "file:/")
    schema = F.from_json("value", "array<struct<name:string,data_type:string>>")
    return raw.select(
        F.lit(dataset).alias("dataset"),
        F.regexp_replace(F.element_at(F.split(path, "/"), -1), suffix, "").alias("batch_id"),
        F.regexp_replace(path, suffix, ".csv").alias("bronze_path"),
        schema.alias("observed_schema"),
    ).select("dataset", "batch_id", "bronze_path",
             F.transform("observed_schema", lambda x: x["name"]).alias("header"), "observed_schema")


def start(spark: SparkSession, folder: str, dataset: str, *, names: TB.TableNames = TB.TableNames(),
          checkpoint: str, query_name: str = "lakeward_gate", promote_gold: bool = False,
          trigger_once: bool = False, max_files_per_trigger: int | None = None):
    """Start the streaming gate; returns the StreamingQuery."""
    if not checkpoint:
        raise ValueError("the stream needs a checkpoint location that outlives the application")

    def run(batch: DataFrame, epoch_id: int) -> None:
        observed = observed_from_sidecars(batch, dataset)
        if observed.isEmpty():
            return
        # the query's id is kept in its checkpoint: another checkpoint makes other run ids
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        observed = observed.cache()
        try:
            # batches held at promotion are in the quarantine table; they do not stop the stream
            result = G.gate_batches(spark, observed, CB.CsvFeed(spark, observed), names=names,
                                    run_id=f"{query_name}-{query}-{epoch_id}", promote_gold=promote_gold, raise_errors=False)
            for error in result.errors:
                logger.warning("epoch %s: %s", epoch_id, error)
        finally:
            observed.unpersist()

    writer = sidecar_stream(spark, folder, max_files_per_trigger).writeStream.foreachBatch(run) \
        .option("checkpointLocation", checkpoint).queryName(query_name)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
