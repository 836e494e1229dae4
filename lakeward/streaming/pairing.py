"""Pairing of sidecars and data files that land in any order.

A batch is ready when both its sidecar and its data file have come. The two
arrive in streams of their own; per batch id a small state keeps what has
come until the other has, over restarts of the query (the state is in its
checkpoint). A batch whose other half does not come within ``patience`` is
told once as overdue, by a processing-time timer; what comes after that still
pairs it. A batch keeps a few bytes of state after it is paired, so that a
file that lands again does not make it overdue. Ready batches go through the gate, overdue ones get a quarantine
row ``overdue:sidecar`` or ``overdue:file`` (the part that is lacking).
"""

from __future__ import annotations

import logging

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lakeward.functions import exprs as X
from lakeward.operators import contracts as C
from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB
from lakeward.streaming.file_gate import SIDECAR, observed_from_sidecars, sidecar_stream

logger = logging.getLogger(__name__)

READY, OVERDUE = "ready", "overdue"
_OUT = "batch_id string, status string, lacks string, path string, sidecar string, sidecar_path string"
_STATE = "path string, sidecar string, sidecar_path string, paired boolean, told boolean"


def arrivals(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(batch_id, path, sidecar, sidecar_path) of every file that lands: data
    files have a path, sidecars their text."""
    files = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", str(max_files_per_trigger))
    none = F.lit(None).cast("string")
    path = F.regexp_replace("path", r"^file:/+", "file:/")
    data = files.load(folder).select(CB.batch_id_of(path).alias("batch_id"), path.alias("path"), none.alias("sidecar"), none.alias("sidecar_path"))
    side = sidecar_stream(spark, folder, max_files_per_trigger)
    return data.unionByName(side.select(CB.batch_id_of(F.col("file_path"), SIDECAR).alias("batch_id"), none.alias("path"),
                                        F.col("value").alias("sidecar"), F.col("file_path").alias("sidecar_path")))


def _pair(patience_ms: int):
    def run(key, frames, state):
        path, sidecar, sidecar_path, paired, told = state.get if state.exists else (None, None, None, False, False)
        out = []
        if state.hasTimedOut:
            if not paired and not told:
                out.append((key[0], OVERDUE, "sidecar" if sidecar is None else "file", path, sidecar, sidecar_path))
            state.update((path, sidecar, sidecar_path, paired, True))
        else:
            for frame in frames:
                for r in frame.itertuples():
                    path = r.path if isinstance(r.path, str) else path
                    sidecar, sidecar_path = (r.sidecar, r.sidecar_path) if isinstance(r.sidecar, str) else (sidecar, sidecar_path)
            if path is not None and sidecar is not None and not paired:
                paired = True
                out.append((key[0], READY, None, path, sidecar, sidecar_path))
            state.update((path, None if paired else sidecar, sidecar_path, paired, told))
            if not paired and not told:
                state.setTimeoutDuration(patience_ms)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])
    return run


def paired(landed: DataFrame, patience_ms: int) -> DataFrame:
    """One row per batch when it is ready, and one if it becomes overdue first."""
    return landed.groupBy("batch_id").applyInPandasWithState(_pair(patience_ms), _OUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def start(spark: SparkSession, folder: str, dataset: str, *, checkpoint: str, names: TB.TableNames = TB.TableNames(), patience_ms: int = 3_600_000,
          query_name: str = "lakeward_pairing", promote_gold: bool = False, interval: str = "10 seconds", max_files_per_trigger: int | None = None):
    """Start the stream: pair, gate what is ready, hold what is overdue."""
    if not checkpoint:
        raise ValueError("the stream needs a checkpoint location that outlives the application")

    def run(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        run_id = f"{query_name}-{query}-{epoch_id}"
        batch = batch.persist()
        try:
            late = batch.where(F.col("status") == OVERDUE)
            if not late.isEmpty():
                TB.ensure_control_tables(spark, names)
                empty = [F.lit(None).cast(t).alias(c) for c, t in (("added_fields", "array<string>"), ("missing_fields", "array<string>"),
                                                                  ("changed_fields", TB._CHANGED))]
                rows = late.select("batch_id", F.lit(X.QUARANTINE).alias("decision"), *empty, F.coalesce("path", "sidecar_path").alias("bronze_path"),
                                   F.lit(C.event_clock()).cast("timestamp").alias("event_time"), F.lit(run_id).alias("run_id"),
                                   F.concat(F.lit("overdue:"), "lacks").alias("reason"))
                G._append_holds(spark, names.quarantine(dataset), rows, run_id, True)
            ready = batch.where(F.col("status") == READY)
            if ready.isEmpty():
                return
            observed = observed_from_sidecars(ready.select(F.col("sidecar").alias("value"), F.col("sidecar_path").alias("file_path")), dataset) \
                .drop("bronze_path").join(ready.select("batch_id", F.col("path").alias("bronze_path")), "batch_id")
            result = G.gate_batches(spark, observed, CB.CsvFeed(spark), names=names, run_id=run_id, promote_gold=promote_gold, raise_errors=False)
            for error in result.errors:
                logger.warning("epoch %s: %s", epoch_id, error)
        finally:
            batch.unpersist()

    landed = arrivals(spark, folder, max_files_per_trigger)
    return paired(landed, patience_ms).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName(query_name) \
        .trigger(processingTime=interval).start()
