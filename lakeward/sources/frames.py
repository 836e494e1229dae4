"""DataFrames and tables as batches.

A typed source (a Parquet table, a DataFrame) declares its own schema: the
observed schema of its batch is the DataFrame schema, names in column order
and types mapped to the contract vocabulary. Spark reads it from the file
footers, so observing costs no scan. ``FrameFeed`` hands the gate the rows
of the admitted feeds, stamped with their batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import types as ty

OBSERVED_DDL = ("dataset string, batch_id string, bronze_path string, "
                "observed_schema array<struct<name:string,data_type:string>>")


def observed_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(c, ty.contract_type_of(t)) for c, t in df.dtypes]


def observe_frames(spark: SparkSession, frames: dict[str, DataFrame], batch_id: str | dict = "snapshot",
                   locations: dict | None = None) -> DataFrame:
    """One observed row per frame (metadata only).

    ``batch_id`` is one id for all feeds, or a dict dataset -> id.
    """
    rows = []
    for name, df in frames.items():
        bid = batch_id[name] if isinstance(batch_id, dict) else batch_id
        loc = (locations or {}).get(name)
        rows.append((name, bid, loc, observed_of(df)))
    return spark.createDataFrame(rows, OBSERVED_DDL)


def read_tables(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


class FrameFeed:
    """Row source over named DataFrames: the rows of an admitted feed,
    stamped with its batch id (each frame is one batch)."""

    # each frame is one batch, so every input split holds a single batch
    clustered_by_batch = True

    def __init__(self, frames: dict[str, DataFrame], batch_id: str | dict = "snapshot"):
        self.frames = frames
        self.batch_id = batch_id

    def __call__(self, dataset: str, allowed: DataFrame) -> DataFrame:
        bid = self.batch_id[dataset] if isinstance(self.batch_id, dict) else self.batch_id
        return self.frames[dataset].withColumn("batch_id", F.lit(bid))
