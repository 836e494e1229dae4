"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import textvec

_LOCAL_DIRS: dict[str, str] = {}


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``df`` and nothing else.

    Columns are found by their exact name and position, so extra columns
    that differ only in case, or repeat a name, cannot make the reference
    ambiguous (the first exact match wins)."""
    columns = df.columns
    at = []
    for name in names:
        if name not in columns:
            raise ValueError(f"column {name!r} is missing; there are {columns}")
        at.append(columns.index(name))
    numbered = df.toDF(*(f"_c{i}" for i in range(len(columns))))
    return numbered.select(*(numbered[f"_c{i}"].alias(name) for i, name in zip(at, names)))


def filter_rows(docs: DataFrame, column: str, derived, keep) -> DataFrame:
    """The rows of ``docs``, unchanged, that ``keep()(batch)`` marks: it is
    given ``derived(column)`` as an Arrow array and returns booleans. Rows are
    judged where they are; nothing is joined or shuffled. ``keep`` is called
    once per task."""
    names, schema = docs.columns, docs.schema
    numbered = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    judged = numbered.withColumn("_judged", derived(numbered[f"_c{names.index(column)}"]))

    def run(batches):
        mark = keep()
        for batch in textvec.released(batches):
            mask = pa.array(mark(batch.column(len(names))))
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[:-1]], names)

    return judged.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own;
    a cluster must name one."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir")
    if where:
        return f"{where.rstrip('/')}/lakeward-llm/{sc.applicationId}"
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="lakeward-llm-")
    return _LOCAL_DIRS[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    plan is cut, the rows survive lost executors, and each later use reads
    the same rows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the tables that this application's operators have cut plans
    with. Results that still read them are lost, so write these first."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_train(doc_id: str = "doc_id") -> Column:
    """True for rows that may be learned from: crc32(doc_id as text) mod 3 is not 1
    (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(False))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 3 is 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
