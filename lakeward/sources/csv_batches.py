"""CSV batches: one file is one batch.

Folders are listed by tasks, level by level, and observing a batch reads only
the first CSV record of its file, in the tasks too. Rows of all files come
from one scan, whatever their headers: values are read as strings by position
(Spark's CSV reader applies an explicit schema so), joined to their file's row
of positions, and picked from there under the wanted names, then cast by the
gate. So the plan does not grow with the number of headers, and no header
passes through the driver.
"""

from __future__ import annotations

import csv
import io
import os
import re
from fnmatch import fnmatch

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources import quoted_lines

HEADER_SCHEMA = "path string, header array<string>"

def _open_text(path: str):
    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return open(local, newline="", encoding="utf-8")
    if "://" not in path:
        return open(path, newline="", encoding="utf-8")
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    return io.TextIOWrapper(filesystem.open_input_stream(inner), encoding="utf-8", newline="")


def _first_record(path: str) -> list[str]:
    with _open_text(path) as handle:
        return next(csv.reader(handle), [])


# Header reads per task run this many at a time: each is one small read,
# so on an object store the time is latency, which threads overlap.
HEADER_READ_THREADS = 8


def _read_headers(batches):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=HEADER_READ_THREADS) as pool:
        for pdf in batches:
            paths = list(pdf["path"])
            yield pd.DataFrame({"path": paths, "header": list(pool.map(_first_record, paths))})


def _children(path: str) -> list[tuple[str, bool]]:
    """The entries of a folder: path, and whether it is a folder itself. A file is its own entry."""
    if path.startswith("file:") or "://" not in path:
        local = "/" + path[5:].lstrip("/") if path.startswith("file:") else os.path.abspath(path)
        if not os.path.isdir(local):
            return [("file:" + local, False)]
        with os.scandir(local) as entries:
            return [("file:" + e.path, e.is_dir()) for e in entries]
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    scheme = path[:len(path) - len(inner)] if path.endswith(inner) else path.split("://")[0] + "://"
    if filesystem.get_file_info(inner).type != fs.FileType.Directory:
        return [(path, False)]
    return [(scheme + i.path, i.type == fs.FileType.Directory) for i in filesystem.get_file_info(fs.FileSelector(inner))]


def _list_level(glob: str):
    """The files that match ``glob``, and the folders, of each given folder.
    Names that start with ``_`` or ``.`` are no data, as for any Spark scan."""
    def run(batches):
        for pdf in batches:
            found = [c for path in pdf["path"] for c in _children(path)]
            found = [(p, d) for p, d in found if (name := p.rstrip("/").rsplit("/", 1)[-1])[:1] not in ("_", ".") and (d or not glob or fnmatch(name, glob))]
            yield pd.DataFrame(found, columns=["path", "folder"])
    return run


def list_files(spark: SparkSession, paths, glob: str = "*.csv") -> DataFrame:
    """One row per file (``path``), empty files included, from tasks that list
    one level of folders at a time; the driver sees the given paths only."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    level = spark.createDataFrame([(p,) for p in paths], "path string")
    found = None
    while True:
        listed = level.mapInPandas(_list_level(glob), "path string, folder boolean").persist(StorageLevel.MEMORY_AND_DISK)
        files = listed.where("not folder").select("path")
        found = files if found is None else found.unionByName(files)
        if listed.where("folder").isEmpty():
            return found.repartition(spark.sparkContext.defaultParallelism)
        level = listed.where("folder").select("path").repartition(spark.sparkContext.defaultParallelism)


def canonical_path(path: str) -> str:
    """``file:///x`` and ``file:/x`` name the same file; Spark's scan
    metadata uses the short form."""
    return re.sub(r"^file:/+", "file:/", path)


def batch_id_of(path: Column, suffix: str = ".csv") -> Column:
    """The ``batch_id=`` folder that the file lies in, if there is one (a
    landing folder written by partition), else the file name without its
    suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.regexp_extract(path, "/batch_id=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_replace(name, F.lit(re.escape(suffix) + "$"), F.lit("")))


def observed_from_header(header: Column, type_overrides: dict | None = None) -> Column:
    """Pair header names with declared types; a name without one is ``string``.
    Overrides for names absent from the header are ignored."""
    if type_overrides:
        kv = []
        for k, v in type_overrides.items():
            kv += [F.lit(k), F.lit(v)]
        types = F.create_map(*kv)
        typ = lambda n: F.coalesce(F.element_at(types, n), F.lit("string"))
    else:
        typ = lambda n: F.lit("string")
    return F.transform(header, lambda n: F.struct(n.alias("name"), typ(n).alias("data_type")))


def observe_headers(spark: SparkSession, paths, dataset: str, type_overrides: dict | None = None,
                    batch_ids: dict | None = None, glob: str = "*.csv") -> DataFrame:
    """(dataset, batch_id, bronze_path, header, observed_schema), one row per file.

    ``batch_ids`` maps a file name to a batch id; by default the id is the
    file name without ``.csv``. An empty file has an empty header.
    """
    files = list_files(spark, paths, glob)
    headers = files.mapInPandas(_read_headers, HEADER_SCHEMA)
    if batch_ids:
        kv = []
        for k, v in batch_ids.items():
            kv += [F.lit(k), F.lit(v)]
        name = F.element_at(F.split("path", "/"), -1)
        bid = F.coalesce(F.element_at(F.create_map(*kv), name), batch_id_of(F.col("path")))
    else:
        bid = batch_id_of(F.col("path"))
    return headers.select(
        F.lit(dataset).alias("dataset"),
        bid.alias("batch_id"),
        F.col("path").alias("bronze_path"),
        "header",
        observed_from_header(F.col("header"), type_overrides).alias("observed_schema"),
    )


class CsvFeed:
    """Row source for the gate over CSV batches, one scan for all of them.

    ``headers``: ``"file"`` reads each allowed file's header again (one record
    per file, in the tasks), because a sidecar may declare names in another
    order than the file has; a file whose header differs, as a set of names,
    from what was recorded for its batch is not read but reported by
    ``holds``, and the gate holds the batch instead of promoting NULLs.
    ``"recorded"`` takes the recorded names as the header, for feeds whose
    observation read the files themselves (``observe_headers``).

    ``multi_line``: True keeps line breaks inside quoted values (as Python's
    csv does) with Spark's reader, one task per file; ``"split"`` keeps them
    and cuts large files into splits (two passes, see ``quoted_lines``); False
    is for feeds that guarantee one record per line, in splits.

    ``large_files`` says that files fill their splits, so that a split holds
    one batch and the layer write needs no shuffle.
    """

    takes_columns = True

    def __init__(self, spark: SparkSession, observed: DataFrame | None = None, multi_line: bool | str = True,
                 headers: str = "file", large_files: bool = False):
        if headers not in ("file", "recorded"):
            raise ValueError("headers must be 'file' or 'recorded'")
        self.spark = spark
        self.observed = observed
        self.multi_line = multi_line
        self.headers = headers
        self.clustered_by_batch = large_files
        self._holds: dict[str, DataFrame] = {}

    def positional(self, paths, width: int) -> DataFrame:
        """``_file_path`` and the values of every record, ``_values``, by position."""
        names = [f"c{i}" for i in range(width)]
        schema = ", ".join(f"{c} string" for c in names)
        if self.multi_line == "split":
            rows = quoted_lines.read_records(self.spark, paths)
            parsed = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
            rows = rows.select(F.col("path").alias("_file_path"), parsed.alias("r")).select("_file_path", "r.*")
        else:
            reader = (self.spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"')
                      .option("multiLine", bool(self.multi_line)).option("mode", "PERMISSIVE"))
            rows = reader.csv(list(paths)).select(F.col("_metadata.file_path").alias("_file_path"), *names)
        return rows.select(F.regexp_replace("_file_path", r"^file:/+", "file:/").alias("_file_path"), F.array(*names).alias("_values"))

    def holds(self, dataset: str) -> DataFrame | None:
        """(batch_id, reason) of the allowed batches the last call did not read."""
        return self._holds.get(dataset)

    def _files(self, dataset: str, allowed: DataFrame) -> DataFrame:
        """batch_id, bronze_path, header and whether it is the declared one."""
        if {"bronze_path", "observed_schema"} <= set(allowed.columns):
            declared = allowed.select("batch_id", "bronze_path", F.transform("observed_schema", lambda x: x["name"]).alias("declared"))
        else:
            declared = (self.observed.where(F.col("dataset") == dataset)
                        .join(allowed.select("batch_id"), "batch_id", "left_semi")
                        .select("batch_id", "bronze_path", F.col("header").alias("declared")))
        if self.headers == "recorded":
            return declared.select("batch_id", "bronze_path", F.col("declared").alias("header"), F.lit(True).alias("same"))
        actual = declared.select(F.col("bronze_path").alias("path")).distinct().mapInPandas(_read_headers, HEADER_SCHEMA)
        same = F.array_sort(F.array_distinct("declared")) == F.array_sort(F.array_distinct("header"))
        return declared.join(actual, declared["bronze_path"] == actual["path"]).select("batch_id", "bronze_path", "header", same.alias("same"))

    def __call__(self, dataset: str, allowed: DataFrame, columns=None) -> DataFrame:
        """Rows of the allowed batches with ``columns`` (by default every name
        that a header has) and ``batch_id``; a name that a file lacks is NULL,
        of a name that a header repeats the last counts."""
        picked = self._files(dataset, allowed).persist(StorageLevel.MEMORY_AND_DISK)
        self._holds[dataset] = picked.where(~F.col("same")).select("batch_id", F.lit("header_mismatch").alias("reason"))
        good = picked.where("same")
        width = good.agg(F.max(F.size("header"))).first()[0] or 0
        if columns is None:
            columns = [r[0] for r in good.select(F.explode("header").alias("n")).distinct().orderBy("n").toLocalIterator()]
        # the paths go where Spark's file index keeps them for any scan
        paths = [r[0] for r in good.select("bronze_path").distinct().toLocalIterator()]
        if not paths or not width:
            return self.spark.createDataFrame([], ", ".join([*(f"`{c}` string" for c in columns), "batch_id string"]))
        last = [F.size("header") - F.nullif(F.array_position(F.reverse("header"), c).cast("int"), F.lit(0)) for c in columns]
        files = good.select("bronze_path", "batch_id", F.array(*last).cast("array<int>").alias("_places")).distinct()
        rows = self.positional(paths, width).join(files, F.col("_file_path") == F.col("bronze_path"))
        return rows.select(*(F.get("_values", F.get("_places", F.lit(i))).alias(c) for i, c in enumerate(columns)), "batch_id")


def observe_sidecars(spark: SparkSession, paths, dataset: str, suffix: str = ".schema.json") -> DataFrame:
    """Observed schemas declared by JSON sidecars ``<batch>.schema.json``
    (an array of ``{"name", "data_type"}``), read whole, one row per file. A
    sidecar in a ``batch_id=`` folder belongs to that batch. ``bronze_path``
    is the CSV file beside it (see ``pair_with_files`` for other places)."""
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).text(list(paths), wholetext=True)
    path = F.col("_metadata.file_path")
    bid = batch_id_of(path, suffix)
    csv_path = F.regexp_replace(path, F.lit(re.escape(suffix) + "$"), F.lit(".csv"))
    return raw.select(
        F.lit(dataset).alias("dataset"),
        bid.alias("batch_id"),
        csv_path.alias("bronze_path"),
        F.from_json("value", "array<struct<name:string,data_type:string>>").alias("observed_schema"),
    ).select("dataset", "batch_id", "bronze_path",
             F.transform("observed_schema", lambda x: x["name"]).alias("header"), "observed_schema")


def pair_with_files(sidecars: DataFrame, files: DataFrame) -> DataFrame:
    """Sidecar observations with the path of their batch's data file, which
    may lie anywhere; a batch without a file is left out (it has not come)."""
    data = files.select(batch_id_of(F.col("path")).alias("batch_id"), F.col("path").alias("bronze_path"))
    return sidecars.drop("bronze_path").join(data, "batch_id").select("dataset", "batch_id", "bronze_path", "header", "observed_schema")
