"""Catalog tables of the gate: control tables, layer tables, writers.

Layer tables are Parquet tables partitioned by ``batch_bucket``, a hash of
the batch id over a number of buckets that the table keeps as a property.
Rows are clustered by batch within a bucket, so a batch's rows are found by
bucket and by the statistics of the files, and the number of files follows
the bytes, not the number of batches. An added column reaches a table only
through ``ALTER TABLE ... ADD COLUMNS`` for a field an approved contract
lists; appends are by name and refuse any other difference, so nothing
evolves silently.

The release ledger has one row per step of every layer write: which run wrote
which batch under which contract version, and for gold which silver write it
released. A release looks there for what is still to do.
"""

from __future__ import annotations

import os
import re
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import types as ty
from lakeward.operators import contracts as C


class TableEvolutionError(ValueError):
    """A table column would need a retype, which evolution never does."""


@dataclass(frozen=True)
class TableNames:
    """Where the gate keeps its tables; ``database`` qualifies every name."""

    database: str | None = None
    contracts_table: str = "schema_contracts"
    audit_table: str = "schema_audit_events"
    ledger_table: str = "schema_release_ledger"
    #: Buckets of layer tables that are created under these names.
    layer_buckets: int = 16

    def q(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    @property
    def contracts(self) -> str:
        return self.q(self.contracts_table)

    @property
    def audit(self) -> str:
        return self.q(self.audit_table)

    @property
    def ledger(self) -> str:
        return self.q(self.ledger_table)

    @property
    def bronze(self) -> str:
        return self.q("bronze_observed")

    def quarantine(self, dataset: str) -> str:
        return self.q(f"quarantine_{dataset}")

    def silver(self, dataset: str) -> str:
        return self.q(f"silver_{dataset}")

    def gold(self, dataset: str) -> str:
        return self.q(f"gold_{dataset}")

    def layer(self, layer: str, dataset: str) -> str:
        return self.silver(dataset) if layer == "silver" else self.gold(dataset)


_FIELDS = "array<struct<name:string,data_type:string>>"
_CHANGED = "array<struct<name:string,expected:string,observed:string>>"


def ensure_control_tables(spark: SparkSession, names: TableNames = TableNames()) -> None:
    if names.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.database}")
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {names.contracts} (
            dataset STRING, layer STRING, contract_version INT,
            approved_schema ARRAY<STRUCT<name:STRING,data_type:STRING,required:BOOLEAN>>,
            required_fields ARRAY<STRING>, allowed_changes ARRAY<STRING>,
            owner STRING, approved_at TIMESTAMP) USING PARQUET"""
    )
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {names.audit} (
            event_id STRING, dataset STRING, layer STRING, batch_id STRING,
            expected_schema {_FIELDS}, observed_schema {_FIELDS},
            added_fields ARRAY<STRING>, missing_fields ARRAY<STRING>, changed_fields {_CHANGED},
            decision STRING, contract_version INT, event_time TIMESTAMP, bronze_path STRING,
            call_id STRING, run_id STRING) USING PARQUET PARTITIONED BY (run_id)"""
    )
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {names.ledger} (
            batch_id STRING, contract_version INT, run_id STRING, stamp STRING, source_stamp STRING,
            mode STRING, state STRING, recorded_at TIMESTAMP, dataset STRING, layer STRING)
            USING PARQUET PARTITIONED BY (dataset, layer)"""
    )


# Feeds are promoted by several threads: appends to a table that they share,
# and writes under a session setting, take turns.
_SHARED_TABLE, _OVERWRITE = threading.Lock(), threading.Lock()

STARTED, DONE = "started", "done"
APPEND, REPLACE, SKIP = "append", "replace", "skip"


def record(spark: SparkSession, moves: DataFrame, names: TableNames, state: str) -> None:
    """Append one ledger row per row of ``moves`` (dataset, layer, batch_id,
    contract_version, run_id, stamp, source_stamp, mode)."""
    clock = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    rows = moves.select("batch_id", F.col("contract_version").cast("int"), "run_id", "stamp", "source_stamp", "mode", F.lit(state).alias("state"),
                        clock.alias("recorded_at"), "dataset", "layer")
    with _SHARED_TABLE:
        rows.write.mode("append").partitionBy("dataset", "layer").format("parquet").saveAsTable(names.ledger)


def ledger_of(spark: SparkSession, names: TableNames, dataset: str, layer: str) -> DataFrame:
    spark.catalog.refreshTable(names.ledger)
    return spark.table(names.ledger).where((F.col("dataset") == dataset) & (F.col("layer") == layer))


def latest_moves(ledger: DataFrame) -> DataFrame:
    """Per batch the last ledger row: contract_version, stamp, source_stamp, state."""
    row = F.struct("contract_version", "run_id", "stamp", "source_stamp", "state")
    order = F.struct("recorded_at", F.col("state") == DONE)
    return ledger.groupBy("batch_id").agg(F.max_by(row, order).alias("m")).select("batch_id", "m.*")


def releasable(spark: SparkSession, requested: DataFrame, names: TableNames, dataset: str, version: int, on_replay: str) -> DataFrame:
    """(batch_id, source_stamp, mode): what a release of ``requested`` has to
    do. A batch whose last silver write is in gold under this contract version
    is skipped; one that gold has in another state (an older silver write,
    another version, a release that was not finished) is replaced; one that
    gold does not have is appended, or replaced if asked for."""
    silver = latest_moves(ledger_of(spark, names, dataset, "silver").where(F.col("state") == DONE)) \
        .select("batch_id", F.col("stamp").alias("source_stamp"))
    gold = latest_moves(ledger_of(spark, names, dataset, "gold")).select(
        "batch_id", F.col("contract_version").alias("_version"), F.col("source_stamp").alias("_source"), F.col("state").alias("_state"))
    same = (F.col("_state") == DONE) & (F.col("_version") == version) & F.col("_source").eqNullSafe(F.col("source_stamp"))
    mode = F.when(same, SKIP).when(F.col("_state").isNotNull(), REPLACE).otherwise(on_replay)
    return requested.select("batch_id").join(silver, "batch_id", "left").join(gold, "batch_id", "left") \
        .select("batch_id", "source_stamp", mode.alias("mode"))


def ensure_bronze(spark: SparkSession, names: TableNames = TableNames()) -> None:
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {names.bronze} (
            batch_id STRING, bronze_path STRING, observed_schema {_FIELDS}, run_id STRING,
            observed_at TIMESTAMP, dataset STRING) USING PARQUET PARTITIONED BY (dataset)"""
    )


def land_observed(spark: SparkSession, observed: DataFrame, run_id: str, observed_at,
                  names: TableNames = TableNames()) -> None:
    """Keep the observed schema of every landed batch (files stay where
    they landed). One append per call, partitioned by dataset; a batch listed
    twice is kept once (its smallest path and schema). Across runs the latest
    observation of a batch id wins (``latest_observed``)."""
    ensure_bronze(spark, names)
    if "bronze_path" not in observed.columns:
        observed = observed.withColumn("bronze_path", F.lit(None).cast("string"))
    observed = observed.groupBy("dataset", "batch_id").agg(F.min(F.struct("bronze_path", "observed_schema")).alias("o")) \
        .select("dataset", "batch_id", "o.*")
    bronze = F.col("bronze_path") if "bronze_path" in observed.columns else F.lit(None).cast("string")
    observed.select(
        "batch_id", bronze.alias("bronze_path"),
        F.transform("observed_schema", lambda x: F.struct(x["name"].alias("name"),
                                                          x["data_type"].alias("data_type"))).alias("observed_schema"),
        F.lit(run_id).alias("run_id"), F.lit(observed_at).cast("timestamp").alias("observed_at"), "dataset",
    ).write.mode("append").partitionBy("dataset").format("parquet").saveAsTable(names.bronze)


def latest_observed(spark: SparkSession, names: TableNames = TableNames()) -> DataFrame:
    """Latest observation per (dataset, batch_id): a re-landed batch id
    replaces the earlier one."""
    t = spark.table(names.bronze)
    return t.groupBy("dataset", "batch_id").agg(
        F.max_by(F.struct("bronze_path", "observed_schema", "run_id", "observed_at"), "observed_at").alias("o")
    ).select("dataset", "batch_id", "o.*")


def ensure_quarantine_table(spark: SparkSession, table: str) -> None:
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            batch_id STRING, decision STRING, added_fields ARRAY<STRING>, missing_fields ARRAY<STRING>,
            changed_fields {_CHANGED}, bronze_path STRING, event_time TIMESTAMP, run_id STRING,
            reason STRING) USING PARQUET"""
    )


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def register_contracts(spark: SparkSession, contracts, names: TableNames = TableNames()) -> int:
    """Append contract versions that are not registered yet.

    Re-registering an identical version is a no-op; a different contract
    under an existing (dataset, layer, version) is refused, so the active
    version is never ambiguous. Returns the number of versions added.
    """
    ensure_control_tables(spark, names)
    contracts = list(contracts)
    keys = {(c.dataset, c.layer, int(c.version)) for c in contracts}
    if len(keys) != len(contracts):
        raise C.ContractError("The same (dataset, layer, version) is listed twice")
    existing = {
        (r["dataset"], r["layer"], r["contract_version"]): r
        for r in spark.table(names.contracts)
        .where(F.col("dataset").isin(sorted({c.dataset for c in contracts})))
        .collect()
    }
    new = []
    for c in contracts:
        key = (c.dataset, c.layer, int(c.version))
        if key in existing:
            old = existing[key]
            same = [(f["name"], f["data_type"], f["required"]) for f in old["approved_schema"]] == [
                (f.name, f.data_type, f.required) for f in c.fields
            ] and list(old["allowed_changes"]) == list(c.allowed_changes)
            if not same:
                raise C.ContractError(f"{c.dataset}.{c.layer} v{c.version} is already registered differently")
            continue
        new.append(c)
    if new:
        C.contracts_frame(spark, new).write.mode("append").saveAsTable(names.contracts)
    return len(new)


def approve(spark: SparkSession, dataset: str, layer: str, fields, allowed_changes=(), owner=None,
            names: TableNames = TableNames(), approved_at=None) -> C.Contract:
    """Insert the next version of a contract; earlier versions stay.

    The version is read and the contract appended under a lock file beside
    the contracts table, so callers at the same time, also in other
    applications, get versions of their own, without gaps."""
    ensure_control_tables(spark, names)
    with contracts_lock(spark, names):
        spark.catalog.refreshTable(names.contracts)
        version = C.next_version(spark.table(names.contracts), dataset, layer)
        contract = C.Contract(dataset, layer, version, tuple(fields), tuple(allowed_changes), owner,
                              approved_at or C.event_clock())
        register_contracts(spark, [contract], names)
    return contract


class LockedError(RuntimeError):
    """The lock file of the contracts table did not go away in time."""


@contextmanager
def contracts_lock(spark: SparkSession, names: TableNames = TableNames(), timeout: float = 300.0):
    """Hold the lock file of the contracts table: made in one atomic step that
    fails if it is there, removed at the end. An application that died while
    it held the lock leaves the file, which the error names."""
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {names.contracts}").where("col_name = 'Location'").first()["data_type"]
    path = f"{where.rstrip('/')}/_contracts.lock"
    local = "/" + path[5:].lstrip("/") if path.startswith("file:") else None
    jvm = spark._jvm
    files = None if local else jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def make() -> bool:
        if local:
            try:
                os.close(os.open(local, os.O_CREAT | os.O_EXCL))
                return True
            except FileExistsError:
                return False
        try:
            files.create(jvm.org.apache.hadoop.fs.Path(path), False).close()
            return True
        except Exception:  # noqa: BLE001 - a store's own error for a file that is there
            if files.exists(jvm.org.apache.hadoop.fs.Path(path)):
                return False
            raise

    end = time.monotonic() + timeout
    while not make():
        if time.monotonic() > end:
            raise LockedError(f"contracts are locked by {path}")
        time.sleep(0.05)
    try:
        yield
    finally:
        if local:
            os.remove(local)
        else:
            files.delete(jvm.org.apache.hadoop.fs.Path(path), False)


def contract_versions(spark: SparkSession, dataset: str, layer: str, names: TableNames = TableNames()) -> list[int]:
    rows = C.contract_history(
        spark.table(names.contracts).where((F.col("dataset") == dataset) & (F.col("layer") == layer))
    ).collect()
    return list(rows[0]["versions"]) if rows else []


BUCKET = "batch_bucket"
_BUCKETS_PROPERTY = "lakeward.buckets"


def ensure_table(spark: SparkSession, table: str, fields, buckets: int = TableNames.layer_buckets) -> list[str]:
    """Create the layer table, or add the contract fields it lacks.

    Never drops, retypes or renames a column. Returns the added names.
    """
    if not table_exists(spark, table):
        columns = ", ".join(f"{ty.quote(f.name)} {f.dataType.simpleString()}" for f in ty.contract_struct(fields).fields)
        spark.sql(f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING PARQUET PARTITIONED BY ({BUCKET}) "
                  f"TBLPROPERTIES ('{_BUCKETS_PROPERTY}' = '{int(buckets)}')")
        return []
    existing = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
    lowered = {n.lower(): n for n in existing}
    added = []
    for f in fields:
        want = ty.spark_sql_type(f.data_type)
        if f.name in existing:
            if existing[f.name] != want:
                raise TableEvolutionError(f"{table}.{f.name} is {existing[f.name]}, contract says {want}")
            continue
        if f.name.lower() in lowered:
            raise TableEvolutionError(f"{table} has {lowered[f.name.lower()]!r}; contract names {f.name!r}")
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ty.quote(f.name)} {want})")
        added.append(f.name)
    if added:
        spark.catalog.refreshTable(table)
    return added


@contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Set session settings for the duration of one write, then restore them."""
    prev = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def buckets_of(spark: SparkSession, table: str) -> int:
    """The number of buckets that the table was created with."""
    value = spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS_PROPERTY}')").first()["value"]
    if not re.fullmatch(r"[0-9]+", value):
        raise ValueError(f"{table} is no layer table: it has no property {_BUCKETS_PROPERTY}")
    return int(value)


def with_bucket(frame: DataFrame, buckets: int) -> DataFrame:
    return frame.withColumn(BUCKET, F.pmod(F.xxhash64("batch_id"), F.lit(buckets)).cast("int"))


def _laid_out(frame: DataFrame, buckets: int, rebalance: bool) -> DataFrame:
    """Rows with their bucket, clustered by batch. The rebalance shuffle makes
    partitions of the advisory size: a bucket above it (a hot batch) is cut
    into several tasks and files, small buckets share a task."""
    frame = with_bucket(frame, buckets)
    if rebalance:
        frame = frame.hint("rebalance", BUCKET)
    return frame.sortWithinPartitions(BUCKET, "batch_id")


def append_batches(frame: DataFrame, table: str, rebalance: bool = True) -> None:
    """Append rows by name to a layer table.

    Without ``rebalance`` no row moves and every input split writes a file for
    each bucket it holds: right for splits that hold one large batch each."""
    spark = frame.sparkSession
    _laid_out(frame, buckets_of(spark, table), rebalance).write.mode("append").partitionBy(BUCKET).format("parquet").saveAsTable(table)


def replace_batches(frame: DataFrame, table: str, rebalance: bool = True, batches: DataFrame | None = None) -> None:
    """Replace exactly the rows of ``batches`` (by default the batch ids in
    ``frame``) by those of ``frame``: the buckets that hold these batches are
    rewritten with the other batches' rows as they are (dynamic partition
    overwrite by name), no other bucket is touched. A batch without rows in
    ``frame`` has none afterwards."""
    spark = frame.sparkSession
    buckets = buckets_of(spark, table)
    ids = (frame if batches is None else batches).select("batch_id").distinct()
    touched = [r[0] for r in with_bucket(ids, buckets).select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    spark.catalog.refreshTable(table)
    kept = spark.table(table).where(F.col(BUCKET).isin(touched)).join(ids, "batch_id", "left_anti").drop(BUCKET)
    if batches is not None:
        # a bucket that nothing is left for is not written, hence emptied here
        left = with_bucket(frame.select("batch_id").unionByName(kept.select("batch_id")), buckets).select(BUCKET).distinct()
        for bucket in set(touched) - {r[0] for r in left.collect()}:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {int(bucket)})")
    view = f"_lakeward_replace_{uuid.uuid4().hex}"
    _laid_out(frame.unionByName(kept, allowMissingColumns=True), buckets, rebalance).createOrReplaceTempView(view)
    try:
        with _OVERWRITE, session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BUCKET}) BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def rows_of_batches(spark: SparkSession, table: str, batches: DataFrame) -> DataFrame:
    """The rows of ``batches`` in a layer table. The join has the bucket among
    its keys, so the scan is pruned to the buckets of these batches."""
    spark.catalog.refreshTable(table)
    ids = with_bucket(batches.select("batch_id").distinct(), buckets_of(spark, table))
    return spark.table(table).join(ids, [BUCKET, "batch_id"], "left_semi").drop(BUCKET)


def reset_tables(spark: SparkSession, datasets, names: TableNames = TableNames()) -> list[str]:
    """Drop exactly the gate's own tables for ``datasets``, with what its runs
    have left of staged rows and of the values that failed."""
    dropped = []
    own = re.compile("|".join(f"(staged|failed_values)_{re.escape(d.lower())}_[0-9a-f]{{12}}" for d in datasets) or "(?!)")
    for t in spark.catalog.listTables(names.database) if names.database else spark.catalog.listTables():
        if own.fullmatch(t.name.lower()):
            spark.sql(f"DROP TABLE IF EXISTS {names.q(t.name)}")
            dropped.append(names.q(t.name))
    for t in [names.contracts, names.audit, names.bronze, names.ledger] + [
        f(d) for d in datasets for f in (names.quarantine, names.silver, names.gold)
    ]:
        if table_exists(spark, t):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
            dropped.append(t)
    return dropped


def layer_counts(spark: SparkSession, dataset: str, names: TableNames = TableNames()) -> DataFrame:
    """Rows per layer (0 for a layer without a table)."""
    parts = []
    for layer in ("silver", "gold"):
        t = names.layer(layer, dataset)
        if table_exists(spark, t):
            parts.append(spark.table(t).agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), "rows"))
        else:
            parts.append(spark.createDataFrame([(layer, 0)], "layer string, rows bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unreleased_columns(spark: SparkSession, table: str, fields) -> list[str]:
    """Columns of a layer table that its contract does not release."""
    allowed = {f.name for f in fields} | {"batch_id", BUCKET}
    return [c for c in spark.table(table).columns if c not in allowed]
