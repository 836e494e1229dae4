"""Row path: admitted batches -> contract columns, cast to contract types.

Writes use the contract's column list, never the incoming header. Names are
compared as data and resolved with backticks, so ``a.b`` is a column and not
a struct path, and a header that differs only in case never resolves to a
contract column by accident (the gate has already refused such a batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions import types as ty

class ProjectionError(ValueError):
    """Rows lack a contract column."""


def admitted(rows: DataFrame, allowed: DataFrame, n_allowed: int | None = None) -> DataFrame:
    """Rows of allowed batches only (left semi-join on ``batch_id``).

    ``allowed`` is one row per batch; its size decides, in the planner and
    again at run time, whether it is broadcast or shuffled (a hot batch is
    then split by the adaptive skew join). No job runs here. ``n_allowed``
    is accepted for callers that know it and is not needed."""
    return rows.join(allowed.select("batch_id"), "batch_id", "left_semi")


# Texts that project_to_contract raises with; the gate holds the batch then.
REQUIRED_NULL_MARKER = "LAKEWARD_REQUIRED_NULL"
CAST_MARKER = "LAKEWARD_CAST_FAILURE"


def project_to_contract(rows: DataFrame, fields, *, cast: bool = True,
                        batch_column: str | None = "batch_id", enforce_required: bool = False) -> DataFrame:
    """Contract columns in contract order, cast to the contract types.

    A value that does not cast fails the job, whether the session's casts are
    ANSI or not; it never becomes NULL. With ``enforce_required`` a NULL in a required field fails the job (as a
    NOT NULL column would), which the gate turns into a per-batch hold.
    """
    present = set(rows.columns)
    missing = [f.name for f in fields if f.name not in present]
    if missing:
        raise ProjectionError(f"Cannot project contract columns; missing {missing}")
    casts = {f.name for f in needs_cast(rows, fields)}
    cols = []
    for f in fields:
        c = F.col(ty.quote(f.name))
        if cast and f.name in casts:
            to = ty.spark_sql_type(f.data_type)
            safe = c.try_cast(to)
            c = F.when(c.isNotNull() & safe.isNull(), F.raise_error(F.lit(f"{CAST_MARKER}: {f.name}")).cast(to)).otherwise(safe)
        if enforce_required and f.required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{REQUIRED_NULL_MARKER}: {f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    if batch_column:
        cols.append(F.col(batch_column))
    return rows.select(*cols)


def needs_cast(rows: DataFrame, fields) -> list:
    """Contract fields whose source column type differs from the target."""
    dtypes = dict(rows.dtypes)
    return [f for f in fields if ty.normalize(dtypes.get(f.name, "")) != ty.spark_sql_type(f.data_type)]


def required_nulls(rows: DataFrame, fields) -> DataFrame:
    """Per (batch_id, column): NULLs in required fields (> 0 only)."""
    required = [f for f in fields if f.required]
    if not required:
        return rows.sparkSession.createDataFrame([], "batch_id string, column_name string, failures bigint")
    per_batch = rows.groupBy("batch_id").agg(
        *[F.count_if(F.col(ty.quote(f.name)).isNull()).alias(f"n{i}") for i, f in enumerate(required)])
    stacked = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("failures"))
                                  for i, f in enumerate(required)]))
    return (per_batch.select("batch_id", stacked.alias("s"))
            .select("batch_id", "s.column_name", F.col("s.failures").cast("bigint").alias("failures"))
            .where("failures > 0"))


def cast_failures(rows: DataFrame, fields) -> DataFrame:
    """Per (batch_id, column): values present but rejected by ``try_cast``.

    One aggregation with map-side partial counts, over only the columns
    whose type changes; a batch holding most rows is combined per task
    before the shuffle. Returns batch_id, column_name, failures (> 0 only).
    """
    to_check = needs_cast(rows, fields)
    if not to_check:
        return rows.sparkSession.createDataFrame([], "batch_id string, column_name string, failures bigint")
    aggs = [
        F.count_if(
            F.col(ty.quote(f.name)).isNotNull()
            & F.col(ty.quote(f.name)).try_cast(ty.spark_sql_type(f.data_type)).isNull()
        ).alias(f"f{i}")
        for i, f in enumerate(to_check)
    ]
    per_batch = rows.groupBy("batch_id").agg(*aggs)
    stacked = F.explode(
        F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"f{i}").alias("failures"))
                  for i, f in enumerate(to_check)])
    )
    return (
        per_batch.select("batch_id", stacked.alias("s"))
        .select("batch_id", "s.column_name", F.col("s.failures").cast("bigint").alias("failures"))
        .where("failures > 0")
    )


# Column of staged rows: the checks that a row fails, as ``kind:column``.
FAILED = "_failed_checks"


def checked_projection(rows: DataFrame, fields, *, enforce_required: bool = False) -> DataFrame:
    """The contract projection with failing values as NULL and, beside them,
    ``FAILED``: an array with ``cast_failure:<column>`` for each value that
    ``try_cast`` rejects and, with ``enforce_required``, ``required_null:<column>``
    for each NULL in a required field; NULL where the row passes. One
    projection, so the rows are read once."""
    present = set(rows.columns)
    missing = [f.name for f in fields if f.name not in present]
    if missing:
        raise ProjectionError(f"Cannot project contract columns; missing {missing}")
    casts = {f.name for f in needs_cast(rows, fields)}
    columns, checks = [], []
    for f in fields:
        c = F.col(ty.quote(f.name))
        if f.name in casts:
            safe = c.try_cast(ty.spark_sql_type(f.data_type))
            checks.append(F.when(c.isNotNull() & safe.isNull(), F.lit(f"cast_failure:{f.name}")))
            columns.append(safe.alias(f.name))
        else:
            columns.append(c.alias(f.name))
        if enforce_required and f.required:
            checks.append(F.when(c.isNull(), F.lit(f"required_null:{f.name}")))
    failed = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return rows.select(*columns, "batch_id", F.when(F.size(failed) > 0, failed).alias(FAILED))


def staged_failures(staged: DataFrame) -> DataFrame:
    """Per (batch_id, kind, column_name): failing values of staged rows. Reads
    two columns; rows that pass are filtered in the scan."""
    one = staged.where(F.col(FAILED).isNotNull()).select("batch_id", F.explode(FAILED).alias("check"))
    return one.groupBy("batch_id", "check").agg(F.count(F.lit(1)).alias("failures")).select(
        "batch_id", F.substring_index("check", ":", 1).alias("kind"),
        F.expr("substring(check, instr(check, ':') + 1)").alias("column_name"), "failures")
