"""Schema diff and decision, set-based over many batches at once.

Input ``observed`` has one row per batch: ``dataset``, ``batch_id`` and
``observed_schema`` (``array<struct<name,data_type>>`` in header order, a
repeated name allowed). It is joined to the active contract of its dataset;
the planner broadcasts the contracts when their size allows it. The diff
itself is per-row array work, with no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions import exprs as X
from lakeward.operators import contracts as C

OBSERVED_TYPE = "array<struct<name:string,data_type:string>>"


def observed_fields(observed: DataFrame) -> DataFrame:
    """One row per (batch, name) after last-wins de-duplication, with the
    1-based position of the surviving occurrence."""
    dedup = X.dedup_last_wins(F.coalesce(F.col("observed_schema"), F.array().cast(OBSERVED_TYPE)))
    return observed.select("dataset", "batch_id", F.explode(dedup).alias("f")).select(
        "dataset", "batch_id", F.col("f.ordinal").alias("ordinal"),
        F.col("f.name").alias("name"), F.col("f.data_type").alias("data_type"),
    )


def _contract_frame(observed: DataFrame, active) -> DataFrame:
    """Contracts as a relation, whether given as rows (a dict by dataset or a
    list) or as one."""
    if isinstance(active, DataFrame):
        return active
    rows = list(active.values()) if isinstance(active, dict) else list(active)
    return C.active_frame(observed.sparkSession, rows)


def schema_diff(observed: DataFrame, active) -> DataFrame:
    """Attach the active contract and the diff to every batch.

    ``active`` is a contracts DataFrame, or contract rows (a dict by dataset
    or a list). Adds ``contract_version``,
    ``expected_schema`` (name, data_type), ``allowed_changes``,
    ``added_fields``, ``missing_fields`` (sorted names) and
    ``changed_fields`` (sorted ``struct<name,expected,observed>``). Batches
    of a dataset without a contract are dropped here; the gate refuses such
    a run before it gets this far.
    """
    contract = _contract_frame(observed, active).select("dataset", "layer", "contract_version", "approved_schema", "allowed_changes")
    joined = observed.join(contract, "dataset", "inner")
    obs = X.dedup_last_wins(F.coalesce(F.col("observed_schema"), F.array().cast(OBSERVED_TYPE)))
    with_obs = joined.withColumn("_obs", obs)
    obs_names = X.names_of(F.col("_obs"))
    exp_names = X.names_of(F.col("approved_schema"))
    obs_pairs = X.pairs_of(F.col("_obs"))
    exp_pairs = X.pairs_of(F.col("approved_schema"))
    return (
        with_obs.withColumn("expected_schema", exp_pairs)
        .withColumn("added_fields", X.added_fields(obs_names, exp_names))
        .withColumn("missing_fields", X.missing_fields(obs_names, exp_names))
        .withColumn("changed_fields", X.changed_fields(obs_pairs, exp_pairs, exp_names))
        .drop("_obs", "approved_schema")
    )


def decide(diff: DataFrame) -> DataFrame:
    """Add ``decision`` (allow / quarantine) and ``reason`` to a diff relation."""
    return diff.withColumn(
        "decision",
        X.decision(F.col("added_fields"), F.col("missing_fields"), F.col("changed_fields"),
                   F.col("allowed_changes")),
    ).withColumn("reason", X.reason(F.col("added_fields"), F.col("missing_fields"), F.col("changed_fields")))


def gate_decisions(observed: DataFrame, active) -> DataFrame:
    return decide(schema_diff(observed, active))
