"""Scale behaviour: a hot batch is split across tasks and files; a large
allowed set falls back from broadcast to a shuffle join with the same rows."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from lakeward.operators import diff as D
from lakeward.operators import project as P
from lakeward.operators import tables as TB
from lakeward.operators.contracts import FieldContract


def test_hot_batch_is_split_on_write(spark, names):
    fields = (FieldContract("id", "bigint"), FieldContract("pad", "string"))
    rows = spark.range(0, 400_000, numPartitions=8).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("cold-"), (F.col("id") % 7).cast("string")))
        .otherwise(F.lit("hot")).alias("batch_id"))
    table = names.silver("skew")
    TB.ensure_table(spark, table, fields)
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * 1024 * 1024))
    try:
        TB.append_batches(P.project_to_contract(rows, fields), table)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    files = spark.table(table).select(F.input_file_name().alias("f"), "batch_id").distinct()
    per_batch = {r["batch_id"]: r["n"] for r in files.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert per_batch["hot"] > 1                       # the hot batch was written by several tasks
    assert spark.table(table).count() == 400_000       # nothing dropped
    assert spark.table(table).where("batch_id = 'hot'").count() == 360_000


def test_large_allowed_set_shuffles(spark):
    rows = spark.range(0, 50_000).select(F.col("id"), (F.col("id") % 997).cast("string").alias("batch_id"))
    allowed = spark.range(0, 997, 2).select(F.col("id").cast("string").alias("batch_id"))
    small = P.admitted(rows, allowed)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = P.admitted(rows, allowed)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert sorted(r[0] for r in large.select("id").collect()) == sorted(r[0] for r in small.select("id").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_many_contracts_plan_quickly(spark):
    """5,000 contracts of 50 fields are a relation, not a plan of literals."""
    field = [{"name": f"f{i}", "data_type": "string", "required": True} for i in range(50)]
    rows = [{"dataset": f"d{i}", "layer": "silver", "contract_version": 1, "approved_schema": field, "required_fields": [],
             "allowed_changes": [], "owner": None, "approved_at": None} for i in range(5_000)]
    observed = spark.range(0, 5_000, 100).select(
        F.concat(F.lit("d"), "id").alias("dataset"), F.lit("b").alias("batch_id"),
        F.array(*[F.struct(F.lit(f["name"]).alias("name"), F.lit("string").alias("data_type")) for f in field[:49]]).alias("observed_schema"))
    began = time.time()
    decided = D.gate_decisions(observed, rows)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 10 and len(plan) < 100_000
    got = decided.select("decision", "missing_fields").distinct().collect()
    assert [(r["decision"], r["missing_fields"]) for r in got] == [("quarantine", ["f49"])]


def test_decision_adds_no_shuffle(spark):
    """The decision over all day batches broadcasts the contracts; its only
    other exchange is the distinct of the order dates."""
    from lakeward.plans import reports as R

    plan = R.gate_decision(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "BroadcastExchange" in plan
