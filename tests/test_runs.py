"""Runs called again, errors of many batches, value safety of any session, and the stream."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeward.operators import audit as A
from lakeward.operators import contracts as C
from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.streaming import file_gate as S

FIELDS = (C.FieldContract("id", "bigint"), C.FieldContract("day", "date", required=False))


def contract(dataset="claims", layer="silver"):
    return C.Contract(dataset, layer, 1, FIELDS, (), "me", "2026-09-01T00:00:00+00:00")


def feed(spark, batches, dataset="claims"):
    """Observed relation and row source of {batch_id: [(id, day), ...]}."""
    header = [("id", "bigint"), ("day", "date")]
    observed = spark.createDataFrame([(dataset, b, f"in/{b}.csv", header) for b in batches],
                                     "dataset string, batch_id string, bronze_path string, observed_schema array<struct<name:string,data_type:string>>")
    rows = spark.createDataFrame([(i, d, b) for b, r in batches.items() for i, d in r], "id string, day string, batch_id string")
    return observed, lambda _, allowed: rows


GOOD = {"one": [("1", "2026-01-01"), ("2", "2026-01-02")], "two": [("3", "2026-01-03"), ("4", None)]}


def silver(spark, names, dataset="claims"):
    t = spark.table(names.silver(dataset))
    return {r["batch_id"]: r["n"] for r in t.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}


def test_new_batches_under_an_existing_run_id(spark, names):
    TB.register_contracts(spark, [contract()], names)
    G.gate_batches(spark, *feed(spark, {"one": GOOD["one"]}), names=names, run_id="daily")
    result = G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="daily")
    assert result.count("allow") == 2
    assert sorted(r[0] for r in spark.table(names.audit).select("batch_id").collect()) == ["one", "two"]
    assert silver(spark, names) == {"one": 2, "two": 2}
    # another run of the same batch appends (a replay)
    G.gate_batches(spark, *feed(spark, {"one": GOOD["one"]}), names=names, run_id="other")
    assert silver(spark, names) == {"one": 4, "two": 2}


def test_half_written_audit_is_completed(spark, names):
    TB.register_contracts(spark, [contract()], names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r")
    half = spark.table(names.audit).where("batch_id = 'one'").collect()
    schema = spark.table(names.audit).schema
    spark.sql(f"TRUNCATE TABLE {names.audit}")
    spark.createDataFrame(half, schema).write.mode("append").partitionBy("run_id").format("parquet").saveAsTable(names.audit)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r", on_replay="replace")
    assert sorted(r[0] for r in spark.table(names.audit).select("batch_id").collect()) == ["one", "two"]
    assert silver(spark, names) == {"one": 2, "two": 2}


def test_retry_after_bronze_lands_nothing_twice(spark, names):
    TB.register_contracts(spark, [contract()], names)
    with pytest.raises(A.MetadataLeakError) as refused:
        G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r", banned_patterns=["^one$|\none\n"])
    assert refused.value.total == 1 and [r["batch_id"] for r in refused.value.found.collect()] == ["one"]
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r")
    assert spark.table(names.bronze).count() == spark.table(names.audit).count() == 2
    assert silver(spark, names) == {"one": 2, "two": 2}


def test_a_batch_listed_twice_counts_once(spark, names):
    TB.register_contracts(spark, [contract()], names)
    observed, rows = feed(spark, GOOD)
    G.gate_batches(spark, observed.unionByName(observed), rows, names=names, run_id="r")
    assert spark.table(names.audit).count() == 2 and silver(spark, names) == {"one": 2, "two": 2}


def test_all_held_batches_of_all_feeds_are_told(spark, names):
    bad = {f"b{i:02}": [("x", "2026-01-01")] for i in range(30)}
    TB.register_contracts(spark, [contract("claims"), contract("visits")], names)
    a, rows = feed(spark, bad | GOOD, "claims")
    b, _ = feed(spark, bad | GOOD, "visits")
    with pytest.raises(G.GateRunError) as err:
        G.gate_batches(spark, a.unionByName(b), rows, names=names, run_id="r")
    e = err.value
    assert e.total == 60 and e.held.count() == 60 and len(e.errors) == 2 and e.batch_ids == sorted(bad)
    assert [(x.dataset, x.total, len(x.failures)) for x in e.errors] == [("claims", 30, 30), ("visits", 30, 30)]
    assert e.result.silver_batches == {"claims": 2, "visits": 2}
    # called again, the held batches stay held and nothing is raised for them
    again = G.gate_batches(spark, a.unionByName(b), rows, names=names, run_id="r")
    assert again.errors == [] and silver(spark, names) == {"one": 2, "two": 2}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_never_become_null(spark, names, ansi):
    TB.register_contracts(spark, [contract()], names)
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        observed, rows = feed(spark, GOOD | {"bad": [("abc", "2026-01-01")], "worse": [("5", "not-a-date")]})
        result = G.gate_batches(spark, observed, rows, names=names, run_id="r", raise_errors=False)
        assert [type(e) for e in result.errors] == [G.CastFailureError] and result.errors[0].batch_ids == ["bad", "worse"]
        assert silver(spark, names) == {"one": 2, "two": 2}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def write_file(folder, batch, rows, types=("bigint", "date")):
    with open(os.path.join(folder, batch + ".csv"), "w") as f:
        f.write("id,day\n" + "".join(f"{i},{d}\n" for i, d in rows))
    with open(os.path.join(folder, batch + ".schema.json"), "w") as f:
        f.write('[{"name":"id","data_type":"%s"},{"name":"day","data_type":"%s"}]' % types)


def run_stream(spark, names, folder, checkpoint):
    S.start(spark, folder, "claims", names=names, checkpoint=checkpoint, trigger_once=True, query_name="q_" + names.database).awaitTermination(300)


def test_stream_goes_on_past_a_bad_file_and_a_new_checkpoint(spark, names, scratch):
    TB.register_contracts(spark, [contract()], names)
    folder = os.path.join(scratch, "in")
    os.mkdir(folder)
    write_file(folder, "bad", [("abc", "2026-01-01")])
    run_stream(spark, names, folder, scratch + "/c1")
    write_file(folder, "one", [("1", "2026-01-01")])
    run_stream(spark, names, folder, scratch + "/c1")
    assert silver(spark, names) == {"one": 1}
    assert [r["reason"] for r in spark.table(names.quarantine("claims")).collect()] == ["cast_failure:id"]
    # another checkpoint starts at epoch 0 again: its files are decided, none is lost
    other = os.path.join(scratch, "in2")
    os.mkdir(other)
    write_file(other, "two", [("2", "2026-01-01")])
    run_stream(spark, names, other, scratch + "/c2")
    assert silver(spark, names) == {"one": 1, "two": 1}


def test_stream_needs_a_checkpoint(spark, names, scratch):
    with pytest.raises(ValueError, match="checkpoint"):
        S.start(spark, scratch, "claims", names=names, checkpoint="")


def test_release_of_a_list_is_pruned(spark, names):
    TB.register_contracts(spark, [contract(), contract(layer="gold")], names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r")
    with pytest.raises(G.NoSilverRowsError) as err:
        G.release_gold(spark, "claims", ["one", "none"], names=names)
    assert err.value.batch_ids == ["none"] and err.value.total == 1
    assert G.release_gold(spark, "claims", ["one"], names=names) == 1
    assert spark.createDataFrame(pa.table({"batch_id": ["one"]})).count() == 1
