"""Edge fixtures through real files and tables (rules S1-S16, traps T1-T14)."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeward.operators import audit as A
from lakeward.operators import contracts as C
from lakeward.operators import project as P
from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB

import fixtures as FX


def _run(spark, names, folder, **kw):
    obs = CB.observe_headers(spark, folder, "claims", FX.CLEAN_TYPES)
    return G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, **kw)


def _silver(spark, names, batch):
    return spark.table(names.silver("claims")).where(F.col("batch_id") == batch).drop(TB.BUCKET)


@pytest.fixture()
def contracts(spark, names):
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)


def test_mixed_headers_read_by_name(spark, names, scratch, contracts):
    """Two files with different column orders in one run; values
    land under their own names."""
    FX.land(scratch, "clean", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    rev = list(reversed(FX.CLEAN_HEADER))
    FX.land(scratch, "reordered", rev, [list(reversed(r)) for r in FX.CLEAN_ROWS])
    res = _run(spark, names, scratch)
    assert res.count("allow") == 2
    a = sorted(tuple(r) for r in _silver(spark, names, "clean").drop("batch_id").collect())
    b = sorted(tuple(r) for r in _silver(spark, names, "reordered").drop("batch_id").collect())
    assert a == b and a[0][0] == "CLM-1001"


def test_header_only_and_empty_file(spark, names, scratch, contracts):
    """Header only -> allowed, zero rows, release blocked. S14: empty
    file -> every field missing, quarantined."""
    FX.land(scratch, "header_only", FX.CLEAN_HEADER, [])
    FX.land(scratch, "empty", None, [], raw="")
    res = _run(spark, names, scratch)
    assert res.count("allow") == 1 and res.count("quarantine") == 1
    ev = {r["batch_id"]: r for r in spark.table(names.audit).collect()}
    assert sorted(ev["empty"]["missing_fields"]) == sorted(FX.CLEAN_HEADER)
    assert spark.table(names.silver("claims")).count() == 0
    with pytest.raises(G.NoSilverRowsError):
        G.release_gold(spark, "claims", ["header_only"], names=names)


def test_duplicate_header_refused(spark, names, scratch, contracts):
    """A repeated name decides as last-wins, but is never promoted."""
    FX.land(scratch, "dup", FX.CLEAN_HEADER + ["claim_id"], [r + ["X"] for r in FX.CLEAN_ROWS])
    FX.land(scratch, "clean", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    with pytest.raises(G.HeaderCollisionError) as err:
        _run(spark, names, scratch, run_id="dup-run")
    assert err.value.batch_ids == ["dup"]
    assert spark.table(names.silver("claims")).select("batch_id").distinct().collect()[0][0] == "clean"
    # per-batch outcomes of the run, set-based (the reference returns one dict per call)
    res = G.GateResult("dup-run", decisions={("claims", "allow"): 2}, names=names, promote_gold=False)
    out = {r["batch_id"]: r for r in res.outcomes(spark).collect()}
    assert out["dup"]["decision"] == "allow" and out["dup"]["hold"] == "header_collision"
    assert out["dup"]["silver_written"] is False and out["clean"]["silver_written"] is True
    assert out["clean"]["gold_written"] is False and out["clean"]["hold"] is None


def test_ragged_quoted_dotted(spark, names, scratch):
    """Short rows pad NULL, surplus values drop. T3: doubled quotes and
    a newline inside quotes parse as Python's csv does. T8: a dotted name."""
    fields = (C.FieldContract("id", "string"), C.FieldContract("a.b", "string"), C.FieldContract("note", "string"))
    TB.register_contracts(spark, [C.Contract("claims", "silver", 1, fields)], names)
    raw = 'id,a.b,note\n1,x,"say ""hi""\nthere"\n2,y\n3,z,n,extra\n'
    FX.land(scratch, "odd", None, [], raw=raw)
    obs = CB.observe_headers(spark, scratch, "claims")
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names)
    got = {r["id"]: r for r in spark.table(names.silver("claims")).collect()}
    assert got["1"]["note"] == 'say "hi"\nthere'
    assert got["2"]["note"] is None
    assert got["3"]["note"] == "n" and got["3"]["a.b"] == "z"


def test_bad_value_held_others_written(spark, names, scratch, contracts):
    """The sidecar says decimal but a value is '120.50 USD'; the
    batch is held before its silver write, the other batch is written."""
    FX.land(scratch, "bad", FX.CLEAN_HEADER, [FX.CLEAN_ROWS[0][:3] + ["120.50 USD", "paid"]])
    FX.land(scratch, "good", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    with pytest.raises(G.CastFailureError) as err:
        _run(spark, names, scratch)
    assert err.value.failures == [("bad", "billed_amount", 1)]
    batches = {r[0] for r in spark.table(names.silver("claims")).select("batch_id").distinct().collect()}
    assert batches == {"good"}
    # the event was recorded first (allow by declared types); the hold is a
    # quarantine row naming the column, never the value
    assert spark.table(names.audit).where("batch_id = 'bad'").first()["decision"] == "allow"
    held = spark.table(names.quarantine("claims")).collect()
    assert [(r["batch_id"], r["reason"]) for r in held] == [("bad", "cast_failure:billed_amount")]


def test_evolution_and_guards(spark, names):
    """ALTER adds the approved column, old rows read NULL; a retype is
    refused; the contract registry refuses a changed version."""
    t = names.silver("claims")
    TB.ensure_table(spark, t, FX.V1_FIELDS)
    assert TB.ensure_table(spark, t, FX.V1_FIELDS + (FX.PLACE,)) == ["place_of_service"]
    with pytest.raises(TB.TableEvolutionError):
        TB.ensure_table(spark, t, (C.FieldContract("claim_id", "bigint"),))
    TB.register_contracts(spark, [FX.silver_v1()], names)
    assert TB.register_contracts(spark, [FX.silver_v1()], names) == 0
    changed = C.Contract("claims", "silver", 1, FX.V1_FIELDS[:2])
    with pytest.raises(C.ContractError):
        TB.register_contracts(spark, [changed], names)
    with pytest.raises(Exception):
        C.Contract("claims", "silver", 1, (C.FieldContract("x", "varchar2"),))


def test_leak_guard(spark, names, scratch, contracts):
    """K5: banned keys in the event schema are refused; a sensitive value
    appearing as a batch id is found and stops the run before any write."""
    ev = spark.createDataFrame([("e", "b", "x")], "event_id string, batch_id string, payload string")
    with pytest.raises(A.MetadataLeakError):
        A.assert_metadata_only(ev)
    FX.land(scratch, "CLM-1001", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    sensitive = spark.createDataFrame([("CLM-1001", "claims.claim_id")], "value string, source string")
    obs = CB.observe_headers(spark, scratch, "claims", FX.CLEAN_TYPES)
    with pytest.raises(A.MetadataLeakError):
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, sensitive=sensitive)
    assert spark.table(names.audit).count() == 0
    with pytest.raises(A.MetadataLeakError):
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, banned_patterns=[r"CLM-\d+"])
    with pytest.raises(A.MetadataLeakError):  # the fixed texts are checked in every run
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names)


def test_leak_scan_finds_substrings(spark):
    """Values of several words, inside a path, across separators, and short
    ones are found; values that are not there are not."""
    from datetime import datetime

    schema = "array<struct<name:string,data_type:string>>"
    dec = spark.createDataFrame(
        [("d", "silver", "Jane Doe", "incoming/x/clean.csv"), ("d", "silver", "b2", "incoming/x/CUST-9.1,a:b.csv"), ("d", "silver", "b3", None)],
        "dataset string, layer string, batch_id string, bronze_path string")
    dec = dec.selectExpr("*", f"cast(array() as {schema}) observed_schema", f"cast(array() as {schema}) expected_schema",
                         "cast(array() as array<string>) added_fields", "array('Qx') missing_fields",
                         "cast(array() as array<struct<name:string,expected:string,observed:string>>) changed_fields",
                         "'allow' decision", "1 contract_version")
    events = A.audit_events(dec, run_id="r", event_time=datetime(2026, 1, 1))
    values = ["Jane Doe", "ane D", "CUST-9", "9.1,a:b", "Q", "nowhere", "Doe Jane", "incoming/x/clean.csv", "", None]
    sensitive = spark.createDataFrame([(v, "s") for v in values], "value string, source string")
    got = {(r["batch_id"], r["value"]) for r in A.leak_scan(events, sensitive).collect()}
    assert got == {("Jane Doe", "Jane Doe"), ("Jane Doe", "ane D"), ("b2", "CUST-9"), ("b2", "9.1,a:b"), ("Jane Doe", "incoming/x/clean.csv"),
                   ("Jane Doe", "Q"), ("b2", "Q"), ("b3", "Q")}


def test_row_path_plan(spark):
    """The row path joins by a broadcast semi-join, stays in the JVM, and the
    gold read of silver is pruned to the requested partitions."""
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "batch_id string, v string")
    allowed = spark.createDataFrame(pa.table({"batch_id": ["a"]}))
    plan = P.admitted(rows, allowed)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "Python" not in plan


def test_release_reads_only_requested_partitions(spark, names, scratch, contracts):
    FX.land(scratch, "one", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    FX.land(scratch, "two", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    _run(spark, names, scratch)
    requested = spark.createDataFrame(pa.table({"batch_id": ["one"]}))
    picked = TB.rows_of_batches(spark, names.silver("claims"), requested)
    assert {r["batch_id"] for r in picked.collect()} == {"one"}
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [isnotnull(batch_bucket" in plan
    assert os.path.exists(scratch)


def test_enforce_required_holds_null_batches(spark, names, scratch, contracts):
    """T4: parquet drops nullability; with enforce_required a NULL in a
    required field holds its batch (as a NOT NULL column would refuse it)."""
    FX.land(scratch, "short", FX.CLEAN_HEADER, [FX.CLEAN_ROWS[0][:4]])   # claim_status missing
    FX.land(scratch, "full", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    with pytest.raises(G.RequiredNullError) as err:
        _run(spark, names, scratch, enforce_required=True)
    assert err.value.failures == [("short", "claim_status", 1)]
    assert {r[0] for r in spark.table(names.silver("claims")).select("batch_id").distinct().collect()} == {"full"}
    held = spark.table(names.quarantine("claims")).collect()
    assert [(r["batch_id"], r["reason"]) for r in held] == [("short", "required_null:claim_status")]


def test_recorded_decision_wins_over_newer_contract(spark, names, scratch, contracts):
    """The data writes act on the recorded decision. A run resumed after
    a new contract version still applies what it recorded; a new run
    decides under the new version."""
    FX.land(scratch, "batch-added", FX.CLEAN_HEADER + ["place_of_service"], [r + ["11"] for r in FX.CLEAN_ROWS])
    _run(spark, names, scratch, run_id="r1")
    v2 = FX.silver_v2()
    TB.approve(spark, "claims", "silver", v2.fields, v2.allowed_changes, v2.owner, names)
    res = _run(spark, names, scratch, run_id="r1")
    assert res.count("quarantine") == 1 and res.count("allow") == 0
    assert not TB.table_exists(spark, names.silver("claims"))
    res = _run(spark, names, scratch, run_id="r2")
    assert res.count("allow") == 1
    assert spark.table(names.silver("claims")).count() == 2


def test_append_refuses_unexpected_columns(spark, names):
    """T5: appends are by name and refuse a column the table does not have."""
    t = names.silver("claims")
    TB.ensure_table(spark, t, FX.V1_FIELDS)
    frame = spark.createDataFrame([("x", "b1")], "claim_id string, batch_id string")
    with pytest.raises(Exception):
        TB.append_batches(frame.withColumn("extra", F.lit(1)), t)


def test_large_sidecar_read_whole(spark, scratch):
    """Sidecars are read whole (no byte limit): 1,500 declared fields."""
    import json

    fields = [{"name": f"col_{i:04d}", "data_type": "string"} for i in range(1500)]
    with open(os.path.join(scratch, "wide.schema.json"), "w", encoding="utf-8") as fh:
        json.dump(fields, fh, indent=2)
    assert os.path.getsize(os.path.join(scratch, "wide.schema.json")) > 20_000
    obs = CB.observe_sidecars(spark, scratch, "claims").first()
    assert len(obs["observed_schema"]) == 1500 and obs["header"][-1] == "col_1499"


def test_sidecar_header_order_and_mismatch(spark, names, scratch, contracts):
    """A sidecar may list names in another order than its file (grouping
    uses the real header, values land under their names); a sidecar that
    declares a column the file lacks holds the batch instead of writing
    NULLs."""
    import json

    FX.land(scratch, "ordered", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    rev = list(reversed(FX.CLEAN_HEADER))
    FX.land(scratch, "reversed_file", rev, [list(reversed(r)) for r in FX.CLEAN_ROWS])
    # its sidecar keeps the contract order, unlike the file
    sidecar = [{"name": n, "data_type": FX.CLEAN_TYPES[n]} for n in FX.CLEAN_HEADER]
    with open(os.path.join(scratch, "reversed_file.schema.json"), "w", encoding="utf-8") as fh:
        json.dump(sidecar, fh)
    # a sidecar claiming claim_id for a file without it
    FX.land(scratch, "liar", FX.CLEAN_HEADER[1:], [r[1:] for r in FX.CLEAN_ROWS])
    with open(os.path.join(scratch, "liar.schema.json"), "w", encoding="utf-8") as fh:
        json.dump(sidecar, fh)
    obs = CB.observe_sidecars(spark, scratch, "claims")
    with pytest.raises(G.HeaderMismatchError) as err:
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="sc")
    assert err.value.batch_ids == ["liar"]
    a = sorted(tuple(r) for r in _silver(spark, names, "ordered").drop("batch_id").collect())
    b = sorted(tuple(r) for r in _silver(spark, names, "reversed_file").drop("batch_id").collect())
    assert a == b and a[0][0] == "CLM-1001"
    assert _silver(spark, names, "liar").count() == 0
    held = {r["batch_id"]: r["reason"] for r in spark.table(names.quarantine("claims")).collect()}
    assert held == {"liar": "header_mismatch"}
