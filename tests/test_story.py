"""The walkthrough: four batches, approval, replay; then the gate's guards."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB

import fixtures as FX


def _events(spark, names):
    return {r["batch_id"]: r for r in spark.table(names.audit).collect()}


def test_story(spark, names, scratch):
    incoming = os.path.join(scratch, "incoming")
    FX.land_walkthrough(incoming)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)

    observed = CB.observe_sidecars(spark, incoming, "claims")
    feed = CB.CsvFeed(spark, observed)
    res = G.gate_batches(spark, observed, feed, names=names, run_id="run-1", promote_gold=True)
    assert res.count("allow") == 1 and res.count("quarantine") == 3
    out = {r["batch_id"]: (r["decision"], r["silver_written"], r["gold_written"])
           for r in res.outcomes(spark).collect()}
    assert out == {"batch-clean": ("allow", True, True), "batch-added": ("quarantine", False, False),
                   "batch-missing": ("quarantine", False, False), "batch-type-change": ("quarantine", False, False)}

    ev = _events(spark, names)
    assert ev["batch-clean"]["decision"] == "allow"
    assert ev["batch-added"]["decision"] == "quarantine"
    assert list(ev["batch-added"]["added_fields"]) == ["place_of_service"]
    assert "claim_id" in ev["batch-missing"]["missing_fields"]
    assert ev["batch-type-change"]["changed_fields"][0]["name"] == "billed_amount"
    assert ev["batch-type-change"]["changed_fields"][0]["observed"] == "string"
    assert spark.table(names.silver("claims")).count() == 2
    assert spark.table(names.gold("claims")).count() == 2
    # held batches: pointer rows, files untouched
    q = {r["batch_id"] for r in spark.table(names.quarantine("claims")).collect()}
    assert q == {"batch-added", "batch-missing", "batch-type-change"}
    assert os.path.exists(os.path.join(incoming, "batch-added.csv"))

    # metadata only
    text = " ".join(r[0] for r in spark.table(names.audit).select(F.to_json(F.struct("*"))).collect())
    assert "120.50" not in text and "CLM-1001" not in text

    # steward approves silver v2; v1 stays
    TB.approve(spark, "claims", "silver", FX.silver_v2().fields, FX.silver_v2().allowed_changes,
               "revenue-data-steward", names)
    assert TB.contract_versions(spark, "claims", "silver", names) == [1, 2]

    replay_obs = CB.observe_headers(spark, os.path.join(incoming, "batch-added.csv"), "claims",
                                    FX.CLEAN_TYPES, batch_ids={"batch-added.csv": "batch-added-replay"})
    res2 = G.gate_batches(spark, replay_obs, CB.CsvFeed(spark, replay_obs), names=names, run_id="run-2",
                          promote_gold=True)
    assert res2.count("allow") == 1
    silver = spark.table(names.silver("claims"))
    gold = spark.table(names.gold("claims"))
    assert "place_of_service" in silver.columns
    assert "place_of_service" not in gold.columns
    assert silver.count() == 4 and gold.count() == 4
    assert silver.where("place_of_service = '11'").count() == 2
    assert silver.where("batch_id = 'batch-clean' AND place_of_service IS NULL").count() == 2
    assert TB.contract_versions(spark, "claims", "gold", names) == [1]
    # values are typed by the contract
    row = silver.where("batch_id = 'batch-clean'").orderBy("claim_id").first()
    assert str(row["billed_amount"]) == "120.50" and str(row["service_date"]) == "2026-01-15"
    assert spark.table(names.audit).count() == 5


def test_fail_flag_raises_after_writes(spark, names, scratch):
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims").where("batch_id = 'batch-missing'")
    with pytest.raises(G.QuarantinedError) as err:
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, fail_on_quarantine=True)
    assert err.value.batch_ids == ["batch-missing"]
    # the event and the quarantine row exist before the raise
    assert spark.table(names.audit).count() == 1
    assert spark.table(names.quarantine("claims")).count() == 1


def test_gated_release_skips_gold_on_failure(spark, names, scratch):
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims")
    with pytest.raises(G.QuarantinedError):
        G.run_gated_release(spark, obs.where("batch_id = 'batch-missing'"), CB.CsvFeed(spark, obs), names=names)
    assert not TB.table_exists(spark, names.gold("claims"))
    res = G.run_gated_release(spark, obs.where("batch_id = 'batch-clean'"), CB.CsvFeed(spark, obs), names=names)
    assert res.gold_batches == {"claims": 1}
    assert spark.table(names.gold("claims")).count() == 2


def test_gold_release_blocked(spark, names, scratch):
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims")
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names)
    with pytest.raises(G.NoSilverRowsError) as err:
        G.release_gold(spark, "claims", ["batch-clean", "batch-missing"], names=names)
    assert err.value.batch_ids == ["batch-missing"]
    assert not TB.table_exists(spark, names.gold("claims"))
    assert G.release_gold(spark, "claims", ["batch-clean"], names=names) == 1
    assert spark.table(names.gold("claims")).count() == 2


def test_no_contract_writes_nothing(spark, names, scratch):
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims")
    other = obs.withColumn("dataset", F.lit("hr"))
    with pytest.raises(KeyError, match="hr.silver"):
        G.gate_batches(spark, obs.unionByName(other), CB.CsvFeed(spark, obs), names=names)
    with pytest.raises(KeyError, match="claims.gold"):
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, promote_gold=True)
    assert spark.table(names.audit).count() == 0
    assert not TB.table_exists(spark, names.bronze)


def test_replay_append_doubles_replace_does_not(spark, names, scratch):
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims").where("batch_id = 'batch-clean'")
    feed = CB.CsvFeed(spark, obs)
    G.gate_batches(spark, obs, feed, names=names, run_id="a")
    G.gate_batches(spark, obs, feed, names=names, run_id="b")
    assert spark.table(names.silver("claims")).count() == 4
    G.gate_batches(spark, obs, feed, names=names, run_id="c", on_replay="replace")
    assert spark.table(names.silver("claims")).count() == 2


def test_bronze_counts_reset(spark, names, scratch):
    """B1: every landed batch's observed schema is kept, latest wins per id;
    E4: rows per layer; B12: reset drops exactly the gate's tables."""
    FX.land_walkthrough(scratch)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_sidecars(spark, scratch, "claims")
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="a", promote_gold=True)
    G.gate_batches(spark, obs.where("batch_id = 'batch-clean'"), CB.CsvFeed(spark, obs), names=names, run_id="b")
    latest = {r["batch_id"]: r for r in TB.latest_observed(spark, names).collect()}
    assert len(latest) == 4 and latest["batch-clean"]["run_id"] == "b"
    assert [f["name"] for f in latest["batch-missing"]["observed_schema"]] == FX.CLEAN_HEADER[1:]
    counts = {r["layer"]: r["rows"] for r in TB.layer_counts(spark, "claims", names).collect()}
    assert counts == {"silver": 4, "gold": 2}
    dropped = TB.reset_tables(spark, ["claims"], names)
    assert names.silver("claims") in dropped and names.contracts in dropped
    assert not TB.table_exists(spark, names.audit) and not TB.table_exists(spark, names.bronze)
