"""All given tables gated as feeds in one run, with real writes."""

from __future__ import annotations

from lakeward.operators import tables as TB
from lakeward.plans import feeds as FD
from lakeward.plans import gate as G
from lakeward.sources import frames as SF

SF_DIR = "/root/testdata/sf0.001"


def test_all_tables_one_run(spark, names):
    TB.register_contracts(spark, FD.FEED_CONTRACTS, names)
    frames = FD.load(spark, SF_DIR)
    observed = FD.observed_schemas(spark, frames)
    res = G.gate_batches(spark, observed, SF.FrameFeed(frames, FD.batch_ids()), names=names, run_id="feeds")
    held = {d for (d, dec), n in res.decisions.items() if dec == "quarantine"}
    assert held == {"customer", "part", "orders", "labels", "conversations"}
    assert res.count("allow") == 9
    # admitted feeds hold exactly their contract columns; l_tax (approved as
    # additive, not a contract field) is dropped
    li = spark.table(names.silver("lineitem"))
    assert "l_tax" not in li.columns and li.count() == frames["lineitem"].count()
    emb = spark.table(names.silver("embeddings"))
    assert dict(emb.dtypes)["embedding"] == "array<float>"
    assert not TB.table_exists(spark, names.silver("customer"))
    q = spark.table(names.quarantine("conversations")).first()
    assert list(q["missing_fields"]) == ["speaker"] and list(q["added_fields"]) == ["role"]
