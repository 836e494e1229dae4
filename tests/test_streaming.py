"""Streaming entry and run resume."""

from __future__ import annotations

import os
import tempfile

from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB
from lakeward.streaming import file_gate as S

import fixtures as FX


def test_resume_same_run_is_idempotent(spark, names, scratch):
    FX.land(scratch, "clean", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_headers(spark, scratch, "claims", FX.CLEAN_TYPES)
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="r1", promote_gold=True)
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="r1", promote_gold=True)
    assert spark.table(names.audit).count() == 1
    assert spark.table(names.silver("claims")).count() == 2
    assert spark.table(names.gold("claims")).count() == 2


def test_resume_writes_missing_quarantine_rows(spark, names, scratch):
    """A run that stopped after its audit write: the resume adds the missing
    quarantine rows once, and a second resume adds nothing."""
    FX.land(scratch, "batch-missing", FX.CLEAN_HEADER[1:], [r[1:] for r in FX.CLEAN_ROWS])
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    obs = CB.observe_headers(spark, scratch, "claims", FX.CLEAN_TYPES)
    G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="r1")
    spark.sql(f"DROP TABLE {names.quarantine('claims')}")           # as if the run had stopped here
    for _ in range(2):
        G.gate_batches(spark, obs, CB.CsvFeed(spark, obs), names=names, run_id="r1")
    assert spark.table(names.quarantine("claims")).count() == 1
    assert spark.table(names.audit).count() == 1


def test_stream_gates_arriving_files(spark, names, scratch):
    TB.register_contracts(spark, [FX.silver_v1(), FX.gold_v1()], names)
    FX.land(scratch, "batch-clean", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    FX.land(scratch, "batch-missing", FX.CLEAN_HEADER[1:], [r[1:] for r in FX.CLEAN_ROWS])
    ckpt = tempfile.mkdtemp(prefix="lakeward-stream-")
    q = S.start(spark, scratch, "claims", names=names, checkpoint=ckpt, trigger_once=True,
                query_name="gate_" + names.database)
    q.awaitTermination(300)
    ev = {r["batch_id"]: r["decision"] for r in spark.table(names.audit).collect()}
    assert ev == {"batch-clean": "allow", "batch-missing": "quarantine"}
    assert spark.table(names.silver("claims")).count() == 2
    # a new arrival is gated by the next run of the query; old files are not re-gated
    FX.land(scratch, "batch-later", FX.CLEAN_HEADER, FX.CLEAN_ROWS)
    q = S.start(spark, scratch, "claims", names=names, checkpoint=ckpt, trigger_once=True,
                query_name="gate_" + names.database)
    q.awaitTermination(300)
    assert spark.table(names.audit).count() == 3
    assert spark.table(names.silver("claims")).count() == 4
    assert os.path.exists(os.path.join(scratch, "batch-later.csv"))
