"""The release ledger, feeds promoted together, approvals at once, leaks held per batch, one read of the source."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from lakeward.operators import audit as A
from lakeward.operators import contracts as C
from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from test_runs import GOOD, contract, feed, silver


def rows_of(spark, names, layer="gold", dataset="claims"):
    t = spark.table(names.layer(layer, dataset))
    return sorted(map(tuple, t.drop(TB.BUCKET).collect()), key=str)


def both(spark, names):
    TB.register_contracts(spark, [contract(), contract(layer="gold")], names)


@pytest.mark.parametrize("on_replay", ["append", "replace"])
def test_gated_release_again_and_with_more(spark, names, on_replay):
    both(spark, names)
    for part in ({"one": GOOD["one"]}, {"one": GOOD["one"]}, GOOD):
        result = G.run_gated_release(spark, *feed(spark, part), names=names, run_id="daily", on_replay=on_replay)
    assert result.gold_batches == {"claims": 2}
    assert rows_of(spark, names) == rows_of(spark, names, "silver") and len(rows_of(spark, names)) == 4
    # another run appends to silver (a replay), or replaces there: gold holds what silver holds
    G.run_gated_release(spark, *feed(spark, {"one": GOOD["one"]}), names=names, run_id="other", on_replay=on_replay)
    assert rows_of(spark, names) == rows_of(spark, names, "silver")
    assert silver(spark, names)["one"] == (4 if on_replay == "append" else 2)


def test_release_again_writes_nothing(spark, names):
    both(spark, names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r", promote_gold=True)
    files = spark.table(names.gold("claims")).inputFiles()
    for _ in range(2):
        assert G.release_gold(spark, "claims", ["one", "two"], names=names) == 2
    assert spark.table(names.gold("claims")).inputFiles() == files


def test_release_that_failed_half_way_is_mended(spark, names, monkeypatch):
    """Rows were appended to gold, the ledger's last row was not written: the
    next release replaces them."""
    both(spark, names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r")
    keep = TB.record

    def fails(spark, moves, names, state):
        if state == TB.DONE:
            raise OSError("gone")
        keep(spark, moves, names, state)
    monkeypatch.setattr(TB, "record", fails)
    with pytest.raises(OSError):
        G.release_gold(spark, "claims", ["one"], names=names)
    assert len(rows_of(spark, names)) == 2
    monkeypatch.setattr(TB, "record", keep)
    G.release_gold(spark, "claims", ["one", "two"], names=names)
    assert rows_of(spark, names) == rows_of(spark, names, "silver")


def test_new_gold_contract_releases_again(spark, names):
    both(spark, names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r", promote_gold=True)
    TB.approve(spark, "claims", "gold", (C.FieldContract("id", "bigint"), C.FieldContract("day", "date", required=False)), (), "me", names)
    G.release_gold(spark, "claims", ["one"], names=names)
    assert rows_of(spark, names) == rows_of(spark, names, "silver")
    versions = TB.latest_moves(TB.ledger_of(spark, names, "claims", "gold")).select("batch_id", "contract_version").collect()
    assert sorted(map(tuple, versions)) == [("one", 2), ("two", 1)]


def test_replace_leaves_other_batches_of_the_bucket(spark, names):
    fields = (C.FieldContract("id", "bigint"),)
    t = names.silver("x")
    TB.ensure_table(spark, t, fields, buckets=2)
    many = spark.range(300).select("id", F.concat(F.lit("b"), F.col("id") % 30).alias("batch_id"))
    TB.append_batches(many, t)
    before = {r[0]: r[1] for r in spark.table(t).groupBy("batch_id").count().collect()}
    new = spark.range(1000, 1003).select("id", F.lit("b7").alias("batch_id"))
    gone = spark.createDataFrame([("b7",), ("b8",)], "batch_id string")
    TB.replace_batches(new, t, batches=gone)
    after = {r[0]: r[1] for r in spark.table(t).groupBy("batch_id").count().collect()}
    assert after == {k: v for k, v in before.items() if k not in ("b7", "b8")} | {"b7": 3}
    TB.replace_batches(new.limit(0), t, batches=spark.createDataFrame([(k,) for k in after], "batch_id string"))
    assert spark.table(t).count() == 0  # buckets that nothing is left for are emptied


def test_held_batches_read_the_source_once(spark, names):
    """Batches with bad values are told apart from the others by one read."""
    both(spark, names)
    observed, _ = feed(spark, GOOD | {"bad": [("abc", "2026-01-01")]})
    reads = spark.sparkContext.accumulator(0)

    def source(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    _, rows = feed(spark, GOOD | {"bad": [("abc", "2026-01-01")]})
    counted = lambda d, allowed: rows(d, allowed).mapInArrow(source, "id string, day string, batch_id string")
    result = G.gate_batches(spark, observed, counted, names=names, run_id="r", raise_errors=False)
    assert [e.batch_ids for e in result.errors] == [["bad"]] and silver(spark, names) == {"one": 2, "two": 2}
    assert reads.value == 5
    # optimistic: one read if nothing fails
    reads.value = 0
    G.gate_batches(spark, *feed(spark, GOOD)[:1], lambda d, a: feed(spark, GOOD)[1](d, a).mapInArrow(source, "id string, day string, batch_id string"),
                   names=names, run_id="s", isolation="optimistic")
    assert reads.value == 4
    # no staging table is left
    assert not [t.name for t in spark.catalog.listTables(names.database) if t.name.startswith("staged_")]


def test_feeds_are_promoted_together(spark, names):
    """Eight feeds of which each takes its time: about as long as two after each other, not eight; one that fails is told last."""
    datasets = [f"d{i}" for i in range(8)]
    TB.register_contracts(spark, [contract(d) for d in datasets], names)
    observed = None
    for d in datasets:
        part, rows = feed(spark, GOOD, d)
        observed = part if observed is None else observed.unionByName(part)
    at_once, most, lock = [0], [0], threading.Lock()

    def slow(dataset, allowed):
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        time.sleep(1.0)
        with lock:
            at_once[0] -= 1
        if dataset == "d3":
            raise OSError("no such source")
        return rows(dataset, allowed)
    with pytest.raises(OSError, match="no such source"):
        G.gate_batches(spark, observed, slow, names=names, run_id="r", feeds_at_once=4)
    assert most[0] == 4
    assert all(silver(spark, names, d) == {"one": 2, "two": 2} for d in datasets if d != "d3")
    result = G.gate_batches(spark, observed, lambda d, a: rows(d, a), names=names, run_id="r")
    assert result.silver_batches == dict.fromkeys(datasets, 2)
    assert all(silver(spark, names, d) == {"one": 2, "two": 2} for d in datasets)


def test_approvals_at_once(spark, names):
    TB.register_contracts(spark, [contract()], names)
    got, errors = [], []

    def approve(i):
        try:
            got.append(TB.approve(spark, "claims", "silver", (C.FieldContract("id", "bigint"), C.FieldContract(f"c{i}", "string")), (), "me", names).version)
        except Exception as e:  # noqa: BLE001 - told below
            errors.append(e)
    threads = [threading.Thread(target=approve, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == [] and sorted(got) == list(range(2, 10))
    assert TB.contract_versions(spark, "claims", "silver", names) == list(range(1, 10))
    with TB.contracts_lock(spark, names), pytest.raises(TB.LockedError):
        with TB.contracts_lock(spark, names, timeout=0.2):
            pass


def test_a_leaking_batch_is_held_and_the_others_go_on(spark, names):
    both(spark, names)
    batches = GOOD | {"CLM-export-7": GOOD["one"], "Jane Doe": GOOD["two"]}
    sensitive = spark.createDataFrame([("Jane Doe", "customers")], "value string, source string")
    with pytest.raises(G.LeakError) as err:
        G.gate_batches(spark, *feed(spark, batches), names=names, run_id="r", sensitive=sensitive)
    assert err.value.batch_ids == ["CLM-export-7", "Jane Doe"] and isinstance(err.value, A.MetadataLeakError)
    assert silver(spark, names) == {"one": 2, "two": 2}
    held = spark.table(names.quarantine("claims")).collect()
    assert sorted(r["reason"] for r in held) == ["metadata_leak:banned text", "metadata_leak:customers"]
    assert all(r["batch_id"].startswith("sha256:") and r["bronze_path"] is None for r in held)
    assert sorted(r[0] for r in spark.table(names.audit).select("batch_id").collect()) == ["one", "two"]
    # the texts are a parameter
    G.gate_batches(spark, *feed(spark, batches), names=names, run_id="s", banned_texts=())
    assert silver(spark, names)["CLM-export-7"] == 2


def test_automaton_and_join_agree(spark, monkeypatch):
    lines = spark.createDataFrame([("incoming/x/CUST-9.1,a:b.csv",), ("Jane Doe",), ("",), ("aaa",)], "line string")
    values = spark.createDataFrame([(v, s) for v in ("ane D", "9.1,a", "a", "aa", "none", "Jane Doe", "incoming/x/CUST-9.1,a:b.csv!") for s in ("s", "t")],
                                   "value string, source string")
    got = sorted(map(tuple, A._line_hits(lines, values).distinct().collect()))
    monkeypatch.setattr(A, "LINES_BOUND", 0)
    assert got == sorted(map(tuple, A._line_hits(lines, values).collect())) == sorted(map(tuple, A._joined_hits(lines, values).collect()))
    assert len(got) == 2 * 7


def test_gold_guard_raises_before_the_write(spark, names):
    """A column that the gold contract does not release stops the release before any row is written."""
    both(spark, names)
    G.gate_batches(spark, *feed(spark, GOOD), names=names, run_id="r")
    TB.ensure_table(spark, names.gold("claims"), (C.FieldContract("id", "bigint"), C.FieldContract("secret", "string")))
    with pytest.raises(G.UnreleasedColumnError, match="secret"):
        G.release_gold(spark, "claims", ["one"], names=names)
    assert spark.table(names.gold("claims")).count() == 0
