"""Sidecars and data files that land in any order, with a restart in between."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from lakeward.operators import tables as TB
from lakeward.streaming import pairing as P
from test_runs import contract


def sidecar(folder, batch):
    with open(os.path.join(folder, batch + ".schema.json"), "w") as f:
        f.write('[{"name":"id","data_type":"bigint"},{"name":"day","data_type":"date"}]')


def data(folder, batch, n=1):
    with open(os.path.join(folder, batch + ".csv"), "w") as f:
        f.write("id,day\n" + "".join(f"{i},2026-01-01\n" for i in range(n)))


def silver(spark, names):
    if not TB.table_exists(spark, names.silver("claims")):
        return {}
    spark.catalog.refreshTable(names.silver("claims"))
    return {r[0]: r[1] for r in spark.table(names.silver("claims")).groupBy("batch_id").agg(F.count("*")).collect()}


def reasons(spark, names):
    t = names.quarantine("claims")
    if not TB.table_exists(spark, t):
        return {}
    spark.catalog.refreshTable(t)
    return {r["batch_id"]: r["reason"] for r in spark.table(t).collect()}


def wait(check, seconds=120):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return True
        time.sleep(0.5)
    return False


def test_pairing_over_a_restart(spark, names, scratch):
    TB.register_contracts(spark, [contract()], names)
    folder = os.path.join(scratch, "in")
    os.mkdir(folder)
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")

    def start():
        return P.start(spark, folder, "claims", checkpoint=scratch + "/c", names=names, patience_ms=6000, query_name="p_" + names.database, interval="1 second")
    try:
        sidecar(folder, "sidecar_first")
        data(folder, "file_first", 2)
        sidecar(folder, "both")
        data(folder, "both", 3)
        query = start()
        try:
            assert wait(lambda: silver(spark, names) == {"both": 3})
        finally:
            query.stop()
        # the other halves come while the query is down
        data(folder, "sidecar_first", 4)
        sidecar(folder, "file_first")
        sidecar(folder, "no_file")
        query = start()
        try:
            assert wait(lambda: silver(spark, names) == {"both": 3, "sidecar_first": 4, "file_first": 2})
            assert wait(lambda: reasons(spark, names).get("no_file") == "overdue:file")
            data(folder, "no_file", 5)  # late, but it comes
            assert wait(lambda: silver(spark, names).get("no_file") == 5)
        finally:
            query.stop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert silver(spark, names) == {"both": 3, "sidecar_first": 4, "file_first": 2, "no_file": 5}


def test_pairing_needs_a_checkpoint(spark, names, scratch):
    with pytest.raises(ValueError, match="checkpoint"):
        P.start(spark, scratch, "claims", checkpoint="", names=names)
