"""One scan for any number of headers, splits inside quoted values, listing by tasks."""

from __future__ import annotations

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeward.operators import contracts as C
from lakeward.operators import tables as TB
from lakeward.plans import gate as G
from lakeward.sources import csv_batches as CB
from lakeward.sources import quoted_lines as Q


def contract(names_, dataset="wide"):
    return C.Contract(dataset, "silver", 1, tuple(C.FieldContract(n, "string", required=False) for n in names_), (), "me", "2026-09-01T00:00:00+00:00")


def test_many_headers_are_one_scan(spark, names, scratch):
    """Files with 120 different column orders; rows of each land under their names."""
    wanted = [f"f{i}" for i in range(7)]
    r = random.Random(2)
    for b in range(120):
        order = wanted[:]
        r.shuffle(order)
        with open(os.path.join(scratch, f"b{b:03}.csv"), "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(order)
            for k in range(3):
                out.writerow([f"{n}-{b}-{k}" for n in order])
    TB.register_contracts(spark, [contract(wanted)], names)
    observed = CB.observe_headers(spark, scratch, "wide")
    feed = CB.CsvFeed(spark, headers="recorded")
    rows = feed("wide", observed.select("batch_id", "bronze_path", "observed_schema"), columns=wanted)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] csv") == 1
    assert G.gate_batches(spark, observed, feed, names=names).count("allow") == 120
    got = spark.table(names.silver("wide"))
    assert got.count() == 360
    ok = F.lit(True)
    for n in wanted:
        ok = ok & F.col(n).startswith(F.concat(F.lit(n + "-"), F.col("batch_id").substr(2, 3).cast("int").cast("string"), F.lit("-")))
    assert got.where(~ok).count() == 0
    files = got.select(F.input_file_name()).distinct().count()
    assert files <= 2 * names.layer_buckets  # by buckets and bytes, not by batch


def test_repeated_and_lacking_names(spark, scratch):
    with open(os.path.join(scratch, "x.csv"), "w") as f:
        f.write("a,b,a\n1,2,3\n4\n\n5,6,7,8\n")
    observed = CB.observe_headers(spark, scratch, "d")
    rows = CB.CsvFeed(spark, headers="recorded")("d", observed, columns=["a", "b", "none"])
    assert sorted(map(tuple, rows.collect()), key=str) == [("3", "2", None, "x"), ("7", "6", None, "x"), (None, None, None, "x")]


@pytest.mark.parametrize("line,inside,expect", [
    ("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('a"', False, False), ('a"', True, False), ('x,"y""', False, True),
    ('x,"y"""', False, False), ('5" pipe,"open', False, True), ('5" pipe', False, False), ('""', False, False), ('"",""', False, False), ('""', True, True),
    ('","', True, True), ('",",', True, True), ('","a","', False, True), ("", True, True)])
def test_quote_state(line, inside, expect):
    assert Q.ends_inside(line, inside) is expect


def quoted_rows(seed, n):
    r = random.Random(seed)
    cells = ["", "plain", "with, comma", 'with "quotes"', "two\nlines", "many\n\n\nlines " + "x" * 200, '"\n"', ",\n,", "5'", "é\n中"]
    return [[str(i), *(r.choice(cells) for _ in range(3))] for i in range(n)]


def test_quoted_newlines_over_splits(spark, scratch):
    """Files cut into many splits, some of them inside a quoted value, give
    the rows of Spark's multiLine reader and of Python's csv."""
    expect = {}
    for b in range(3):
        rows = quoted_rows(b, 400)
        if b == 2:
            rows[200][2] = "y\n" * 20_000  # one value over many splits
        expect[f"b{b}"] = rows
        with open(os.path.join(scratch, f"b{b}.csv"), "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator="\r\n" if b == 1 else "\n").writerows([["k", "p", "q", "s"], *rows])
    with open(os.path.join(scratch, "empty.csv"), "w"):
        pass
    observed = CB.observe_headers(spark, scratch, "d")
    prev = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = CB.CsvFeed(spark, multi_line="split")("d", observed, columns=["k", "p", "q", "s"])
        assert Q._lines(spark, [scratch + "/b0.csv"]).rdd.getNumPartitions() > 5
        assert Q.open_spans(Q._lines(spark, [scratch + "/b2.csv"])).count() > 0
        got = sorted(map(tuple, rows.collect()), key=str)
        native = CB.CsvFeed(spark, multi_line=True)("d", observed, columns=["k", "p", "q", "s"])
        assert got == sorted(map(tuple, native.collect()), key=str)
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    flat = [(*(c or None for c in r), b) for b, rows in expect.items() for r in rows]
    assert sorted(((x[0], x[1] or None, x[2] or None, x[3] or None, x[4]) for x in got), key=str) == sorted(flat, key=str)


def test_listing_by_tasks(spark, scratch):
    for p in ("a/x.csv", "a/b/y.csv", "a/b/_tmp/z.csv", "a/.hidden.csv", "n.txt", "e.csv", "a/c d/w.csv"):
        os.makedirs(os.path.dirname(os.path.join(scratch, p)), exist_ok=True)
        open(os.path.join(scratch, p), "w").close()
    got = sorted(r[0] for r in CB.list_files(spark, scratch).collect())
    assert got == sorted("file:" + os.path.join(scratch, p) for p in ("a/x.csv", "a/b/y.csv", "e.csv", "a/c d/w.csv"))
    assert [r[0] for r in CB.list_files(spark, "file://" + scratch + "/e.csv").collect()] == ["file:" + scratch + "/e.csv"]
