"""CSV records of files with line breaks inside quoted values, read in splits.

A split of a text file starts at a line, but that line may lie inside a
quoted value. Whether it does depends on all quotes before it, so two passes
are made. The first looks at lines with a quote only and sums up each split
as a function: in which state (between records, or inside a quoted value) it
ends, for either state it may start in. Functions compose, so a prefix scan
over a file's splits, done with window functions, tells every split's start.
The second pass cuts each split's lines into records; a record that crosses
splits arrives in fragments, at most two a split, which are put together by
a window over the file's fragments.

A quote opens a value at the start of a field only, is doubled inside one,
and is an ordinary character elsewhere.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ends_inside(line: str, inside: bool, sep: str = ",", quote: str = '"') -> bool:
    """Whether the end of ``line`` lies inside a quoted value, given whether its start does."""
    at = 0
    while True:
        if inside or line.startswith(quote, at):
            at += 0 if inside else len(quote)
            inside = False
            while True:
                at = line.find(quote, at)
                if at < 0:
                    return True
                at += len(quote)
                if not line.startswith(quote, at):
                    break
                at += len(quote)
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, paths) -> DataFrame:
    """value, path and block (where the split starts) of every line, in file order within a split."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _summaries(batches):
    """For each split with quotes: its end state from either start state."""
    ends: dict = {}
    for batch in batches:
        for value, path, block in zip(*(batch.column(c).to_pylist() for c in ("value", "path", "block"))):
            outside, inside = ends.get((path, block), (False, True))
            ends[path, block] = ends_inside(value, outside), ends_inside(value, inside)
    paths, blocks = zip(*ends) if ends else ((), ())
    outside, inside = zip(*ends.values()) if ends else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(blocks, pa.int64()), pa.array(outside, pa.bool_()), pa.array(inside, pa.bool_())],
                                     ["path", "block", "from_outside", "from_inside"])


def open_spans(lines: DataFrame) -> DataFrame:
    """(path, after, upto): splits that start after ``after`` and not beyond
    ``upto`` start inside a quoted value."""
    s = lines.where(F.col("value").contains('"')).mapInArrow(_summaries, "path string, block long, from_outside boolean, from_inside boolean")
    # a task holds a split's lines in order, and no split is in two tasks
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside"))
    swaps = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    file = W.partitionBy("path").orderBy("block")
    before = file.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("fixed", fixed).withColumn("swaps", swaps)
    s = s.withColumn("base", F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(False))) \
        .withColumn("run", F.count("fixed").over(before))
    turned = F.coalesce(F.sum("swaps").over(W.partitionBy("path", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    s = s.withColumn("starts_inside", F.col("base") != (F.pmod(turned, F.lit(2)) == 1))
    s = s.withColumn("ends_inside", F.when(F.col("starts_inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    return s.select("path", F.col("block").alias("after"), F.coalesce(F.lead("block").over(file), F.lit((1 << 63) - 1)).alias("upto"), "ends_inside") \
        .where("ends_inside").drop("ends_inside")


def _cut(sent):
    """Records of each split; what crosses a split's ends comes as fragments."""
    names = ["path", "record", "block", "part", "first"]

    def give(rows):
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches):
        spans = sent.value
        where, held, inside, head, first, rows = None, [], False, False, False, []

        def close():
            # what is open at the end of a split goes on in the next
            if held:
                rows.append((where[0], "\n".join(held), where[1], 0 if head else 1, first and not head))

        for batch in batches:
            paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
            quoted = pc.match_substring(batch.column("value"), '"').to_pylist()
            for value, path, block, has_quote in zip(batch.column("value").to_pylist(), paths, blocks, quoted):
                if (path, block) != where:
                    close()
                    where, held = (path, block), []
                    after, upto = spans.get(path, ((), ()))
                    i = bisect_left(after, block) - 1
                    inside = head = i >= 0 and block <= upto[i]
                    first = block == 0
                held.append(value)
                if has_quote:
                    inside = ends_inside(value, inside)
                if not inside:
                    text = held[0] if len(held) == 1 else "\n".join(held)
                    text = text[:-1] if text.endswith("\r") else text
                    if head:
                        rows.append((path, text, block, 0, False))
                    elif first:
                        first = False  # the header
                    elif text:
                        rows.append((path, text, None, None, False))
                    held, head = [], False
                if len(rows) >= 1 << 14:
                    yield give(rows)
                    rows = []
        close()
        yield give(rows)
    return run


def read_records(spark: SparkSession, paths) -> DataFrame:
    """(path, record): the CSV records of the files after their header,
    without blank lines. Splits are cut at lines wherever they fall."""
    lines = _lines(spark, paths)
    spans: dict = {}
    for path, after, upto in open_spans(lines).orderBy("path", "after").toLocalIterator():  # at most one row a split
        one = spans.setdefault(path, ([], []))
        one[0].append(after)
        one[1].append(upto)
    cut = lines.mapInArrow(_cut(spark.sparkContext.broadcast(spans)), "path string, record string, block long, part int, first boolean")
    whole = cut.where("block is null").select("path", "record")
    if not spans:
        return whole
    # a record's first fragment (part 1) is followed by those of the splits it goes through (part 0)
    order = W.partitionBy("path").orderBy("block", "part")
    pieces = cut.where("block is not null").withColumn("nth", F.sum("part").over(order))
    crossing = pieces.groupBy("path", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "part", "record"))).alias("p"), F.max("first").alias("header"))
    text = F.regexp_replace(F.array_join(F.transform("p", lambda x: x["record"]), "\n"), "\r$", "")
    return whole.unionByName(crossing.where("not header").select("path", text.alias("record")))
