"""Which queries have SQL."""

from __future__ import annotations

import __spark_entry__ as E
from lakeward.llm import queries as Q


def test_queries_without_sql_are_named():
    assert set(Q.QUERIES) - set(Q.ORACLE_SQL) == Q.WITHOUT_SQL
    assert set(E.queries()) - set(E.oracle_sql()) == Q.WITHOUT_SQL | {"pipeline"}
    numbers = sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14))


def test_scratch_tables_go_when_asked(spark):
    from lakeward.llm import common

    kept = common.cut(spark.range(5), "gone")
    where = kept.inputFiles()
    assert where and common.shared_dir(spark) in where[0].replace("file:///", "file:///")
    common.drop_scratch(spark)
    import os
    assert not os.path.exists(where[0].replace("file://", ""))
