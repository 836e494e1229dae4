"""Many feeds, one gate run: every given table is a feed with its own contract.

The gate is dataset-agnostic: only contract rows differ between feeds. A
table's observed schema is its DataFrame schema (names in column order, types
mapped to the contract vocabulary), which Spark takes from the Parquet
footers; the admitted feeds' rows are then projected and counted in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.operators.contracts import Contract, FieldContract
from lakeward.sources import frames as SF

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

APPROVED = "2026-09-01T00:00:00+00:00"


def _c(dataset, fields, allowed=()):
    return Contract(dataset, "silver", 1, tuple(FieldContract(n, t) for n, t in fields), tuple(allowed),
                    f"{dataset}-steward", APPROVED)


# One silver contract per table. Five are deliberately drifted
# from the tables: customer expects c_phone (missing), part declares p_size
# bigint (changed), orders omits o_orderpriority (added, not approved),
# labels declares quality boolean (changed), conversations names speaker
# where the table has role (missing + added: not a rename). lineitem omits
# l_tax but approves it as additive, so it is admitted and l_tax is dropped.
FEED_CONTRACTS = (
    _c("region", [("r_regionkey", "int"), ("r_name", "string")]),
    _c("nation", [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]),
    _c("customer", [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                    ("c_acctbal", "double"), ("c_mktsegment", "string"), ("c_phone", "string")]),
    _c("supplier", [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"),
                    ("s_acctbal", "double")]),
    _c("part", [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
                ("p_size", "bigint"), ("p_retailprice", "double")]),
    _c("orders", [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                  ("o_totalprice", "double"), ("o_orderdate", "timestamp")]),
    _c("lineitem", [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                    ("l_discount", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                    ("l_shipdate", "timestamp")], ["additive:l_tax"]),
    _c("events", [("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"),
                  ("value", "double"), ("props", "string")]),
    _c("documents", [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                     ("n_chars", "bigint")]),
    _c("embeddings", [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")]),
    _c("pages", [("page_id", "bigint"), ("url", "string"), ("html", "string")]),
    _c("benchmark", [("item_id", "bigint"), ("text", "string")]),
    _c("labels", [("doc_id", "bigint"), ("quality", "boolean"), ("toxic", "int")]),
    _c("conversations", [("conv_id", "bigint"), ("turn", "bigint"), ("speaker", "string"), ("text", "string")]),
)


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return SF.read_tables(spark, sf_dir, TABLES)


def batch_ids() -> dict[str, str]:
    return {t: f"{t}-snapshot" for t in TABLES}


def observed_schemas(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One observed row per feed from the DataFrame schemas (metadata only)."""
    return SF.observe_frames(spark, frames, batch_ids(), {t: f"tables/{t}.parquet" for t in frames})


def contract_fields(dataset: str):
    for c in FEED_CONTRACTS:
        if c.dataset == dataset:
            return c.fields
    raise KeyError(dataset)


def stamp(frames: dict[str, DataFrame], dataset: str) -> DataFrame:
    return SF.FrameFeed(frames, batch_ids())(dataset, None)
