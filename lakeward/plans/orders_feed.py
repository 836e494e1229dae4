"""The `orders` table landed as day batches whose headers change by a stated rule.

Each order date is one batch (``batch_id`` = ``yyyy-MM-dd``). The batch's
file header is fixed by a drift class ``k = pmod(days since 1970-01-01, 6)``,
a rule both Spark and SQL can state, so every gate query over this feed has
an independent SQL oracle:

====  ===========================================================
k     header of the landed file
====  ===========================================================
0     the five v1 fields, v1 order
1     v1 + ``o_orderpriority``                  (added)
2     v1 without ``o_custkey``                  (missing)
3     v1 with ``o_totalprice`` declared string  (changed; values
      carry a `` USD`` suffix)
4     the five v1 fields in reverse order       (order is not drift)
5     v1 without ``o_custkey`` + ``o_orderpriority`` (not a rename)
====  ===========================================================

Rows land as text, as they would in CSV files; the gate casts them to the
contract types on promotion. Everything here is a projection of the orders
scan; the batch list is a distinct over the order dates (partial aggregation
before the shuffle, so a date holding most of the rows costs nothing extra).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.contracts import Contract, FieldContract

DATASET = "orders"

# The field list of the orders contracts and the drift rule.
V1_FIELDS = (
    FieldContract("o_orderkey", "bigint"),
    FieldContract("o_custkey", "bigint"),
    FieldContract("o_orderstatus", "string"),
    FieldContract("o_totalprice", "decimal"),
    FieldContract("o_orderdate", "date"),
)
PRIORITY = FieldContract("o_orderpriority", "string", required=False)
APPROVAL = "additive:o_orderpriority"
N_CLASSES = 6
APPROVED_V1 = datetime(2026, 9, 1, tzinfo=timezone.utc)
APPROVED_V2 = datetime(2026, 9, 30, 18, tzinfo=timezone.utc)
SILVER_OWNER = "orders-data-steward"
GOLD_OWNER = "orders-analytics"


def silver_v1() -> Contract:
    return Contract(DATASET, "silver", 1, V1_FIELDS, (), SILVER_OWNER, APPROVED_V1)


def silver_v2() -> Contract:
    """One approved additive column; v1 stays as it was."""
    return Contract(DATASET, "silver", 2, V1_FIELDS + (PRIORITY,), (APPROVAL,), SILVER_OWNER, APPROVED_V2)


def silver_token_only() -> Contract:
    """v1 fields plus the approval token alone: the added column is admitted
    by the decision and then dropped by the projection."""
    return Contract(DATASET, "silver", 2, V1_FIELDS, (APPROVAL,), SILVER_OWNER, APPROVED_V2)


def gold_v1() -> Contract:
    return Contract(DATASET, "gold", 1, V1_FIELDS, (), GOLD_OWNER, APPROVED_V1)


def _header_fields(k: Column) -> Column:
    def arr(fields):
        return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("data_type")) for n, t in fields])

    base = [(f.name, f.data_type) for f in V1_FIELDS]
    added = base + [(PRIORITY.name, PRIORITY.data_type)]
    no_cust = [p for p in base if p[0] != "o_custkey"]
    retyped = [(n, "string" if n == "o_totalprice" else t) for n, t in base]
    return (
        F.when(k == 0, arr(base))
        .when(k == 1, arr(added))
        .when(k == 2, arr(no_cust))
        .when(k == 3, arr(retyped))
        .when(k == 4, arr(list(reversed(base))))
        .otherwise(arr(no_cust + [(PRIORITY.name, PRIORITY.data_type)]))
    )


def headers() -> list[list[str]]:
    """The column names of the landed files, by class k."""
    names = [f.name for f in V1_FIELDS]
    lacking = [n for n in names if n != "o_custkey"]
    return [names, names + [PRIORITY.name], lacking, names, names[::-1], lacking + [PRIORITY.name]]


def land_csv(orders: DataFrame, folder: str) -> list[str]:
    """Write the day batches as CSV files with their own headers, one folder
    per class and batch; returns the class folders."""
    by_class = rows(orders).withColumn("k", drift_class(F.to_date("batch_id")))

    def land(k: int, header: list[str]) -> str:
        path = f"{folder}/class-{k}"
        by_class.where(F.col("k") == k).select(*header, "batch_id").repartition("batch_id") \
            .write.partitionBy("batch_id").option("header", True).option("escape", '"').csv(path)
        return path

    # a folder per batch is slow to commit, and the classes are written apart
    with ThreadPoolExecutor(max_workers=N_CLASSES) as pool:
        return list(pool.map(land, range(N_CLASSES), headers()))


def drift_class(day: Column) -> Column:
    return F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(N_CLASSES))


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def observed(orders: DataFrame) -> DataFrame:
    """One row per day batch: dataset, batch_id, bronze_path, observed_schema."""
    days = orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    batch_id = F.date_format("day", "yyyy-MM-dd")
    return days.select(
        F.lit(DATASET).alias("dataset"),
        batch_id.alias("batch_id"),
        F.concat(F.lit(f"incoming/{DATASET}/"), batch_id, F.lit(".csv")).alias("bronze_path"),
        _header_fields(drift_class(F.col("day"))).alias("observed_schema"),
    )


def price_text(col: Column) -> Column:
    return col.cast("decimal(18,2)").cast("string")


def rows(orders: DataFrame) -> DataFrame:
    """The landed rows as text, with ``batch_id``; a column absent from a
    batch's header is NULL in that batch."""
    day = F.to_date("o_orderdate")
    k = drift_class(day)
    price = price_text(F.col("o_totalprice"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(k.isin(2, 5), F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_orderstatus"),
        F.when(k == 3, F.concat(price, F.lit(" USD"))).otherwise(price).alias("o_totalprice"),
        F.date_format(day, "yyyy-MM-dd").alias("o_orderdate"),
        F.when(k.isin(1, 5), F.col("o_orderpriority")).otherwise(F.lit(None).cast("string")).alias("o_orderpriority"),
        F.date_format(day, "yyyy-MM-dd").alias("batch_id"),
    )
