"""Versioned schema contracts: declaration, registration, approval, lookup.

A contract is declared, never inferred from a load. Each (dataset, layer) has
a history of versions; the highest version is active. Registration refuses a
second, different contract under an existing (dataset, layer, version).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeward.functions import types as ty

FIELD_TYPE = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("required", T.BooleanType(), False),
    ]
)

CONTRACT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("contract_version", T.IntegerType(), False),
        T.StructField("approved_schema", T.ArrayType(FIELD_TYPE, False), False),
        T.StructField("required_fields", T.ArrayType(T.StringType(), False), False),
        T.StructField("allowed_changes", T.ArrayType(T.StringType(), False), False),
        T.StructField("owner", T.StringType(), True),
        T.StructField("approved_at", T.TimestampType(), True),
    ]
)

class ContractError(ValueError):
    """A contract is malformed or collides with a registered version."""


class NoContractError(KeyError):
    """No contract is registered for some (dataset, layer)."""

    def __init__(self, missing: list[tuple[str, str]]):
        self.missing = sorted(missing)
        names = ", ".join(f"{d}.{l}" for d, l in self.missing)
        super().__init__(f"No contract for {names}")


@dataclass(frozen=True)
class FieldContract:
    name: str
    data_type: str
    required: bool = True


@dataclass(frozen=True)
class Contract:
    dataset: str
    layer: str
    version: int
    fields: tuple[FieldContract, ...]
    allowed_changes: tuple[str, ...] = ()
    owner: str | None = None
    approved_at: datetime | str | None = None

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "allowed_changes", tuple(self.allowed_changes))
        validate(self)

    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def row(self) -> tuple:
        fields = [(f.name, f.data_type, bool(f.required)) for f in self.fields]
        return (
            self.dataset,
            self.layer,
            int(self.version),
            fields,
            [name for name, _, required in fields if required],
            list(self.allowed_changes),
            self.owner,
            _as_timestamp(self.approved_at),
        )


def _as_timestamp(value) -> datetime | None:
    if value is None or isinstance(value, datetime):
        return value
    return datetime.fromisoformat(str(value).replace("Z", "+00:00"))


def validate(contract: Contract) -> None:
    """Field names unique (also ignoring case, as Spark resolves columns),
    types from the vocabulary, version positive."""
    if int(contract.version) < 1:
        raise ContractError(f"Version must be positive: {contract.version}")
    lowered = [f.name.lower() for f in contract.fields]
    if len(set(lowered)) != len(lowered):
        raise ContractError(f"Duplicate field names in {contract.dataset}.{contract.layer}")
    for f in contract.fields:
        if not f.name:
            raise ContractError("Empty field name")
        ty.validate(f.data_type)


def event_clock(given: datetime | None = None) -> datetime:
    """The time that a run stamps on what it records: the given one, or now,
    in UTC and whole seconds (tables keep no finer time apart)."""
    at = datetime.now(timezone.utc) if given is None else given
    return at - timedelta(microseconds=at.microsecond)


def contracts_frame(spark: SparkSession, contracts) -> DataFrame:
    """Declared contracts -> relation with the ``schema_contracts`` layout."""
    return spark.createDataFrame([c.row() for c in contracts], CONTRACT_SCHEMA)


def active_contracts(contracts: DataFrame) -> DataFrame:
    """Highest version per (dataset, layer); ``approved_at`` is not consulted."""
    latest = contracts.groupBy("dataset", "layer").agg(
        F.max_by(F.struct(*[c for c in contracts.columns]), "contract_version").alias("c")
    )
    return latest.select("c.*")


def contract_history(contracts: DataFrame) -> DataFrame:
    """Versions of each (dataset, layer), ascending."""
    return contracts.groupBy("dataset", "layer").agg(
        F.array_sort(F.collect_list("contract_version")).alias("versions")
    )


def collect_active(contracts: DataFrame, layer: str) -> dict[str, dict]:
    """Active contracts of one layer on the driver: dataset -> row dict.

    Contracts are metadata (a few rows per dataset), so collecting them is
    bounded by the number of registered datasets, not by data volume.
    """
    rows = active_contracts(contracts.where(F.col("layer") == layer)).collect()
    return {r["dataset"]: r.asDict(recursive=True) for r in rows}


def active_frame(spark: SparkSession, rows) -> DataFrame:
    """Contract rows as a local relation, whose size the planner knows."""
    arrow = to_arrow_schema(CONTRACT_SCHEMA)
    plain = [{k: r.get(k) for k in CONTRACT_SCHEMA.names} | {"required_fields": r.get("required_fields") or []} for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(plain, arrow)).to(CONTRACT_SCHEMA)


def active_contracts_for(spark: SparkSession, contracts: DataFrame, layer: str,
                         datasets: list[str] | None = None) -> tuple[DataFrame, dict[str, dict]]:
    """Active contracts of ``layer`` (of ``datasets``, if given) as a relation
    and as rows by dataset.

    Raises NoContractError naming every requested dataset without one.
    """
    if datasets is not None:
        contracts = contracts.where(F.col("dataset").isin(list(datasets)))
    rows = collect_active(contracts, layer)
    if datasets is not None:
        missing = [(d, layer) for d in datasets if d not in rows]
        if missing:
            raise NoContractError(missing)
    return active_frame(spark, rows.values()), rows


def next_version(contracts: DataFrame, dataset: str, layer: str) -> int:
    row = (
        contracts.where((F.col("dataset") == dataset) & (F.col("layer") == layer))
        .agg(F.max("contract_version").alias("v"))
        .collect()[0]
    )
    return int(row["v"] or 0) + 1


def latest_by_window(contracts: DataFrame) -> DataFrame:
    """The same selection as ``active_contracts`` written as a top-1 window
    (planned by Catalyst as a WindowGroupLimit)."""
    w = Window.partitionBy("dataset", "layer").orderBy(F.col("contract_version").desc())
    return contracts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
