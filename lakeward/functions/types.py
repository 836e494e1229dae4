"""Contract type vocabulary and its mapping to Spark types.

A contract declares each field with a short type name. The comparison of an
observed schema with a contract treats these names as opaque strings; the
mapping below is used only when a table is created, altered or written, and
when a live DataFrame schema is observed.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The contract type names and the Spark SQL type each one means.
# `decimal` without precision is DECIMAL(18,2); `timestamp` is the wall-clock
# (no time zone) timestamp that the Parquet feeds carry.
SCALAR_TYPES: dict[str, str] = {
    "string": "string",
    "date": "date",
    "decimal": "decimal(18,2)",
    "bigint": "bigint",
    "int": "int",
    "smallint": "smallint",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "timestamp": "timestamp_ntz",
    "timestamp_ltz": "timestamp",
    "binary": "binary",
}

_DECIMAL = re.compile(r"^decimal\((\d+),(\d+)\)$")
_ARRAY = re.compile(r"^array<(.+)>$")


class UnknownTypeError(ValueError):
    """A contract names a type outside the vocabulary."""


def normalize(type_name: str) -> str:
    return re.sub(r"\s+", "", str(type_name)).lower()


def spark_sql_type(type_name: str) -> str:
    """Contract type name -> Spark SQL DDL type string."""
    name = normalize(type_name)
    if name in SCALAR_TYPES:
        return SCALAR_TYPES[name]
    dec = _DECIMAL.match(name)
    if dec:
        precision, scale = int(dec.group(1)), int(dec.group(2))
        if not (0 < precision <= 38 and 0 <= scale <= precision):
            raise UnknownTypeError(f"Invalid decimal type {type_name!r}")
        return f"decimal({precision},{scale})"
    arr = _ARRAY.match(name)
    if arr:
        return f"array<{spark_sql_type(arr.group(1))}>"
    raise UnknownTypeError(f"Unknown contract type {type_name!r}")


def spark_type(type_name: str) -> T.DataType:
    return T._parse_datatype_string(spark_sql_type(type_name))


def validate(type_name: str) -> str:
    spark_sql_type(type_name)
    return type_name


# Reverse direction: a Spark dtype string as reported by DataFrame.dtypes.
_SPARK_TO_CONTRACT = {v: k for k, v in SCALAR_TYPES.items()}


def contract_type_of(spark_dtype: str) -> str:
    """Spark dtype string (``DataFrame.dtypes``) -> contract type name."""
    name = normalize(spark_dtype)
    if name in _SPARK_TO_CONTRACT:
        return _SPARK_TO_CONTRACT[name]
    if name == "integer":
        return "int"
    if name == "long":
        return "bigint"
    if _DECIMAL.match(name):
        return name
    arr = _ARRAY.match(name)
    if arr:
        return f"array<{contract_type_of(arr.group(1))}>"
    return name


def contract_struct(fields, *, batch_column: str | None = "batch_id") -> T.StructType:
    """Contract fields -> StructType (+ the batch column).

    ``required`` becomes nullability. Parquet tables drop it on write, so the
    gate never relies on it for enforcement.
    """
    out = [T.StructField(f.name, spark_type(f.data_type), not f.required) for f in fields]
    if batch_column:
        out.append(T.StructField(batch_column, T.StringType(), False))
    return T.StructType(out)


def quote(name: str) -> str:
    """Backtick a column name so dots and spaces are not parsed as paths."""
    return "`" + name.replace("`", "``") + "`"
