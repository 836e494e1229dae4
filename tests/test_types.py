"""Contract type vocabulary (K14) without data."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from lakeward.functions import types as ty
from lakeward.operators.contracts import FieldContract


def test_vocabulary_round_trip():
    for name in ("string", "date", "decimal", "bigint", "int", "double", "float", "boolean",
                 "timestamp", "array<float>", "decimal(10,3)"):
        assert ty.contract_type_of(ty.spark_sql_type(name)) == name
    assert ty.spark_sql_type("decimal") == "decimal(18,2)"
    assert ty.spark_sql_type("timestamp") == "timestamp_ntz"
    assert ty.contract_type_of("integer") == "int" and ty.contract_type_of("long") == "bigint"


def test_unknown_types_refused():
    for bad in ("varchar2", "decimal(40,2)", "decimal(5,6)", "array<varchar2>"):
        with pytest.raises(ty.UnknownTypeError):
            ty.spark_sql_type(bad)


def test_contract_struct_and_quote(spark):
    st = ty.contract_struct((FieldContract("a.b", "decimal"), FieldContract("c", "date", required=False)))
    assert st.fields[0] == T.StructField("a.b", T.DecimalType(18, 2), False)
    assert st.fields[1].nullable and st.fields[2].name == "batch_id"
    assert ty.quote("a.b") == "`a.b`" and ty.quote("x`y") == "`x``y`"
