"""Decision matrix (all cases gated in one Spark job) and a property test of
the diff, field by field."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.operators import contracts as C
from lakeward.operators import diff as D
from lakeward.operators.contracts import Contract, FieldContract

import fixtures as FX

OBS_SCHEMA = "dataset string, batch_id string, observed_schema array<struct<name:string,data_type:string>>"


def _clean(types=None):
    types = types or {}
    return [(n, types.get(n, FX.CLEAN_TYPES[n])) for n in FX.CLEAN_HEADER]


def _gate(spark, cases, contracts):
    obs = spark.createDataFrame([("claims", bid, fields) for bid, fields in cases], OBS_SCHEMA)
    active, _ = C.active_contracts_for(spark, C.contracts_frame(spark, contracts), "silver", ["claims"])
    return {r["batch_id"]: r for r in D.gate_decisions(obs, active).collect()}


def test_decision_matrix_v1(spark):
    token_only = Contract("claims", "silver", 1, FX.V1_FIELDS, ("additive:place_of_service",))
    cases = {
        "clean": _clean(),
        "reordered": list(reversed(_clean())),                                   # S1
        "case": [("Claim_ID", "string")] + _clean()[1:],                          # S2
        "renamed": [("claim_number", "string")] + _clean()[1:],                   # S3
        "added": _clean() + [("place_of_service", "string")],
        "missing": _clean()[1:],
        "type_change": _clean({"billed_amount": "string"}),
        "empty": [],                                                              # S14
        "duplicate_same": _clean() + [("claim_id", "string")],                    # S15: last wins
        "duplicate_retyped": _clean() + [("claim_id", "bigint")],                 # last type counts
        "null_type": [("claim_id", None)] + _clean()[1:],                          # T7
    }
    got = _gate(spark, list(cases.items()), [FX.silver_v1()])
    expect = {
        "clean": "allow", "reordered": "allow", "case": "quarantine", "renamed": "quarantine",
        "added": "quarantine", "missing": "quarantine", "type_change": "quarantine", "empty": "quarantine",
        "duplicate_same": "allow", "duplicate_retyped": "quarantine", "null_type": "quarantine",
    }
    assert {k: got[k]["decision"] for k in cases} == expect
    assert got["case"]["missing_fields"] == ["claim_id"] and got["case"]["added_fields"] == ["Claim_ID"]
    assert got["renamed"]["missing_fields"] == ["claim_id"] and got["renamed"]["added_fields"] == ["claim_number"]
    assert got["empty"]["missing_fields"] == sorted(FX.CLEAN_HEADER)
    assert got["duplicate_retyped"]["changed_fields"][0].asDict() == {
        "name": "claim_id", "expected": "string", "observed": "bigint"}
    assert got["null_type"]["changed_fields"][0]["observed"] is None
    assert got["clean"]["contract_version"] == 1

    # A token alone admits the added column (the projection drops it);
    # missing or changed beats any approval
    got = _gate(spark, [("added", cases["added"]),
                        ("added_missing", cases["missing"] + [("place_of_service", "string")]),
                        ("added_other", cases["clean"] + [("other", "string")])], [token_only])
    assert got["added"]["decision"] == "allow"
    assert got["added_missing"]["decision"] == "quarantine"
    assert got["added_other"]["decision"] == "quarantine"


def test_decision_matrix_v2(spark):
    # Required does not enter the decision; a v1-shaped batch lacks the
    # optional column and is held under v2. S6: the replay has an empty diff.
    got = _gate(spark, [("clean", _clean()), ("added", _clean() + [("place_of_service", "string")])],
                [FX.silver_v1(), FX.silver_v2()])
    assert got["clean"]["decision"] == "quarantine"
    assert got["clean"]["missing_fields"] == ["place_of_service"]
    assert got["added"]["decision"] == "allow"
    assert got["added"]["added_fields"] == [] and got["added"]["contract_version"] == 2


NAMES = st.sampled_from(["a", "b", "c", "d", "A", "a.b", "é", "z"])
TYPES = st.sampled_from(["string", "date", "decimal", "bigint"])
FIELDS = st.lists(st.tuples(NAMES, TYPES), max_size=6)


@settings(max_examples=8, deadline=None)
@given(expected=st.lists(st.tuples(NAMES, TYPES), max_size=5, unique_by=lambda f: f[0].lower()),
       observed=st.lists(FIELDS, min_size=1, max_size=30),
       allowed=st.lists(NAMES, max_size=3),
       seed=st.integers(0, 1000))
def test_diff_properties(spark, expected, observed, allowed, seed):
    tokens = tuple(f"additive:{n}" for n in allowed)
    contract = Contract("claims", "silver", 1, tuple(FieldContract(n, t) for n, t in expected), tokens)
    cases = [(f"b{i}", obs) for i, obs in enumerate(observed)]
    # column order is not drift: a permuted copy must decide the same
    rng = random.Random(seed)
    cases += [(f"p{i}", rng.sample(obs, len(obs))) for i, obs in enumerate(observed)
              if len({n for n, _ in obs}) == len(obs)]
    got = _gate(spark, cases, [contract])
    declared = {f.name: f.data_type for f in contract.fields}
    for bid, header in cases:
        check_properties(got[bid], declared, header, set(allowed))


def check_properties(event, declared, header, approved):
    """What must hold of any decision, field by field: each name is judged on
    its own from what is declared and the last type that the header gives it."""
    last = {}
    for name, data_type in header:
        last[name] = data_type
    told = {c["name"]: (c["expected"], c["observed"]) for c in event["changed_fields"]}
    for name in declared.keys() | last.keys() | {"never-there"}:
        here, there = name in declared, name in last
        assert (name in event["added_fields"]) == (there and not here)
        assert (name in event["missing_fields"]) == (here and not there)
        differs = here and there and declared[name] != last[name]
        assert told.get(name) == ((declared[name], last[name]) if differs else None)
    for names in (event["added_fields"], event["missing_fields"], [c["name"] for c in event["changed_fields"]]):
        assert list(names) == sorted(set(names))
    # a batch is held exactly when some field would be lost, retyped, or arrive unapproved
    unapproved = set(event["added_fields"]) - approved
    held = len(event["missing_fields"]) + len(told) + len(unapproved) > 0
    assert event["decision"] == ("quarantine" if held else "allow")


def test_active_contract_forms_agree(spark):
    """Highest version per (dataset, layer), as one max_by aggregate
    and as a top-1 window; approved_at is not consulted."""
    late_v1 = Contract("claims", "gold", 1, FX.V1_FIELDS, (), "x", "2030-01-01T00:00:00+00:00")
    reg = C.contracts_frame(spark, [FX.silver_v1(), FX.silver_v2(), late_v1])
    a = sorted((r["dataset"], r["layer"], r["contract_version"]) for r in C.active_contracts(reg).collect())
    b = sorted((r["dataset"], r["layer"], r["contract_version"]) for r in C.latest_by_window(reg).collect())
    assert a == b == [("claims", "gold", 1), ("claims", "silver", 2)]
    hist = {r["layer"]: list(r["versions"]) for r in C.contract_history(reg).collect()}
    assert hist == {"silver": [1, 2], "gold": [1]}
