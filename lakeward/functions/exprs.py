"""Column expressions of the gate. All run inside the JVM.

The observed schema of a batch is one ``array<struct<name,data_type>>`` in
header order; the contract is one ``array<struct<name,data_type,required>>``.
Every comparison below is an array function on one row, hash-based where the
cost could grow with the width of a file, so the diff needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALLOW = "allow"
QUARANTINE = "quarantine"
APPROVAL_PREFIX = "additive:"


def dedup_last_wins(observed: Column) -> Column:
    """Indexed observed fields, one per name; a repeated name keeps its last type.

    Returns ``array<struct<ordinal int, name string, data_type string>>`` in
    header order. The quadratic filter runs only for headers that repeat a name.
    """
    indexed = F.transform(
        observed,
        lambda x, i: F.struct(
            (i + 1).cast("int").alias("ordinal"),
            x["name"].alias("name"),
            x["data_type"].alias("data_type"),
        ),
    )
    names = F.transform(observed, lambda x: x["name"])
    has_dup = F.size(F.array_distinct(names)) < F.size(names)
    unique = F.filter(
        indexed,
        lambda x: ~F.exists(
            indexed, lambda y: (y["name"] == x["name"]) & (y["ordinal"] > x["ordinal"])
        ),
    )
    return F.when(has_dup, unique).otherwise(indexed)


def names_of(fields: Column) -> Column:
    return F.transform(fields, lambda f: f["name"])


def pairs_of(fields: Column) -> Column:
    return F.transform(
        fields, lambda f: F.struct(f["name"].alias("name"), f["data_type"].alias("data_type"))
    )


def added_fields(obs_names: Column, exp_names: Column) -> Column:
    return F.array_sort(F.array_except(obs_names, exp_names))


def missing_fields(obs_names: Column, exp_names: Column) -> Column:
    return F.array_sort(F.array_except(exp_names, obs_names))


def changed_fields(obs_pairs: Column, exp_pairs: Column, exp_names: Column) -> Column:
    """Common names whose type strings differ, sorted by name.

    ``array_except`` on (name, type) pairs leaves the observed fields that are
    added or retyped; only the retyped ones are kept.
    """
    mismatched = F.filter(
        F.array_except(obs_pairs, exp_pairs), lambda x: F.array_contains(exp_names, x["name"])
    )
    return F.array_sort(
        F.transform(
            mismatched,
            lambda x: F.struct(
                x["name"].alias("name"),
                F.filter(exp_pairs, lambda e: e["name"] == x["name"])[0]["data_type"].alias("expected"),
                x["data_type"].alias("observed"),
            ),
        )
    )


def decision(added: Column, missing: Column, changed: Column, allowed_changes: Column) -> Column:
    """Empty diff -> allow; missing or changed -> quarantine; every added name
    approved by an ``additive:<name>`` token -> allow; otherwise quarantine."""
    approved = F.forall(
        added,
        lambda n: F.array_contains(F.coalesce(allowed_changes, F.array().cast("array<string>")),
                                   F.concat(F.lit(APPROVAL_PREFIX), n)),
    )
    return (
        F.when((F.size(added) == 0) & (F.size(missing) == 0) & (F.size(changed) == 0), F.lit(ALLOW))
        .when((F.size(missing) > 0) | (F.size(changed) > 0), F.lit(QUARANTINE))
        .when(approved, F.lit(ALLOW))
        .otherwise(F.lit(QUARANTINE))
    )


def reason(added: Column, missing: Column, changed: Column) -> Column:
    """Which parts of the diff are non-empty: ``none`` or e.g. ``added+missing``."""
    parts = F.array_compact(
        F.array(
            F.when(F.size(added) > 0, F.lit("added")),
            F.when(F.size(missing) > 0, F.lit("missing")),
            F.when(F.size(changed) > 0, F.lit("changed")),
        )
    )
    return F.when(F.size(parts) == 0, F.lit("none")).otherwise(F.array_join(parts, "+"))


def event_id(*cols: Column) -> Column:
    """Deterministic event id, so a retried task writes the same id."""
    return F.sha2(F.concat_ws(":", *[c.cast("string") for c in cols]), 256)


def comma_list(arr: Column) -> Column:
    return F.array_join(arr, ",")


def changed_text(changed: Column) -> Column:
    """``name:expected->observed`` items joined by commas."""
    return F.array_join(
        F.transform(
            changed,
            lambda c: F.concat(c["name"], F.lit(":"), c["expected"], F.lit("->"),
                               F.coalesce(c["observed"], F.lit("null"))),
        ),
        ",",
    )


def schema_text(fields: Column) -> Column:
    """``name:type`` items joined by commas, in array order."""
    return F.array_join(
        F.transform(fields, lambda f: F.concat(f["name"], F.lit(":"), F.coalesce(f["data_type"], F.lit("null")))),
        ",",
    )
