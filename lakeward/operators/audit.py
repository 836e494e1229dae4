"""Audit events: names and types only, never values.

One event per (batch, layer) decision, built as a projection of the decision
relation. ``event_id`` is a hash of the decision's identity, so a retried
task or a rerun of the same ``run_id`` writes the same id.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions import exprs as X

# Keys an audit event must never carry (they would hold data
# values rather than schema metadata).
BANNED_KEYS = ("rows", "sample", "payload", "values", "billed_amount")

# Texts that no event may hold, unless a run names others.
BANNED_TEXTS = ("CLM-", "120.50")

# Lines of events that are shipped to the tasks, in bytes at most; beyond it
# events and values meet in a join.
LINES_BOUND = 16 << 20

# A sensitive value meets the events on its last so many characters (all of
# a shorter one), and is then looked for as a whole.
GRAM = 8

EVENT_COLUMNS = (
    "event_id", "dataset", "layer", "batch_id", "run_id", "expected_schema", "observed_schema",
    "added_fields", "missing_fields", "changed_fields", "decision", "contract_version",
    "event_time", "bronze_path",
)


class MetadataLeakError(ValueError):
    """An audit event would carry data values. ``found`` is a DataFrame of
    all findings (event_id, batch_id, value, source), ``total`` their number."""

    found: DataFrame | None = None
    total = 0


def audit_events(decisions: DataFrame, *, run_id: str, event_time: datetime) -> DataFrame:
    """Decision relation -> event relation (the ``schema_audit_events`` layout)."""
    bronze = F.col("bronze_path") if "bronze_path" in decisions.columns else F.lit(None).cast("string")
    observed = F.transform(
        F.coalesce(F.col("observed_schema"), F.array().cast("array<struct<name:string,data_type:string>>")),
        lambda x: F.struct(x["name"].alias("name"), x["data_type"].alias("data_type")),
    )
    return decisions.select(
        X.event_id(F.col("dataset"), F.col("layer"), F.col("batch_id"), F.lit(run_id),
                   F.col("contract_version")).alias("event_id"),
        "dataset",
        "layer",
        "batch_id",
        F.lit(run_id).alias("run_id"),
        "expected_schema",
        observed.alias("observed_schema"),
        "added_fields",
        "missing_fields",
        "changed_fields",
        "decision",
        F.col("contract_version").cast("int").alias("contract_version"),
        F.lit(event_time).cast("timestamp").alias("event_time"),
        bronze.alias("bronze_path"),
    )


def _field_names(dtype, prefix=""):
    from pyspark.sql import types as T

    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield prefix + f.name
            yield from _field_names(f.dataType, prefix + f.name + ".")
    elif isinstance(dtype, T.ArrayType):
        yield from _field_names(dtype.elementType, prefix)


def assert_metadata_only(events: DataFrame, banned_keys=BANNED_KEYS) -> None:
    """Refuse an event relation whose schema has a value-bearing key
    (checked on the schema, so no job runs)."""
    names = {n.split(".")[-1] for n in _field_names(events.schema)}
    found = sorted(names & set(banned_keys))
    if found:
        raise MetadataLeakError(f"Audit event contains value-bearing keys: {found}")


def event_text(events: DataFrame) -> F.Column:
    """Every text of an event as it is (no JSON escapes), one per line."""
    pairs = lambda c, *keys: F.array_join(F.flatten(F.transform(c, lambda x: F.array(*[x[k] for k in keys]))), "\n")
    return F.concat_ws(
        "\n", "dataset", "layer", "batch_id", "run_id", "decision", "bronze_path",
        F.array_join("added_fields", "\n"), F.array_join("missing_fields", "\n"),
        pairs(F.col("changed_fields"), "name", "expected", "observed"),
        pairs(F.col("expected_schema"), "name", "data_type"), pairs(F.col("observed_schema"), "name", "data_type"))


def leak_scan(events: DataFrame, sensitive: DataFrame | None = None, patterns=(), texts=()) -> DataFrame:
    """Events that hold a sensitive value anywhere in a text (a substring
    test), one of ``texts``, or a match of a banned pattern. Returns event_id,
    batch_id, value, source.

    ``sensitive`` has columns (``value``, ``source``). The events' distinct
    lines are metadata and mostly few: up to LINES_BOUND bytes of them, which
    one job measures, are shipped to the tasks, which run them through an
    automaton of their share of the values. Beyond the bound a value's last
    GRAM characters (or all of a shorter value) are joined to the substrings
    of that length of the lines, and what meets is confirmed with
    ``contains``."""
    events = events.select("event_id", "batch_id", event_text(events).alias("text"))
    fixed = [F.struct(F.lit(t).alias("value"), F.lit("banned text").alias("source"), F.contains("text", F.lit(t)).alias("hit")) for t in texts]
    fixed += [F.struct(F.lit(p).alias("value"), F.lit("pattern").alias("source"), F.col("text").rlike(p).alias("hit")) for p in patterns]
    found = None
    if fixed:
        found = events.select("event_id", "batch_id", F.explode(F.filter(F.array(*fixed), lambda x: x["hit"])).alias("f")) \
            .select("event_id", "batch_id", "f.value", "f.source")
    if sensitive is not None:
        values = sensitive.select(F.col("value").cast("string").alias("value"), "source").where("value <> ''").distinct()
        lines = events.select("event_id", "batch_id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
        part = lines.join(_line_hits(lines.select("line").distinct(), values), "line").select("event_id", "batch_id", "value", "source").distinct()
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = events.select("event_id", "batch_id", F.lit("").alias("value"), F.lit("").alias("source")).where("false")
    return found


def _line_hits(lines: DataFrame, values: DataFrame) -> DataFrame:
    """(line, value, source): every line that holds a value."""
    try:
        import ahocorasick  # noqa: F401 - the join below does without
    except ImportError:
        return _joined_hits(lines, values)
    size = lines.agg(F.coalesce(F.sum(F.octet_length("line")), F.lit(0))).first()[0]
    if size > LINES_BOUND:
        return _joined_hits(lines, values)
    sent = lines.sparkSession.sparkContext.broadcast([r[0] for r in lines.collect()])

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        for batch in batches:
            value, source = batch.column("value").to_pylist(), batch.column("source").to_pylist()
            places: dict[str, list[int]] = {}
            for i, v in enumerate(value):
                places.setdefault(v, []).append(i)
            automaton = ahocorasick.Automaton()
            for v, at in places.items():
                automaton.add_word(v, at)
            automaton.make_automaton()
            for lo in range(0, len(sent.value), 1 << 12):
                hits = {(line, i) for line in sent.value[lo:lo + (1 << 12)] for _, at in automaton.iter(line) for i in at} if places else set()
                yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hits], pa.string()), pa.array([value[h[1]] for h in hits], pa.string()),
                                                  pa.array([source[h[1]] for h in hits], pa.string())], ["line", "value", "source"])

    return values.mapInArrow(run, "line string, value string, source string")


def _joined_hits(lines: DataFrame, values: DataFrame) -> DataFrame:
    """``_line_hits`` for any amount of lines."""
    values = values.withColumn("gram", F.when(F.char_length("value") > GRAM, F.substring("value", -GRAM, GRAM)).otherwise(F.col("value")))
    # the substrings of every length up to GRAM at each place
    places = lines.select("line", F.explode(F.sequence(F.lit(1), F.char_length("line"))).alias("at"))
    grams = places.select("line", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.col("line").substr(F.col("at"), n)))).alias("gram")).distinct()
    return grams.join(values, "gram").where(F.contains("line", "value")).select("line", "value", "source").distinct()


def audit_summary(events: DataFrame) -> DataFrame:
    """Batches per (decision, reason)."""
    reason = X.reason(F.col("added_fields"), F.col("missing_fields"), F.col("changed_fields"))
    return events.groupBy("decision", reason.alias("reason")).agg(F.count("*").alias("batches"))
