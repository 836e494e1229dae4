"""The gate run: observe -> decide -> audit -> hold or promote, for many
batches and feeds in one run.

Order of effects (each ACTION is one Spark write over all batches):

1. contracts are resolved (metadata); a dataset without an
   active silver contract (or gold contract when gold is promoted) stops the
   run before anything is written; then ACTION 0 keeps the observed schema
   of every batch in bronze;
2. ACTION 1 appends one audit event per batch (names and types only);
3. the decisions are read back from the audit table by ``run_id``, so the
   data writes act on exactly what was recorded, not on a recomputation;
   batches that an earlier call of the run recorded keep their decision;
4. ACTION 2 appends quarantine pointer rows;
5. ACTION 3 appends (or replaces) the admitted batches in silver, projected
   on the silver contract and cast to its types;
6. ACTION 4 (optional) releases the same batches from silver to gold.

Rows never pass through the driver; only contract rows, per-decision counts
and error samples do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import exprs as X
from lakeward.operators import audit as A
from lakeward.operators import contracts as C
from lakeward.operators import diff as D
from lakeward.operators import project as P
from lakeward.operators import tables as TB

# rows_for(dataset, allowed) -> rows with batch_id. Optional attributes:
# ``clustered_by_batch`` (each input split holds one batch, so the layer
# write needs no shuffle), ``holds(dataset)`` (batches it could not read) and
# ``takes_columns`` (it is given ``columns``, the names the contract needs).
RowSource = Callable[[str, DataFrame], DataFrame]

# How many offending batches an error's text lists; the error's attributes
# give all of them.
MESSAGE_SAMPLE = 20


class GateError(RuntimeError):
    """What a run could not promote or release.

    ``held`` is a DataFrame of all offending batches (batch_id first),
    ``total`` their number, ``result`` the run's GateResult (None outside a
    run). ``batch_ids`` reads the ids from ``held`` when asked for."""

    what = "Batches held"

    def __init__(self, held: DataFrame | None, total: int, dataset: str | None = None, sample=None):
        self.held, self.total, self.dataset = held, total, dataset
        self.result: GateResult | None = None
        shown = self._sample() if sample is None else sample
        more = f" and {total - len(shown)} more" if total > len(shown) else ""
        where = f" ({dataset})" if dataset else ""
        super().__init__(f"{self.what}{where}: {', '.join(shown)}{more}")

    def _sample(self) -> list[str]:
        return _sample(self.held)

    @property
    def batch_ids(self) -> list[str]:
        return sorted(r[0] for r in self.held.select("batch_id").distinct().toLocalIterator())


class GateRunError(GateError):
    """Several errors of one run, one per feed and kind (``errors``); ``held``
    is the union of their batches with ``dataset``."""

    what = "Several feeds have held batches"

    def __init__(self, errors: list[GateError]):
        self.errors = list(errors)
        held = None
        for e in self.errors:
            part = e.held.select("batch_id", F.lit(e.dataset).alias("dataset"), F.lit(type(e).__name__).alias("error"))
            held = part if held is None else held.unionByName(part)
        super().__init__(held, sum(e.total for e in self.errors), sample=[str(e) for e in self.errors])


class QuarantinedError(GateError):
    what = "Schema differs from the approved contract -> quarantine"


class ValueCheckError(GateError, ValueError):
    """Batches held at promotion because of their values (never recorded in
    the error: only batch, column and count). ``held`` has batch_id,
    column_name, failures."""

    what = "Values fail a contract check; batches held"

    def _sample(self) -> list[str]:
        rows = self.held.orderBy("batch_id", "column_name").limit(MESSAGE_SAMPLE).collect()
        return [f"{r['batch_id']}.{r['column_name']} ({r['failures']})" for r in rows]

    @property
    def failures(self) -> list[tuple]:
        return sorted((r["batch_id"], r["column_name"], r["failures"])
                      for r in self.held.select("batch_id", "column_name", "failures").toLocalIterator())


class CastFailureError(ValueCheckError):
    what = "Values do not cast to the contract type; batches held"


class RequiredNullError(ValueCheckError):
    what = "Required fields hold NULL; batches held"


class HeaderCollisionError(GateError, ValueError):
    what = "Header names collide (ignoring case); not promoted"


class HeaderMismatchError(GateError, ValueError):
    what = "File header differs from the recorded schema; not promoted"


class LeakError(GateError, A.MetadataLeakError):
    """Batches whose event would hold a sensitive value, a banned text or a
    banned pattern; ``found`` has event_id, batch_id, value, source."""

    what = "Audit events would contain data values; batches held"

    def __init__(self, found: DataFrame, total: int):
        sources = [f"{r['batch_id']} ({r['source']})" for r in
                   found.select("batch_id", "source").distinct().orderBy("batch_id", "source").limit(MESSAGE_SAMPLE).collect()]
        super().__init__(found.select("batch_id").distinct(), total, sample=sources)
        self.found = found


class NoSilverRowsError(GateError, ValueError):
    what = "No Silver rows (the gate did not promote these batches)"


class UnreleasedColumnError(ValueError):
    pass


HOLD_REASONS = ("cast_failure:", "required_null:", "header_collision", "header_mismatch")
LEAK_REASON = "metadata_leak:"


@dataclass
class GateResult:
    run_id: str
    decisions: dict = field(default_factory=dict)  # (dataset, decision) -> batches
    silver_batches: dict = field(default_factory=dict)  # dataset -> batches written
    gold_batches: dict = field(default_factory=dict)
    errors: list = field(default_factory=list)
    names: TB.TableNames = field(default_factory=TB.TableNames)
    promote_gold: bool = False

    def count(self, decision: str, dataset: str | None = None) -> int:
        return sum(n for (d, dec), n in self.decisions.items() if dec == decision and dataset in (None, d))

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """Per batch of this run: dataset, batch_id, decision, contract_version,
        hold (reason a decided-allow batch was held at promotion, else NULL),
        silver_written, gold_written. Read from the run's tables."""
        events = spark.table(self.names.audit).where(F.col("run_id") == self.run_id)
        holds = None
        for d in sorted({d for d, _ in self.decisions}):
            t = self.names.quarantine(d)
            if not TB.table_exists(spark, t):
                continue
            h = spark.table(t).where((F.col("run_id") == self.run_id) & F.col("decision").isNotNull() & _held_reason()) \
                .select(F.lit(d).alias("dataset"), "batch_id", F.col("reason").alias("hold"))
            holds = h if holds is None else holds.unionByName(h)
        if holds is None:
            holds = spark.createDataFrame([], "dataset string, batch_id string, hold string")
        holds = holds.groupBy("dataset", "batch_id").agg(F.array_join(F.array_sort(F.collect_set("hold")), ";")
                                                         .alias("hold"))
        written = (F.col("decision") == X.ALLOW) & F.col("hold").isNull()
        return events.join(holds, ["dataset", "batch_id"], "left").select(
            "dataset", "batch_id", "decision", "contract_version", "hold",
            written.alias("silver_written"), (written & F.lit(self.promote_gold)).alias("gold_written"))


def _append_holds(spark: SparkSession, table: str, rows: DataFrame, run_id: str, dedup: bool) -> None:
    """Append quarantine rows; with ``dedup`` skip those this run already
    wrote (same batch and reason), so a resumed run adds only what is missing."""
    TB.ensure_quarantine_table(spark, table)
    if dedup:
        done = _read_back(spark, table).where(F.col("run_id") == run_id).select("batch_id", "reason")
        rows = rows.join(done, ["batch_id", "reason"], "left_anti")
    rows.write.mode("append").format("parquet").saveAsTable(table)


def _read_back(spark: SparkSession, table: str) -> DataFrame:
    """Read a table this run just wrote. The write may have run in another
    session (a streaming micro-batch's), so the reader's file listing is
    refreshed first."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _sample(df: DataFrame, col: str = "batch_id") -> list[str]:
    return [r[0] for r in df.select(col).orderBy(col).limit(MESSAGE_SAMPLE).collect()]


def _is_value_error(exc: Exception) -> bool:
    """A row that project_to_contract refused (it raises these markers itself,
    whatever the session's ANSI setting)."""
    text = str(exc)
    return P.CAST_MARKER in text or P.REQUIRED_NULL_MARKER in text


def collisions(recorded: DataFrame) -> DataFrame:
    """Batches whose raw header repeats a name, ignoring case (Spark would
    rename or mis-resolve such columns)."""
    names = F.transform(F.col("observed_schema"), lambda x: F.lower(x["name"]))
    return recorded.where(F.size(F.array_distinct(names)) < F.size(names)).select("batch_id")


def gate_batches(
    spark: SparkSession,
    observed: DataFrame,
    rows_for: RowSource,
    *,
    names: TB.TableNames = TB.TableNames(),
    run_id: str | None = None,
    promote_gold: bool = False,
    fail_on_quarantine: bool = False,
    on_replay: str = "append",
    sensitive: DataFrame | None = None,
    banned_patterns=(),
    banned_texts=A.BANNED_TEXTS,
    feeds_at_once: int = 4,
    event_time: datetime | None = None,
    isolation: str = "staged",
    enforce_required: bool = False,
    raise_errors: bool = True,
) -> GateResult:
    """Gate every batch of ``observed`` (dataset, batch_id, observed_schema
    [, bronze_path]) in one run. ``rows_for(dataset, allowed)`` returns the
    rows (with ``batch_id``) of the allowed batches of a dataset; ``allowed``
    carries batch_id, bronze_path and the recorded observed_schema.

    A run_id names a run, which may be called again, with the same batches
    or more. A batch that the run has recorded keeps its decision, and its
    data is replaced (a call that failed after ACTION 1 is mended by calling
    again); a batch that the run has held stays held; every other batch is
    landed, decided and appended. A batch listed twice counts once.

    A batch whose event would hold a value of ``sensitive``, a match of
    ``banned_patterns`` or one of ``banned_texts`` gets no event and is not
    promoted; its quarantine row names it by a hash. The other batches go on.

    Feeds are promoted ``feeds_at_once`` at a time. If one fails, the others
    are finished first, then its error is raised.

    ``isolation`` says how batches with failing values are kept out of silver
    (see ``_write_silver``): by a staging table, which reads the source once
    whatever fails, or optimistically.

    What is held after its decision (header collisions and mismatches, value
    checks) raises once everything else is written: the error itself if
    there is one, else a GateRunError; its ``result`` is the GateResult. With
    ``raise_errors=False`` the errors are only listed in the result.
    """
    if on_replay not in ("append", "replace"):
        raise ValueError("on_replay must be 'append' or 'replace'")
    if isolation not in ("staged", "optimistic"):
        raise ValueError("isolation must be 'staged' or 'optimistic'")
    run_id = run_id or str(uuid.uuid4())
    event_time = C.event_clock(event_time)
    TB.ensure_control_tables(spark, names)
    # Observations are metadata (one row per batch); persisted until bronze
    # holds them, so the dataset check and the landing evaluate them once
    # (for CSV feeds, one header read per file). Recomputable if lost.
    owned = observed.storageLevel == StorageLevel.NONE
    if owned:
        observed = observed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        datasets = sorted(r["dataset"] for r in observed.select("dataset").distinct().collect())
        leaks = {"sensitive": sensitive, "patterns": tuple(banned_patterns), "texts": tuple(banned_texts)}
        result = _gate(spark, observed, rows_for, datasets, names, run_id, promote_gold, fail_on_quarantine, on_replay,
                       leaks, event_time, isolation, enforce_required, feeds_at_once)
    finally:
        if owned:
            observed.unpersist()
    if result.errors and raise_errors:
        error = result.errors[0] if len(result.errors) == 1 else GateRunError(result.errors)
        error.result = result
        raise error
    return result


BATCH = ["dataset", "batch_id"]


def _without_leaks(spark, events, leaks, names, run_id):
    """The events that hold no value, and the error that tells the others,
    whose batches get a quarantine row."""
    A.assert_metadata_only(events)
    found = A.leak_scan(events, **leaks).persist(StorageLevel.MEMORY_AND_DISK)
    total = found.count()
    if not total:
        found.unpersist()
        return events, []
    ids = found.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    held = events.join(ids, "event_id")
    # names and paths may be what leaks: the row has a hash of the batch id and no path
    rows = held.select(F.concat(F.lit("sha256:"), F.sha2("batch_id", 256)).alias("batch_id"), F.lit(X.QUARANTINE).alias("decision"),
                       *(F.lit(None).cast(t).alias(c) for c, t in (("added_fields", "array<string>"), ("missing_fields", "array<string>"),
                                                                   ("changed_fields", TB._CHANGED), ("bronze_path", "string"))),
                       "event_time", F.lit(run_id).alias("run_id"), F.concat(F.lit(LEAK_REASON), "sources").alias("reason"), "dataset")
    for d in sorted(r[0] for r in held.select("dataset").distinct().collect()):
        _append_holds(spark, names.quarantine(d), rows.where(F.col("dataset") == d).drop("dataset"), run_id, True)
    return events.join(ids, "event_id", "left_anti"), [LeakError(found, total)]


def _gate(spark, observed, rows_for, datasets, names, run_id, promote_gold, fail_on_quarantine, on_replay, leaks,
          event_time, isolation, enforce_required, feeds_at_once) -> GateResult:
    contracts = spark.table(names.contracts)
    active, silver_rows = C.active_contracts_for(spark, contracts, "silver", datasets)
    gold_rows = {}
    if promote_gold:
        _, gold_rows = C.active_contracts_for(spark, contracts, "gold", datasets)
        for d in datasets:
            lacking = sorted({f["name"] for f in gold_rows[d]["approved_schema"]}
                             - {f["name"] for f in silver_rows[d]["approved_schema"]})
            if lacking:
                raise P.ProjectionError(f"Gold contract of {d} needs columns silver does not hold: {lacking}")

    # ACTION 0: bronze keeps what arrived, once per batch of the run, whatever
    # the decision will be. The rest of the run reads the observations back
    # from it, so they are computed once (for CSV feeds: one header read per
    # file) and a call that failed here lands nothing twice.
    called = observed.select(*BATCH).distinct()
    events_before = spark.table(names.audit).where(F.col("run_id") == run_id)
    known = {r["dataset"]: r["n"] for r in events_before.join(called, BATCH, "left_semi").groupBy("dataset")
             .agg(F.count("*").alias("n")).collect()}
    TB.ensure_bronze(spark, names)
    landed = spark.table(names.bronze).where((F.col("run_id") == run_id) & F.col("dataset").isin(datasets))
    TB.land_observed(spark, observed.join(landed.select(*BATCH), BATCH, "left_anti"), run_id, event_time, names)
    landed = _read_back(spark, names.bronze).where((F.col("run_id") == run_id) & F.col("dataset").isin(datasets))
    undecided = landed.join(called, BATCH, "left_semi").join(events_before.select(*BATCH), BATCH, "left_anti")

    # ACTION 1: audit events of the batches that have none, before any data write.
    decisions = D.gate_decisions(undecided, active)
    events = A.audit_events(decisions, run_id=run_id, event_time=event_time)
    events, errors = _without_leaks(spark, events, leaks, names, run_id)
    stamp = uuid.uuid4().hex
    events.select(*[c for c in A.EVENT_COLUMNS if c != "run_id"], F.lit(stamp).alias("call_id"), "run_id") \
        .write.mode("append").partitionBy("run_id").format("parquet").saveAsTable(names.audit)
    recorded = _read_back(spark, names.audit).where(F.col("run_id") == run_id).join(called, BATCH, "left_semi")

    result = GateResult(run_id, names=names, promote_gold=promote_gold)
    for r in recorded.groupBy("dataset", "decision").agg(F.count("*").alias("n")).collect():
        result.decisions[(r["dataset"], r["decision"])] = r["n"]

    # ACTION 2: quarantine pointers (for batches recorded before, only those still missing).
    for d in datasets:
        if result.decisions.get((d, X.QUARANTINE), 0):
            held = recorded.where((F.col("dataset") == d) & (F.col("decision") == X.QUARANTINE))
            _append_holds(spark, names.quarantine(d), held.select(
                "batch_id", "decision", "added_fields", "missing_fields", "changed_fields", "bronze_path",
                "event_time", "run_id",
                X.reason(F.col("added_fields"), F.col("missing_fields"), F.col("changed_fields")).alias("reason"),
            ), run_id, bool(known.get(d)))

    # ACTION 3 and 4: promotion of the allowed batches: what this call
    # decided is appended, what an earlier call of the run recorded is replaced.
    def promote(d: str) -> list[GateError]:
        found: list[GateError] = []
        allowed = recorded.where((F.col("dataset") == d) & (F.col("decision") == X.ALLOW))
        parts = [(allowed.where(F.col("call_id") == stamp), on_replay)]
        if known.get(d):
            before = allowed.where(F.col("call_id") != stamp)
            if TB.table_exists(spark, names.quarantine(d)):
                held = _read_back(spark, names.quarantine(d)).where((F.col("run_id") == run_id) & _held_reason())
                before = before.join(held.select("batch_id"), "batch_id", "left_anti")
            parts.append((before, "replace"))
        for part, mode in parts:
            n = part.count()
            if n:
                _promote(spark, rows_for, d, part, n, mode, names, run_id, stamp, silver_rows[d], gold_rows.get(d), result, found,
                         isolation, enforce_required)
        return found

    admitted = [d for d in datasets if result.decisions.get((d, X.ALLOW), 0)]
    with ThreadPoolExecutor(max_workers=max(1, min(feeds_at_once, len(admitted) or 1))) as pool:
        feeds = [pool.submit(promote, d) for d in admitted]
    failed = [e for e in (f.exception() for f in feeds) if e is not None]
    if failed:
        raise failed[0]
    errors = errors + [e for f in feeds for e in f.result()]

    if fail_on_quarantine and result.count(X.QUARANTINE):
        held = recorded.where(F.col("decision") == X.QUARANTINE)
        errors.insert(0, QuarantinedError(held.select("batch_id"), result.count(X.QUARANTINE)))
    result.errors = errors
    return result


def _held_reason():
    """A quarantine row of a batch that was allowed and then held at promotion."""
    r = F.col("reason")
    return r.startswith(HOLD_REASONS[0]) | r.startswith(HOLD_REASONS[1]) | r.isin(*HOLD_REASONS[2:])


def _hold(spark, table: str, batches: DataFrame, reason, run_id: str) -> None:
    _append_holds(spark, table, batches.select(
        "batch_id", F.lit(X.QUARANTINE).alias("decision"), "added_fields", "missing_fields", "changed_fields",
        "bronze_path", "event_time", "run_id", reason.alias("reason")), run_id, True)


def _promote(spark, rows_for, d, allowed, n_allowed, mode, names, run_id, stamp, silver_row, gold_row, result, errors,
             isolation, enforce_required) -> None:
    """Hold what cannot be promoted, write the rest to silver and, if asked for, gold."""
    clash = collisions(allowed)
    n_clash = clash.count()
    if n_clash:
        errors.append(HeaderCollisionError(clash, n_clash, d))
        _hold(spark, names.quarantine(d), allowed.join(clash, "batch_id", "left_semi"), F.lit(HOLD_REASONS[2]), run_id)
        allowed = allowed.join(clash, "batch_id", "left_anti")
        n_allowed -= n_clash
        if not n_allowed:
            return
    fields = tuple(C.FieldContract(f["name"], f["data_type"], f["required"]) for f in silver_row["approved_schema"])
    table = names.silver(d)
    TB.ensure_table(spark, table, fields, names.layer_buckets)
    wanted = {"columns": [f.name for f in fields]} if getattr(rows_for, "takes_columns", False) else {}
    rows = rows_for(d, allowed.select("batch_id", "bronze_path", "observed_schema"), **wanted)
    feed_holds = rows_for.holds(d) if hasattr(rows_for, "holds") else None
    if feed_holds is not None and not feed_holds.isEmpty():
        # the source could not read these batches as recorded: hold them
        held = feed_holds.select("batch_id", "reason").distinct()
        n_held = held.select("batch_id").distinct().count()
        _hold(spark, names.quarantine(d), allowed.join(held, "batch_id"), F.col("reason"), run_id)
        errors.append(HeaderMismatchError(held.select("batch_id"), n_held, d))
        allowed = allowed.join(held.select("batch_id"), "batch_id", "left_anti")
        n_allowed -= n_held
        if not n_allowed:
            return
    clustered = getattr(rows_for, "clustered_by_batch", False)
    written, n_written, err = _write_silver(spark, rows, allowed, n_allowed, fields, names, d, mode, isolation, enforce_required, not clustered, run_id)
    errors.extend(err)
    result.silver_batches[d] = result.silver_batches.get(d, 0) + n_written
    if not n_written:
        return
    moves = written.select("batch_id", F.lit(silver_row["contract_version"]).alias("contract_version"), F.lit(run_id).alias("run_id"),
                           F.lit(stamp).alias("stamp"), F.lit(None).cast("string").alias("source_stamp"), F.lit(mode).alias("mode"),
                           F.lit(d).alias("dataset"), F.lit("silver").alias("layer"))
    TB.record(spark, moves, names, TB.DONE)
    if gold_row is not None:
        released = release_gold(spark, d, written, names=names, on_replay=mode, n_batches=n_written, active=gold_row,
                                require_rows=False, run_id=run_id)
        result.gold_batches[d] = result.gold_batches.get(d, 0) + released


def _write_silver(spark, rows, allowed, n_allowed, fields, names, dataset, mode, isolation, enforce_required, rebalance, run_id):
    """Project, cast and write; returns (written batch ids, count, errors).

    ``staged``: the source is read once. Its projected rows go to a staging
    table together with the names of the columns that fail a check (a value
    that does not cast, or with ``enforce_required`` a NULL in a required
    field); failures are counted from that table, batches that have any are
    held, and the rows of the other batches move on to the layer.

    ``optimistic``: rows are written to the layer at once. A failing value
    aborts the write job, which then commits nothing, and only then are the
    rows staged: one write if all values pass, a second read if not.
    """
    keys = allowed.select("batch_id")
    table = names.silver(dataset)

    def write(frame, batches, rebalance):
        if mode == TB.REPLACE:
            TB.replace_batches(frame, table, rebalance=rebalance, batches=batches)
        else:
            TB.append_batches(frame, table, rebalance=rebalance)

    if isolation == "optimistic":
        try:
            write(P.project_to_contract(P.admitted(rows, keys), fields, enforce_required=enforce_required), keys, rebalance)
            return keys, n_allowed, []
        except Exception as exc:  # noqa: BLE001 - narrowed by the error class below
            if not _is_value_error(exc):
                raise
    staged = names.q(f"staged_{dataset}_{uuid.uuid4().hex[:12]}")
    checked = P.checked_projection(P.admitted(rows, keys), fields, enforce_required=enforce_required)
    checked.write.format("parquet").saveAsTable(staged)
    try:
        return _from_staging(spark, spark.table(staged), allowed, n_allowed, names, dataset, write, run_id)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


def _from_staging(spark, staged, allowed, n_allowed, names, dataset, write, run_id):
    keys = allowed.select("batch_id")
    failures = P.staged_failures(staged)
    per_kind = failures.groupBy("batch_id", "kind").agg(
        F.concat("kind", F.lit(":"), F.array_join(F.array_sort(F.collect_list("column_name")), ",")).alias("r"))
    per_batch = per_kind.groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list("r")), ";").alias("reason"))
    rows = staged.drop(P.FAILED)
    if failures.isEmpty():
        write(rows, keys, True)
        return keys, n_allowed, []
    # the failures outlive the staging table: they are what the errors tell
    kept = names.q(f"failed_values_{dataset}_{uuid.uuid4().hex[:12]}")
    failures.write.format("parquet").saveAsTable(kept)
    failures = spark.table(kept)
    _hold(spark, names.quarantine(dataset), allowed.join(per_batch, "batch_id"), F.col("reason"), run_id)
    held = failures.select("batch_id").distinct()
    n_held = held.count()
    good = keys.join(held, "batch_id", "left_anti")
    if n_allowed > n_held:
        write(rows.join(held, "batch_id", "left_anti"), good, True)
    found = []
    for kind, error in (("cast_failure", CastFailureError), ("required_null", RequiredNullError)):
        part = failures.where(F.col("kind") == kind)
        n_batches = part.select("batch_id").distinct().count()
        if n_batches:
            found.append(error(part, n_batches, dataset))
    return good, n_allowed - n_held, found


def release_gold(
    spark: SparkSession,
    dataset: str,
    batch_ids,
    *,
    names: TB.TableNames = TB.TableNames(),
    on_replay: str = "append",
    n_batches: int | None = None,
    active: dict | None = None,
    require_rows: bool = True,
    run_id: str | None = None,
) -> int:
    """Project promoted silver batches onto the active gold contract.

    ``batch_ids`` is a list or a DataFrame with ``batch_id``. Requested
    batches without silver rows stop the release before it writes. The
    silver scan is pruned to the requested batches' buckets.

    The ledger decides what is written, so a release may be called again at
    any time, also after one that failed half way: a batch whose last silver
    write is already released under this contract version is left alone; one
    that was written to silver anew, or whose release did not end, is
    replaced; the others are appended. Gold then holds what silver holds.
    Returns the number of requested batches, all of which are in gold then.
    """
    if active is None:
        _, rows = C.active_contracts_for(spark, spark.table(names.contracts), "gold", [dataset])
        active = rows[dataset]
    fields = tuple(C.FieldContract(f["name"], f["data_type"], f["required"]) for f in active["approved_schema"])
    if isinstance(batch_ids, DataFrame):
        requested = batch_ids.select("batch_id").distinct()
    else:
        requested = spark.createDataFrame(pa.table({"batch_id": pa.array(sorted(set(batch_ids)), pa.string())}))
    if n_batches is None:
        n_batches = requested.count()
    silver_table = names.silver(dataset)
    if not TB.table_exists(spark, silver_table):
        raise NoSilverRowsError(requested, n_batches, dataset)
    if require_rows:
        present = TB.rows_of_batches(spark, silver_table, requested).select("batch_id").distinct()
        blocked = requested.join(present, "batch_id", "left_anti")
        n_blocked = blocked.count()
        if n_blocked:
            raise NoSilverRowsError(blocked, n_blocked, dataset)
    table = names.gold(dataset)
    if TB.table_exists(spark, table):
        extra = TB.unreleased_columns(spark, table, fields)
        if extra:
            raise UnreleasedColumnError(f"Unreleased column in Gold: {extra}; nothing was written")
    TB.ensure_control_tables(spark, names)
    TB.ensure_table(spark, table, fields, names.layer_buckets)

    # what is to do is written down before any row is: the ledger's rows of
    # this stamp are read back from here on
    stamp = uuid.uuid4().hex
    version = active["contract_version"]
    todo = TB.releasable(spark, requested, names, dataset, version, on_replay).where(F.col("mode") != TB.SKIP)
    TB.record(spark, todo.select("batch_id", F.lit(version).alias("contract_version"), F.lit(run_id).alias("run_id"), F.lit(stamp).alias("stamp"),
                                 "source_stamp", "mode", F.lit(dataset).alias("dataset"), F.lit("gold").alias("layer")), names, TB.STARTED)
    started = TB.ledger_of(spark, names, dataset, "gold").where(F.col("stamp") == stamp)
    modes = {r["mode"] for r in started.select("mode").distinct().collect()}
    for mode, write in ((TB.APPEND, TB.append_batches), (TB.REPLACE, TB.replace_batches)):
        if mode not in modes:
            continue
        part = started.where((F.col("mode") == mode) & (F.col("state") == TB.STARTED))
        frame = P.project_to_contract(TB.rows_of_batches(spark, silver_table, part), fields, cast=False)
        if mode == TB.REPLACE:
            write(frame, table, batches=part)
        else:
            write(frame, table)
        TB.record(spark, part, names, TB.DONE)
    return n_batches


def run_gated_release(spark: SparkSession, observed: DataFrame, rows_for: RowSource, **kw) -> GateResult:
    """Gate with fail-on-quarantine, then release gold only if the gate
    succeeded (a held batch stops the gold step for the whole run).

    What is released are the batches that this run has written to silver, in
    this call or an earlier one; the ledger keeps a repeated call from
    releasing anything twice."""
    kw.pop("promote_gold", None)
    kw.pop("fail_on_quarantine", None)
    names = kw.get("names", TB.TableNames())
    result = gate_batches(spark, observed, rows_for, promote_gold=False, fail_on_quarantine=True, **kw)
    for d in sorted({d for d, _ in result.decisions}):
        wrote = TB.ledger_of(spark, names, d, "silver").where((F.col("run_id") == result.run_id) & (F.col("state") == TB.DONE))
        batches = wrote.select("batch_id").distinct()
        n = batches.count()
        if n:
            result.gold_batches[d] = release_gold(spark, d, batches, names=names, on_replay=kw.get("on_replay", "append"),
                                                  n_batches=n, require_rows=False, run_id=result.run_id)
    return result
