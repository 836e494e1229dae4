"""Relational results of the gate over the given tables.

Each function takes (spark, sf_dir) and returns a DataFrame. Most are lazy
relations made of the same stage functions as the gate run (observe -> diff
-> decide -> audit -> project). Those that report what a gate run wrote
(quarantine_rows, layer_counts, gold_release_blocked, gate_run,
resume_adds_new_batches, value_holds, csv_gate_run) run the gate when called. Lists are rendered as comma strings and counts as
bigint, so both sides compare as plain values.

Most results are over ``orders`` landed as one batch per order date (see
``orders_feed``): 2,399 batches at sf0.01, all gated in one job.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import exprs as X
from lakeward.operators import audit as A
from lakeward.operators import contracts as C
from lakeward.operators import diff as D
from lakeward.operators import project as P
from lakeward.operators import tables as TB
from lakeward.plans import feeds as FD
from lakeward.plans import gate as G
from lakeward.plans import orders_feed as OF
from lakeward.session import ensure_checkpoint_dir
from lakeward.sources import csv_batches as CB

RUN_ID = "orders-day-batches"
EVENT_TIME = datetime(2026, 10, 1, tzinfo=timezone.utc)


def _active(spark: SparkSession, contracts, layer: str) -> dict:
    """Active contract rows of ``layer`` (declared contracts, so no job runs)."""
    latest = {}
    for c in contracts:
        if c.layer == layer and (c.dataset not in latest or c.version > latest[c.dataset].version):
            latest[c.dataset] = c
    if OF.DATASET not in latest:
        raise C.NoContractError([(OF.DATASET, layer)])
    return {d: _row(c) for d, c in latest.items()}


def _row(c) -> dict:
    return {"dataset": c.dataset, "layer": c.layer, "contract_version": c.version,
            "approved_schema": [{"name": f.name, "data_type": f.data_type, "required": f.required}
                                for f in c.fields],
            "allowed_changes": list(c.allowed_changes)}


def _orders(spark, sf_dir):
    return OF.load_orders(spark, sf_dir)


def decisions(spark: SparkSession, sf_dir: str, contracts=None, layer: str = "silver",
              observed: DataFrame | None = None) -> DataFrame:
    contracts = contracts or [OF.silver_v1(), OF.gold_v1()]
    if observed is None:
        observed = OF.observed(_orders(spark, sf_dir))
    return D.gate_decisions(observed, _active(spark, contracts, layer))


def _texts(dec: DataFrame) -> list:
    return [
        X.comma_list(F.col("added_fields")).alias("added"),
        X.comma_list(F.col("missing_fields")).alias("missing"),
        X.changed_text(F.col("changed_fields")).alias("changed"),
    ]


def _decision_view(dec: DataFrame) -> DataFrame:
    return dec.select("batch_id", "decision", "contract_version", *_texts(dec))


def _allowed(dec: DataFrame) -> DataFrame:
    return dec.where(F.col("decision") == X.ALLOW).select("batch_id")


# ---------------------------------------------------------------- contracts

def _impact(spark, sf_dir, contracts: DataFrame) -> DataFrame:
    """Evaluate every given contract version against every batch in one job."""
    observed = OF.observed(_orders(spark, sf_dir))
    dec = D.gate_decisions(observed, contracts)
    return dec.groupBy("dataset", "layer", "contract_version").agg(
        F.count_if(F.col("decision") == X.ALLOW).cast("bigint").alias("allowed_batches"),
        F.count_if(F.col("decision") == X.QUARANTINE).cast("bigint").alias("quarantined_batches"),
    )


def _registry(spark):
    return C.contracts_frame(spark, [OF.silver_v1(), OF.silver_v2(), OF.gold_v1()])


def contract_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active contract per (dataset, layer) after the approval, with what it
    admits of the feed."""
    active = C.active_contracts(_registry(spark))
    view = active.select(
        "dataset", "layer", "contract_version",
        X.schema_text(F.col("approved_schema")).alias("fields"),
        F.array_join("required_fields", ",").alias("required"),
        F.array_join("allowed_changes", ",").alias("allowed_changes"),
        "owner",
    )
    return view.join(_impact(spark, sf_dir, active), ["dataset", "layer", "contract_version"])


def contract_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered version, the version list of its layer, whether it is
    active, and what it admits of the feed."""
    registry = _registry(spark)
    hist = C.contract_history(registry)
    active = C.active_contracts(registry).select("dataset", "layer", F.col("contract_version").alias("active"))
    return (
        registry.select("dataset", "layer", "contract_version")
        .join(hist, ["dataset", "layer"])
        .join(active, ["dataset", "layer"])
        .join(_impact(spark, sf_dir, registry), ["dataset", "layer", "contract_version"])
        .select("dataset", "layer", "contract_version",
                F.array_join(F.col("versions").cast("array<string>"), ",").alias("versions"),
                (F.col("contract_version") == F.col("active")).alias("is_active"),
                "allowed_batches", "quarantined_batches")
    )


# ------------------------------------------------------------ diff/decision

def observed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = OF.observed(_orders(spark, sf_dir))
    return D.observed_fields(obs).select("batch_id", "ordinal", "name", "data_type")


def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    dec = decisions(spark, sf_dir)
    return dec.select("batch_id", *_texts(dec), "reason")


def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision per day batch under silver v1."""
    return _decision_view(decisions(spark, sf_dir))


def gate_decision_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision per day batch once silver v2 is approved (the replay)."""
    return _decision_view(decisions(spark, sf_dir, [OF.silver_v1(), OF.silver_v2(), OF.gold_v1()]))


def rename_not_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches where a field is gone and another arrived: never a rename."""
    dec = decisions(spark, sf_dir).where((F.size("missing_fields") > 0) & (F.size("added_fields") > 0))
    return dec.select("batch_id", "decision", *_texts(dec)[:2])


def additive_approval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 fields + an ``additive:`` token: the added column is admitted by the
    decision and dropped by the projection."""
    contract = OF.silver_token_only()
    dec = decisions(spark, sf_dir, [OF.silver_v1(), contract])
    allowed = dec.where(F.col("decision") == X.ALLOW)
    projected = P.project_to_contract(P.admitted(OF.rows(_orders(spark, sf_dir)), allowed), contract.fields)
    counts = projected.groupBy("batch_id").agg(F.count("*").alias("n_rows"))
    return allowed.select("batch_id", "decision", X.comma_list(F.col("added_fields")).alias("added")) \
        .join(counts, "batch_id").withColumn("silver_columns", F.lit(",".join(projected.columns)))


# -------------------------------------------------------------------- audit

def _events(spark, sf_dir, observed=None) -> DataFrame:
    dec = decisions(spark, sf_dir, observed=observed)
    return A.audit_events(dec, run_id=RUN_ID, event_time=EVENT_TIME)


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(
        "event_id", "dataset", "layer", "batch_id", "run_id",
        X.schema_text(F.col("expected_schema")).alias("expected_schema"),
        X.schema_text(F.col("observed_schema")).alias("observed_schema"),
        X.comma_list(F.col("added_fields")).alias("added_fields"),
        X.comma_list(F.col("missing_fields")).alias("missing_fields"),
        X.changed_text(F.col("changed_fields")).alias("changed_fields"),
        "decision", "contract_version", "bronze_path",
    )


def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.audit_summary(_events(spark, sf_dir))


def audit_leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names and part names found anywhere in audit events.

    The orders events hold none. Three more batches are planted: one whose
    batch id is the name of the customer with the smallest key (a feed that
    names its files after a value), one whose id holds the many-word name of
    the part with the smallest key, and one that has the name of the customer
    with the largest key inside its path only. The scan must find exactly
    those events."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    fields = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.data_type).alias("data_type")) for f in OF.V1_FIELDS])

    def planted(name, before, after, only_path):
        text = F.concat(F.lit(before), name, F.lit(after))
        return name_of(text, F.lit("planted-path") if only_path else text)

    def name_of(text, batch_id):
        return [F.lit(OF.DATASET).alias("dataset"), batch_id.alias("batch_id"),
                F.concat(F.lit(f"incoming/{OF.DATASET}/"), text, F.lit(".csv")).alias("bronze_path"), fields.alias("observed_schema")]

    low = customer.agg(F.min_by("c_name", "c_custkey").alias("v")).select(*planted(F.col("v"), "", "", False))
    many = part.agg(F.min_by("p_name", "p_partkey").alias("v")).select(*planted(F.col("v"), "x-", "-y", False))
    high = customer.agg(F.max_by("c_name", "c_custkey").alias("v")).select(*planted(F.col("v"), "2024/of", "s", True))
    observed = OF.observed(_orders(spark, sf_dir)).unionByName(low).unionByName(many).unionByName(high)
    events = _events(spark, sf_dir, observed=observed)
    sensitive = customer.select(F.col("c_name").alias("value"), F.lit("customer.c_name").alias("source")).unionByName(
        part.select(F.col("p_name").alias("value"), F.lit("part.p_name").alias("source")))
    return A.leak_scan(events, sensitive)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate's v1 run wrote into the quarantine table."""
    held = spark.table(_gated(spark, sf_dir).quarantine(OF.DATASET)).where("run_id = 'v1'")
    return held.select(
        "batch_id", "decision",
        X.comma_list(F.col("added_fields")).alias("added_fields"),
        X.comma_list(F.col("missing_fields")).alias("missing_fields"),
        X.changed_text(F.col("changed_fields")).alias("changed_fields"),
        "bronze_path", "reason",
    )


# --------------------------------------------------------------- row path

def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows admitted under silver v1, projected and cast to the contract."""
    dec = decisions(spark, sf_dir)
    rows = OF.rows(_orders(spark, sf_dir))
    return P.project_to_contract(P.admitted(rows, _allowed(dec)), OF.silver_v1().fields)


def _per_batch(frame: DataFrame, *extra) -> DataFrame:
    return frame.groupBy("batch_id", *extra).agg(
        F.count("*").alias("n_rows"),
        F.sum("o_totalprice").cast("decimal(38,2)").alias("sum_totalprice"),
    )


def silver_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per admitted batch: rows and the decimal total written to silver."""
    return _per_batch(silver_rows(spark, sf_dir))


def _silver_after_replay(spark, sf_dir) -> DataFrame:
    """Silver after the v1 run and the replay of its held batches under v2.

    Both versions are judged on one distinct of the order dates, and the rows
    are scanned once: each row meets the version that admits its batch, v1
    first. v1 batches read the column added later as NULL (the table evolved
    by ALTER TABLE); replayed batches carry it.
    """
    orders = _orders(spark, sf_dir)
    v1, v2 = OF.silver_v1(), OF.silver_v2()
    judged = D.gate_decisions(OF.observed(orders), [_row(v1), _row(v2)])
    admitted = judged.where(F.col("decision") == X.ALLOW).groupBy("batch_id").agg(F.min("contract_version").alias("contract_version"))
    rows = OF.rows(orders).join(admitted, "batch_id")
    later = [f for f in v2.fields if f.name not in v1.names()]
    for f in later:
        rows = rows.withColumn(f.name, F.when(F.col("contract_version") >= v2.version, F.col(f.name)))
    typed = P.project_to_contract(rows.withColumn("_batch", F.struct("batch_id", "contract_version")), v2.fields, batch_column="_batch")
    return typed.select(*v2.names(), "_batch.batch_id", "_batch.contract_version")


def silver_replay_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver_after_replay(spark, sf_dir)
    return silver.groupBy("batch_id", "contract_version").agg(
        F.count("*").alias("n_rows"),
        F.count("o_orderpriority").alias("n_priority"),
        F.sum("o_totalprice").cast("decimal(38,2)").alias("sum_totalprice"),
    )


def gold_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every silver batch after the replay, released on gold v1 columns."""
    gold = P.project_to_contract(_silver_after_replay(spark, sf_dir), OF.gold_v1().fields, cast=False)
    return _per_batch(gold).withColumn("gold_columns", F.lit(",".join(gold.columns)))


def gold_release_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release of every day batch, after the gate's runs: the release is
    refused and names the batches without silver rows."""
    names = _gated(spark, sf_dir)
    requested = OF.observed(_orders(spark, sf_dir)).select("batch_id")
    try:
        G.release_gold(spark, OF.DATASET, requested, names=names)
    except G.NoSilverRowsError as refused:
        return refused.held.select("batch_id", F.lit("no silver rows").alias("reason"))
    return requested.where("false").withColumn("reason", F.lit("no silver rows"))


def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of every batch that the v1 contract types would reject."""
    return P.cast_failures(OF.rows(_orders(spark, sf_dir)), OF.silver_v1().fields)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the layer tables, counted by ``tables.layer_counts`` before the
    approval of v2 and after the replay."""
    return spark.table(_gated(spark, sf_dir).q("counted_layers")).select("layer", "stage", "rows")


def feed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given tables gated at once, each against its own contract; rows of
    admitted feeds are projected on their contracts, counted, and their
    non-null values counted over all contract columns (so every column is
    read and cast). A feed's rows join its decision; nothing is collected."""
    frames = FD.load(spark, sf_dir)
    observed = FD.observed_schemas(spark, frames)
    active = [_row(c) for c in FD.FEED_CONTRACTS]
    dec = D.gate_decisions(observed, active)
    counts = None
    for name in FD.TABLES:
        rows = FD.stamp(frames, name)
        if any(f.name not in rows.columns for f in FD.contract_fields(name)):
            continue  # its decision cannot be allow
        projected = P.project_to_contract(rows, [f for f in FD.contract_fields(name)])
        filled = sum((F.count(F.col(f"`{c}`")) for c in projected.columns if c != "batch_id"), F.lit(0))
        c = projected.agg(F.count("*").alias("rows"), filled.alias("filled")).select(F.lit(name).alias("dataset"), "rows", "filled")
        counts = c if counts is None else counts.unionByName(c)
    view = dec.select("dataset", "decision", *_texts(dec))
    allowed = F.col("decision") == X.ALLOW
    return view.join(counts, "dataset", "left").select(
        *view.columns, F.when(allowed, F.col("rows")).otherwise(0).cast("bigint").alias("rows_promoted"),
        F.when(allowed, F.col("filled")).otherwise(0).cast("bigint").alias("values_promoted"))


CHECK_DATABASE = "lakeward_check"

# Gate runs of this session: (application, folder) -> tables.
_RUNS: dict[tuple[str, str], TB.TableNames] = {}


def _check_database(spark: SparkSession) -> str:
    """A fresh database for one check run, located under the session's
    checkpoint folder (the scratch area the cluster names), so no stale
    table folder from an earlier process can collide with it."""
    name = f"{CHECK_DATABASE}_{uuid.uuid4().hex[:12]}"
    base = ensure_checkpoint_dir(spark).rstrip("/")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{base}/{name}.db'")
    return name


def _rows_of(orders: DataFrame):
    return lambda dataset, allowed: OF.rows(orders)


def _gated(spark: SparkSession, sf_dir: str) -> TB.TableNames:
    """The tables of a whole gate run, with its writes: v1 run with gold,
    approval of silver v2 (the table evolves by ALTER TABLE), replay of the
    held batches. Run once per session and folder; several queries read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _RUNS and TB.table_exists(spark, _RUNS[key].q("counted_layers")):
        return _RUNS[key]
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1(), OF.gold_v1()], names)
    orders = _orders(spark, sf_dir)
    observed = OF.observed(orders)

    G.gate_batches(spark, observed, _rows_of(orders), names=names, run_id="v1", promote_gold=True, event_time=EVENT_TIME)
    before = TB.layer_counts(spark, OF.DATASET, names).withColumn("stage", F.lit("before_approval")).collect()
    v2 = OF.silver_v2()
    TB.approve(spark, OF.DATASET, "silver", v2.fields, v2.allowed_changes, v2.owner, names, OF.APPROVED_V2)
    held = spark.table(names.audit).where("run_id = 'v1' AND decision = 'quarantine'").select("batch_id")
    G.gate_batches(spark, observed.join(held, "batch_id", "left_semi"), _rows_of(orders), names=names, run_id="v2",
                   promote_gold=True, event_time=EVENT_TIME)
    after = TB.layer_counts(spark, OF.DATASET, names).withColumn("stage", F.lit("after_approval"))
    spark.createDataFrame(before, after.schema).unionByName(after).write.saveAsTable(names.q("counted_layers"))
    _RUNS[key] = names
    return names


def gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch what the tables of the whole gate run hold (see ``_gated``)."""
    names = _gated(spark, sf_dir)
    audit = spark.table(names.audit)
    first = audit.where("run_id = 'v1'").select("batch_id", "decision")
    replay = audit.where("run_id = 'v2'").select("batch_id", F.col("decision").alias("replay_decision"))
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(
        F.count("*").alias("silver_rows"), F.count("o_orderpriority").alias("silver_priority"),
        F.sum("o_totalprice").cast("decimal(38,2)").alias("silver_sum"))
    gold = spark.table(names.gold(OF.DATASET)).groupBy("batch_id").agg(F.count("*").alias("gold_rows"))
    return (first.join(replay, "batch_id", "left").join(silver, "batch_id", "left").join(gold, "batch_id", "left")
            .fillna(0, ["silver_rows", "silver_priority", "gold_rows"]))


def resume_adds_new_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run_id called twice: with the odd days, then with all days. Per
    batch the recorded events, its decision and its silver rows."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1()], names)
    orders = _orders(spark, sf_dir)
    observed = OF.observed(orders)
    odd = observed.where(F.pmod(F.dayofmonth(F.to_date("batch_id")), F.lit(2)) == 1)
    for part in (odd, observed):
        G.gate_batches(spark, part, _rows_of(orders), names=names, run_id="daily", event_time=EVENT_TIME)
    events = spark.table(names.audit).groupBy("batch_id").agg(F.count("*").alias("events"), F.min("decision").alias("decision"))
    landed = spark.table(names.bronze).groupBy("batch_id").agg(F.count("*").alias("landed"))
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(F.count("*").alias("silver_rows"))
    return events.join(landed, "batch_id").join(silver, "batch_id", "left").fillna(0, ["silver_rows"])


def value_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over headers that all declare the v1 fields and types: the
    batches whose prices carry text, or lack a required field, pass the
    schema decision and are held for their values. Per batch the hold and
    the silver rows; the gate-then-release call raises for the held ones."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1()], names)
    orders = _orders(spark, sf_dir)
    v1 = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.data_type).alias("data_type")) for f in OF.V1_FIELDS])
    observed = OF.observed(orders).withColumn("observed_schema", v1)
    result = G.gate_batches(spark, observed, _rows_of(orders), names=names, run_id="values", event_time=EVENT_TIME,
                            enforce_required=True, raise_errors=False)
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(F.count("*").alias("silver_rows"))
    return result.outcomes(spark).select("batch_id", "decision", F.coalesce("hold", F.lit("")).alias("hold")) \
        .join(silver, "batch_id", "left").fillna(0, ["silver_rows"])


def csv_gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over files: the day batches are landed as CSV under the
    checkpoint folder, their headers observed (types from the declared map),
    decided and promoted. Class 3's prices carry text under a decimal
    declaration, so its batches are allowed by schema and held at promotion;
    class 4's files have the columns in another order."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1()], names)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex[:12]}"
    landed = OF.land_csv(_orders(spark, sf_dir), folder)
    types = {f.name: f.data_type for f in OF.V1_FIELDS + (OF.PRIORITY,)}
    observed = CB.observe_headers(spark, landed, OF.DATASET, types)
    result = G.gate_batches(spark, observed, CB.CsvFeed(spark, headers="recorded"), names=names, run_id="files", event_time=EVENT_TIME,
                            raise_errors=False)
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(
        F.count("*").alias("silver_rows"), F.sum("o_totalprice").cast("decimal(38,2)").alias("silver_sum"))
    header = spark.table(names.bronze).select("batch_id", F.array_join(F.transform("observed_schema", lambda x: x["name"]), ",").alias("header"))
    return result.outcomes(spark).select("batch_id", "decision", F.coalesce("hold", F.lit("")).alias("hold")) \
        .join(header, "batch_id").join(silver, "batch_id", "left").fillna(0, ["silver_rows"])


def gated_release_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate-then-release call, repeated: the batches of classes 0 and 4 of
    the odd days, the same again, then those of all days, under one run; at
    last class 1 under another run, which is held, so that call raises and
    releases nothing. Per batch what silver and gold hold at the end."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1(), OF.gold_v1()], names)
    orders = _orders(spark, sf_dir)
    observed = OF.observed(orders)
    k = OF.drift_class(F.to_date("batch_id"))
    clean = observed.where(k.isin(0, 4))
    odd = clean.where(F.pmod(F.dayofmonth(F.to_date("batch_id")), F.lit(2)) == 1)
    for part in (odd, odd, clean):
        G.run_gated_release(spark, part, _rows_of(orders), names=names, run_id="daily", event_time=EVENT_TIME)
    refused = None
    try:
        G.run_gated_release(spark, observed.where(k == 1), _rows_of(orders), names=names, run_id="late", event_time=EVENT_TIME)
    except G.QuarantinedError as held:
        refused = held.held.select("batch_id", F.lit(True).alias("refused"))
    events = spark.table(names.audit).select("batch_id", "decision").distinct()
    if refused is None:
        refused = events.limit(0).select("batch_id", F.lit(True).alias("refused"))

    def held_by(layer):
        return spark.table(names.layer(layer, OF.DATASET)).groupBy("batch_id").agg(
            F.count("*").alias(f"{layer}_rows"), F.sum("o_totalprice").cast("decimal(38,2)").alias(f"{layer}_sum"))
    return events.join(refused, "batch_id", "left").join(held_by("silver"), "batch_id", "left").join(held_by("gold"), "batch_id", "left") \
        .fillna(0, ["silver_rows", "gold_rows"]).fillna(False, ["refused"])


def header_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of classes 0 and 3 whose header names the price twice: class 0
    as a string and then as a decimal, class 3 the other way round. The last
    one decides; a batch that passes so is held at promotion, for its names
    collide."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1()], names)
    orders = _orders(spark, sf_dir)
    observed = OF.observed(orders)
    k = OF.drift_class(F.to_date("batch_id"))
    price = lambda kind: F.struct(F.lit("o_totalprice").alias("name"), F.lit(kind).alias("data_type"))
    others = F.filter("observed_schema", lambda x: x["name"] != "o_totalprice")
    twice = F.when(k == 0, F.concat(F.array(price("string")), others, F.array(price("decimal")))) \
        .otherwise(F.concat(F.array(price("decimal")), others, F.array(price("string"))))
    observed = observed.where(k.isin(0, 3)).withColumn("observed_schema", twice)
    result = G.gate_batches(spark, observed, _rows_of(orders), names=names, run_id="twice", event_time=EVENT_TIME, raise_errors=False)
    changed = spark.table(names.audit).select("batch_id", X.changed_text(F.col("changed_fields")).alias("changed"))
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(F.count("*").alias("silver_rows")) \
        if TB.table_exists(spark, names.silver(OF.DATASET)) else changed.limit(0).select("batch_id", F.lit(0).cast("long").alias("silver_rows"))
    return result.outcomes(spark).select("batch_id", "decision", F.coalesce("hold", F.lit("")).alias("hold")).join(changed, "batch_id") \
        .join(silver, "batch_id", "left").fillna(0, ["silver_rows"])


def sidecar_gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over files whose schemas are declared by JSON sidecars, as
    they land in a folder per batch. The sidecars tell each class's header
    and types, in contract order for class 4 (whose files have the columns
    the other way round); those of class 5 declare the v1 fields, which their
    files do not have, so these batches pass the decision and are held."""
    names = TB.TableNames(database=_check_database(spark))
    TB.register_contracts(spark, [OF.silver_v1()], names)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex[:12]}"
    orders = _orders(spark, sf_dir)
    landed = OF.land_csv(orders, f"{base}/files")
    v1 = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.data_type).alias("data_type")) for f in OF.V1_FIELDS])
    k = OF.drift_class(F.to_date("batch_id"))
    declared = OF.observed(orders).select("batch_id", F.to_json(F.when(k.isin(4, 5), v1).otherwise(F.col("observed_schema"))).alias("value"))
    declared.repartition("batch_id").write.partitionBy("batch_id").text(f"{base}/sidecars")
    sidecars = CB.observe_sidecars(spark, f"{base}/sidecars", OF.DATASET, suffix=".txt")
    observed = CB.pair_with_files(sidecars, CB.list_files(spark, landed))
    result = G.gate_batches(spark, observed, CB.CsvFeed(spark), names=names, run_id="sidecars", event_time=EVENT_TIME, raise_errors=False)
    silver = spark.table(names.silver(OF.DATASET)).groupBy("batch_id").agg(
        F.count("*").alias("silver_rows"), F.sum("o_totalprice").cast("decimal(38,2)").alias("silver_sum"))
    return result.outcomes(spark).select("batch_id", "decision", F.coalesce("hold", F.lit("")).alias("hold")) \
        .join(silver, "batch_id", "left").fillna(0, ["silver_rows"])


def control_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate's guards do, over the orders as one batch a year (all
    rows pass): events that would carry a payload column; a gold table with a
    column that its contract does not release, before and after the column
    is gone; a run that fails on held batches; the tables after a reset, and
    the same run again. Each with the rows that were concerned."""
    names = TB.TableNames(database=_check_database(spark))
    contracts = [OF.silver_v1(), OF.gold_v1()]
    orders = _orders(spark, sf_dir)
    v1 = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.data_type).alias("data_type")) for f in OF.V1_FIELDS])
    rows = orders.select(*(F.col(f.name).cast("string") if f.data_type != "date" else F.date_format(f.name, "yyyy-MM-dd").alias(f.name) for f in OF.V1_FIELDS),
                         F.date_format("o_orderdate", "yyyy").alias("batch_id"))
    observed = rows.select("batch_id").distinct().select(
        F.lit(OF.DATASET).alias("dataset"), "batch_id", F.concat(F.lit("incoming/"), "batch_id").alias("bronze_path"), v1.alias("observed_schema"))
    source = lambda dataset, allowed: rows
    n, told = rows.count(), []

    TB.register_contracts(spark, contracts, names)
    G.gate_batches(spark, observed, source, names=names, run_id="guards", event_time=EVENT_TIME)
    try:
        A.assert_metadata_only(spark.table(names.audit).withColumn("payload", F.lit("x")))
    except A.MetadataLeakError:
        told.append(("events_with_a_payload", "refused", n))
    gold = names.gold(OF.DATASET)
    TB.ensure_table(spark, gold, (*OF.V1_FIELDS, OF.PRIORITY))
    years = observed.select("batch_id")
    try:
        G.release_gold(spark, OF.DATASET, years, names=names)
    except G.UnreleasedColumnError:
        told.append(("gold_with_an_unreleased_column", "refused", spark.table(gold).count()))
    spark.sql(f"DROP TABLE {gold}")
    G.release_gold(spark, OF.DATASET, years, names=names)
    told.append(("gold_once_it_has_none", "released", spark.table(gold).count()))
    drifted = observed.withColumn("observed_schema", F.slice("observed_schema", 1, 4))
    try:
        G.gate_batches(spark, drifted, source, names=names, run_id="held", fail_on_quarantine=True, event_time=EVENT_TIME)
    except G.QuarantinedError as held:
        told.append(("run_with_held_batches", "raised", rows.join(held.held, "batch_id", "left_semi").count()))
    TB.reset_tables(spark, [OF.DATASET], names)
    left = spark.catalog.listTables(names.database)
    told.append(("tables_after_reset", "some" if left else "none", len(left)))
    TB.register_contracts(spark, contracts, names)
    G.gate_batches(spark, observed, source, names=names, run_id="guards", promote_gold=True, event_time=EVENT_TIME)
    told.append(("silver_after_reset_and_rerun", "released", spark.table(names.silver(OF.DATASET)).count()))
    return spark.createDataFrame(told, "guard string, outcome string, rows bigint")


REPORTS = {
    "contract_latest": contract_latest,
    "contract_history": contract_history,
    "observed_fields": observed_fields,
    "schema_diff": schema_diff,
    "gate_decision": gate_decision,
    "gate_decision_v2": gate_decision_v2,
    "rename_not_inferred": rename_not_inferred,
    "additive_approval": additive_approval,
    "audit_events": audit_events,
    "audit_summary": audit_summary,
    "audit_leak_scan": audit_leak_scan,
    "quarantine_rows": quarantine_rows,
    "silver_rows": silver_rows,
    "silver_promote": silver_promote,
    "silver_replay_v2": silver_replay_v2,
    "gold_release": gold_release,
    "gold_release_blocked": gold_release_blocked,
    "cast_failures": cast_failures,
    "layer_counts": layer_counts,
    "feed_gate": feed_gate,
    "gate_run": gate_run,
    "resume_adds_new_batches": resume_adds_new_batches,
    "value_holds": value_holds,
    "csv_gate_run": csv_gate_run,
    "gated_release_twice": gated_release_twice,
    "header_last_wins": header_last_wins,
    "sidecar_gate_run": sidecar_gate_run,
    "control_guards": control_guards,
}
