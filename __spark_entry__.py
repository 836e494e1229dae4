"""

Every query reads the given tables (mostly ``orders``, landed as one batch
per order date with a stated rule of header changes, see
``lakeward/plans/orders_feed.py``) and runs the gate's own stage functions
on all batches at once. Most are lazy relations; those that report what a
gate run wrote run the gate (in a fresh database under the session's
``spark.checkpoint.dir``). Each
oracle restates the same rule in SQL and computes the diff relationally (a
full outer join of expected and observed fields per batch), independently
of the Spark side's array functions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeward.plans import reports as R

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: gate every order-date batch of sf0.001 against silver v1 and
    return the promoted rows, cast to the contract types."""
    return R.silver_rows(spark, SF_SMOKE)


def _absent(error: ImportError, *modules: str) -> None:
    """Go on where one of the optional ``modules`` is not installed; an import
    that fails inside one that is must be seen."""
    if error.name not in modules:
        raise error


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the optional training-data operators; none where
    their subpackage is not installed."""
    try:
        from lakeward.llm.queries import ORACLE_SQL, QUERIES
    except ImportError as e:
        _absent(e, "lakeward.llm", "lakeward.llm.queries")
        return {}, {}
    return dict(QUERIES), dict(ORACLE_SQL)


def _pipeline() -> tuple[dict, dict]:
    """The corpus pipeline, where it is installed."""
    try:
        import corpus_pipeline
    except ImportError as e:
        _absent(e, "corpus_pipeline", "lakeward.llm")
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(R.REPORTS) | _llm()[0] | _pipeline()[0]


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Shared CTEs restate the feed and the contracts.
# ---------------------------------------------------------------------------

# The drift rule's file headers per class k, and the contracts.
_FEED = """
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
batches AS (
  SELECT strftime(day, '%Y-%m-%d') AS batch_id,
         CAST(((date_diff('day', DATE '1970-01-01', day) % 6) + 6) % 6 AS INTEGER) AS k
  FROM days),
header(k, ordinal, name, data_type) AS (VALUES
  (0, 1, 'o_orderkey', 'bigint'), (0, 2, 'o_custkey', 'bigint'), (0, 3, 'o_orderstatus', 'string'),
  (0, 4, 'o_totalprice', 'decimal'), (0, 5, 'o_orderdate', 'date'),
  (1, 1, 'o_orderkey', 'bigint'), (1, 2, 'o_custkey', 'bigint'), (1, 3, 'o_orderstatus', 'string'),
  (1, 4, 'o_totalprice', 'decimal'), (1, 5, 'o_orderdate', 'date'), (1, 6, 'o_orderpriority', 'string'),
  (2, 1, 'o_orderkey', 'bigint'), (2, 2, 'o_orderstatus', 'string'), (2, 3, 'o_totalprice', 'decimal'),
  (2, 4, 'o_orderdate', 'date'),
  (3, 1, 'o_orderkey', 'bigint'), (3, 2, 'o_custkey', 'bigint'), (3, 3, 'o_orderstatus', 'string'),
  (3, 4, 'o_totalprice', 'string'), (3, 5, 'o_orderdate', 'date'),
  (4, 1, 'o_orderdate', 'date'), (4, 2, 'o_totalprice', 'decimal'), (4, 3, 'o_orderstatus', 'string'),
  (4, 4, 'o_custkey', 'bigint'), (4, 5, 'o_orderkey', 'bigint'),
  (5, 1, 'o_orderkey', 'bigint'), (5, 2, 'o_orderstatus', 'string'), (5, 3, 'o_totalprice', 'decimal'),
  (5, 4, 'o_orderdate', 'date'), (5, 5, 'o_orderpriority', 'string')),
observed AS (
  SELECT b.batch_id, b.k, h.ordinal, h.name, h.data_type FROM batches b JOIN header h ON h.k = b.k),
contract(cname, layer, version, ordinal, name, data_type, required) AS (VALUES
  ('v1', 'silver', 1, 1, 'o_orderkey', 'bigint', true), ('v1', 'silver', 1, 2, 'o_custkey', 'bigint', true),
  ('v1', 'silver', 1, 3, 'o_orderstatus', 'string', true), ('v1', 'silver', 1, 4, 'o_totalprice', 'decimal', true),
  ('v1', 'silver', 1, 5, 'o_orderdate', 'date', true),
  ('v2', 'silver', 2, 1, 'o_orderkey', 'bigint', true), ('v2', 'silver', 2, 2, 'o_custkey', 'bigint', true),
  ('v2', 'silver', 2, 3, 'o_orderstatus', 'string', true), ('v2', 'silver', 2, 4, 'o_totalprice', 'decimal', true),
  ('v2', 'silver', 2, 5, 'o_orderdate', 'date', true), ('v2', 'silver', 2, 6, 'o_orderpriority', 'string', false),
  ('token', 'silver', 2, 1, 'o_orderkey', 'bigint', true), ('token', 'silver', 2, 2, 'o_custkey', 'bigint', true),
  ('token', 'silver', 2, 3, 'o_orderstatus', 'string', true), ('token', 'silver', 2, 4, 'o_totalprice', 'decimal', true),
  ('token', 'silver', 2, 5, 'o_orderdate', 'date', true),
  ('gold', 'gold', 1, 1, 'o_orderkey', 'bigint', true), ('gold', 'gold', 1, 2, 'o_custkey', 'bigint', true),
  ('gold', 'gold', 1, 3, 'o_orderstatus', 'string', true), ('gold', 'gold', 1, 4, 'o_totalprice', 'decimal', true),
  ('gold', 'gold', 1, 5, 'o_orderdate', 'date', true)),
tokens(cname, token) AS (VALUES ('v2', 'additive:o_orderpriority'), ('token', 'additive:o_orderpriority')),
owners(cname, owner) AS (VALUES ('v1', 'orders-data-steward'), ('v2', 'orders-data-steward'),
  ('token', 'orders-data-steward'), ('gold', 'orders-analytics')),
obs_text AS (
  SELECT batch_id, string_agg(name || ':' || data_type, ',' ORDER BY ordinal) AS observed_schema
  FROM observed GROUP BY batch_id),
feed_rows AS (
  SELECT b.batch_id, b.k,
    CAST(o.o_orderkey AS VARCHAR) AS o_orderkey,
    CASE WHEN b.k IN (2, 5) THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS o_custkey,
    o.o_orderstatus,
    CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || CASE WHEN b.k = 3 THEN ' USD' ELSE '' END AS o_totalprice,
    b.batch_id AS o_orderdate,
    CASE WHEN b.k IN (1, 5) THEN o.o_orderpriority END AS o_orderpriority
  FROM orders o JOIN batches b ON b.batch_id = strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d'))
"""


def _diff(cname: str, alias: str) -> str:
    """CTEs ``{alias}_cmp`` and ``{alias}``: per batch added / missing / changed
    and the decision, by a full outer join of expected and observed fields."""
    return f"""
{alias}_exp AS (SELECT name, data_type, version FROM contract WHERE cname = '{cname}'),
{alias}_cmp AS (
  SELECT COALESCE(g.batch_id, o.batch_id) AS batch_id, g.name AS ename, g.data_type AS etype,
         o.name AS oname, o.data_type AS otype
  FROM (SELECT b.batch_id, e.name, e.data_type FROM batches b CROSS JOIN {alias}_exp e) g
  FULL OUTER JOIN observed o ON g.batch_id = o.batch_id AND g.name = o.name),
{alias}_agg AS (
  SELECT batch_id,
    COALESCE(string_agg(oname, ',' ORDER BY oname) FILTER (WHERE ename IS NULL), '') AS added,
    COALESCE(string_agg(ename, ',' ORDER BY ename) FILTER (WHERE oname IS NULL), '') AS missing,
    COALESCE(string_agg(ename || ':' || etype || '->' || otype, ',' ORDER BY ename)
             FILTER (WHERE ename IS NOT NULL AND oname IS NOT NULL AND etype IS DISTINCT FROM otype), '') AS changed,
    count(*) FILTER (WHERE ename IS NULL AND 'additive:' || oname NOT IN
                     (SELECT token FROM tokens WHERE cname = '{cname}')) AS unapproved
  FROM {alias}_cmp GROUP BY batch_id),
{alias} AS (
  SELECT batch_id, added, missing, changed,
    CASE WHEN added = '' AND missing = '' AND changed = '' THEN 'allow'
         WHEN missing <> '' OR changed <> '' THEN 'quarantine'
         WHEN unapproved = 0 THEN 'allow' ELSE 'quarantine' END AS decision,
    COALESCE(NULLIF(concat_ws('+', CASE WHEN added <> '' THEN 'added' END,
                                   CASE WHEN missing <> '' THEN 'missing' END,
                                   CASE WHEN changed <> '' THEN 'changed' END), ''), 'none') AS reason,
    (SELECT max(version) FROM {alias}_exp) AS contract_version
  FROM {alias}_agg)
"""


def _impact(*pairs: tuple[str, str]) -> str:
    """CTE ``impact``: allowed / quarantined batches per contract."""
    parts = [
        f"SELECT '{cname}' AS cname, count(*) FILTER (WHERE decision = 'allow') AS allowed_batches, "
        f"count(*) FILTER (WHERE decision = 'quarantine') AS quarantined_batches FROM {alias}"
        for cname, alias in pairs
    ]
    return "impact AS (" + " UNION ALL ".join(parts) + ")"


def _typed(source: str, priority: bool) -> str:
    pr = "o_orderpriority" if priority else "CAST(NULL AS VARCHAR) AS o_orderpriority"
    return f"""SELECT CAST(r.o_orderkey AS BIGINT) AS o_orderkey, CAST(r.o_custkey AS BIGINT) AS o_custkey,
    r.o_orderstatus, CAST(r.o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
    CAST(r.o_orderdate AS DATE) AS o_orderdate, {pr}, r.batch_id
  FROM feed_rows r JOIN {source}"""


# silver after the v1 run (s1) and the replay of its held batches under v2 (s2)
_SILVER = f"""
s1 AS ({_typed("d1 USING (batch_id) WHERE d1.decision = 'allow'", False)}),
s2 AS ({_typed("d2 USING (batch_id) WHERE d2.decision = 'allow' AND batch_id IN "
               "(SELECT batch_id FROM d1 WHERE decision = 'quarantine')", True)}),
silver AS (SELECT *, 1 AS contract_version FROM s1 UNION ALL SELECT *, 2 AS contract_version FROM s2)
"""

_COLS = "(SELECT string_agg(name, ',' ORDER BY ordinal) FROM contract WHERE cname = '{c}') || ',batch_id'"

# The per-table feed contracts (same as lakeward/plans/feeds.py).
_FEED_TABLES = ("region nation customer supplier part orders lineitem events documents "
                "embeddings pages benchmark labels conversations").split()
_FEED_CONTRACTS = """
fc(dataset, name, data_type) AS (VALUES
  ('region', 'r_regionkey', 'int'), ('region', 'r_name', 'string'),
  ('nation', 'n_nationkey', 'int'), ('nation', 'n_name', 'string'), ('nation', 'n_regionkey', 'int'),
  ('customer', 'c_custkey', 'bigint'), ('customer', 'c_name', 'string'), ('customer', 'c_nationkey', 'int'),
  ('customer', 'c_acctbal', 'double'), ('customer', 'c_mktsegment', 'string'), ('customer', 'c_phone', 'string'),
  ('supplier', 's_suppkey', 'bigint'), ('supplier', 's_name', 'string'), ('supplier', 's_nationkey', 'int'),
  ('supplier', 's_acctbal', 'double'),
  ('part', 'p_partkey', 'bigint'), ('part', 'p_name', 'string'), ('part', 'p_brand', 'string'),
  ('part', 'p_type', 'string'), ('part', 'p_size', 'bigint'), ('part', 'p_retailprice', 'double'),
  ('orders', 'o_orderkey', 'bigint'), ('orders', 'o_custkey', 'bigint'), ('orders', 'o_orderstatus', 'string'),
  ('orders', 'o_totalprice', 'double'), ('orders', 'o_orderdate', 'timestamp'),
  ('lineitem', 'l_orderkey', 'bigint'), ('lineitem', 'l_partkey', 'bigint'), ('lineitem', 'l_suppkey', 'bigint'),
  ('lineitem', 'l_linenumber', 'int'), ('lineitem', 'l_quantity', 'double'), ('lineitem', 'l_extendedprice', 'double'),
  ('lineitem', 'l_discount', 'double'), ('lineitem', 'l_returnflag', 'string'), ('lineitem', 'l_linestatus', 'string'),
  ('lineitem', 'l_shipdate', 'timestamp'),
  ('events', 'event_id', 'bigint'), ('events', 'ts', 'timestamp'), ('events', 'user_id', 'bigint'),
  ('events', 'event_type', 'string'), ('events', 'value', 'double'), ('events', 'props', 'string'),
  ('documents', 'doc_id', 'bigint'), ('documents', 'text', 'string'), ('documents', 'lang', 'string'),
  ('documents', 'source', 'string'), ('documents', 'n_chars', 'bigint'),
  ('embeddings', 'vec_id', 'bigint'), ('embeddings', 'embedding', 'array<float>'), ('embeddings', 'label', 'int'),
  ('pages', 'page_id', 'bigint'), ('pages', 'url', 'string'), ('pages', 'html', 'string'),
  ('benchmark', 'item_id', 'bigint'), ('benchmark', 'text', 'string'),
  ('labels', 'doc_id', 'bigint'), ('labels', 'quality', 'boolean'), ('labels', 'toxic', 'int'),
  ('conversations', 'conv_id', 'bigint'), ('conversations', 'turn', 'bigint'), ('conversations', 'speaker', 'string'),
  ('conversations', 'text', 'string')),
ftok(dataset, token) AS (VALUES ('lineitem', 'additive:l_tax'))
"""


# Contract columns that their tables do not have.
_ABSENT = ("c_phone", "speaker")


def _feed_gate_sql() -> str:
    described = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, column_name AS name, column_type FROM (DESCRIBE {t})" for t in _FEED_TABLES)
    counted = " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS n FROM {t}" for t in _FEED_TABLES)
    columns = dict.fromkeys(_FEED_TABLES, "")
    for dataset, name in re.findall(r"\('(\w+)', '(\w+)', '[^']+'\)", _FEED_CONTRACTS):
        # a contract column that the table lacks holds its feed back: it counts nothing
        columns[dataset] += f' + (SELECT count("{name}") FROM {dataset})' if name not in _ABSENT else ""
    filled = " UNION ALL ".join(f"SELECT '{t}' AS dataset, 0{c} AS n" for t, c in columns.items())
    return f"""WITH {_FEED_CONTRACTS},
filled AS ({filled}),
raw_obs AS ({described}),
fo AS (SELECT dataset, name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
         WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp'
         WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean'
         WHEN 'FLOAT' THEN 'float' ELSE lower(column_type) END AS data_type FROM raw_obs),
cmp AS (SELECT COALESCE(c.dataset, o.dataset) AS dataset, c.name AS ename, c.data_type AS etype,
               o.name AS oname, o.data_type AS otype
        FROM fc c FULL OUTER JOIN fo o ON c.dataset = o.dataset AND c.name = o.name),
agg AS (
  SELECT dataset,
    COALESCE(string_agg(oname, ',' ORDER BY oname) FILTER (WHERE ename IS NULL), '') AS added,
    COALESCE(string_agg(ename, ',' ORDER BY ename) FILTER (WHERE oname IS NULL), '') AS missing,
    COALESCE(string_agg(ename || ':' || etype || '->' || otype, ',' ORDER BY ename)
             FILTER (WHERE ename IS NOT NULL AND oname IS NOT NULL AND etype IS DISTINCT FROM otype), '') AS changed,
    count(*) FILTER (WHERE ename IS NULL AND NOT EXISTS
      (SELECT 1 FROM ftok t WHERE t.dataset = cmp.dataset AND t.token = 'additive:' || cmp.oname)) AS unapproved
  FROM cmp GROUP BY dataset),
dec AS (
  SELECT dataset, added, missing, changed,
    CASE WHEN added = '' AND missing = '' AND changed = '' THEN 'allow'
         WHEN missing <> '' OR changed <> '' THEN 'quarantine'
         WHEN unapproved = 0 THEN 'allow' ELSE 'quarantine' END AS decision
  FROM agg),
counts AS ({counted})
SELECT d.dataset, d.decision, d.added, d.missing, d.changed,
  CASE WHEN d.decision = 'allow' THEN c.n ELSE 0 END AS rows_promoted,
  CASE WHEN d.decision = 'allow' THEN f.n ELSE 0 END AS values_promoted
FROM dec d JOIN counts c USING (dataset) JOIN filled f USING (dataset)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def oracle_sql() -> dict[str, str]:
    return _gate_sql() | _llm()[1] | _pipeline()[1]


def _gate_sql() -> dict[str, str]:
    d1, d2, dt, dg = _diff("v1", "d1"), _diff("v2", "d2"), _diff("token", "dt"), _diff("gold", "dg")
    registered = """
reg AS (SELECT DISTINCT cname, layer, version FROM contract WHERE cname IN ('v1', 'v2', 'gold')),
act AS (SELECT * FROM reg QUALIFY version = max(version) OVER (PARTITION BY layer))"""
    return {
        "contract_latest": _with(_FEED, d2, dg, registered, _impact(("v2", "d2"), ("gold", "dg"))) + """
SELECT 'orders' AS dataset, a.layer, a.version AS contract_version,
  (SELECT string_agg(name || ':' || data_type, ',' ORDER BY ordinal) FROM contract c WHERE c.cname = a.cname) AS fields,
  (SELECT COALESCE(string_agg(name, ',' ORDER BY ordinal) FILTER (WHERE required), '')
     FROM contract c WHERE c.cname = a.cname) AS required,
  COALESCE((SELECT string_agg(token, ',') FROM tokens t WHERE t.cname = a.cname), '') AS allowed_changes,
  o.owner, i.allowed_batches, i.quarantined_batches
FROM act a JOIN owners o USING (cname) JOIN impact i USING (cname)""",
        "contract_history": _with(_FEED, d1, d2, dg, registered,
                                  _impact(("v1", "d1"), ("v2", "d2"), ("gold", "dg"))) + """
SELECT 'orders' AS dataset, r.layer, r.version AS contract_version,
  (SELECT string_agg(CAST(version AS VARCHAR), ',' ORDER BY version) FROM reg r2 WHERE r2.layer = r.layer) AS versions,
  r.version = (SELECT max(version) FROM reg r3 WHERE r3.layer = r.layer) AS is_active,
  i.allowed_batches, i.quarantined_batches
FROM reg r JOIN impact i USING (cname)""",
        "observed_fields": _with(_FEED) + """
SELECT batch_id, ordinal, name, data_type FROM observed""",
        "schema_diff": _with(_FEED, d1) + """
SELECT batch_id, added, missing, changed, reason FROM d1""",
        "gate_decision": _with(_FEED, d1) + """
SELECT batch_id, decision, contract_version, added, missing, changed FROM d1""",
        "gate_decision_v2": _with(_FEED, d2) + """
SELECT batch_id, decision, contract_version, added, missing, changed FROM d2""",
        "rename_not_inferred": _with(_FEED, d1) + """
SELECT batch_id, decision, added, missing FROM d1 WHERE added <> '' AND missing <> ''""",
        "additive_approval": _with(_FEED, dt) + f"""
SELECT d.batch_id, d.decision, d.added, count(*) AS n_rows, {_COLS.format(c='token')} AS silver_columns
FROM dt d JOIN feed_rows r USING (batch_id) WHERE d.decision = 'allow' GROUP BY d.batch_id, d.decision, d.added""",
        "audit_events": _with(_FEED, d1) + """
SELECT sha256(concat_ws(':', 'orders', 'silver', d.batch_id, 'orders-day-batches', CAST(d.contract_version AS VARCHAR)))
    AS event_id,
  'orders' AS dataset, 'silver' AS layer, d.batch_id, 'orders-day-batches' AS run_id,
  (SELECT string_agg(name || ':' || data_type, ',' ORDER BY ordinal) FROM contract WHERE cname = 'v1') AS expected_schema,
  o.observed_schema, d.added AS added_fields, d.missing AS missing_fields, d.changed AS changed_fields,
  d.decision, d.contract_version, 'incoming/orders/' || d.batch_id || '.csv' AS bronze_path
FROM d1 d JOIN obs_text o USING (batch_id)""",
        "audit_summary": _with(_FEED, d1) + """
SELECT decision, reason, count(*) AS batches FROM d1 GROUP BY decision, reason""",
        "audit_leak_scan": _with(_FEED, d1) + """
,low AS (SELECT arg_min(c_name, c_custkey) AS v FROM customer),
high AS (SELECT arg_max(c_name, c_custkey) AS v FROM customer),
many AS (SELECT arg_min(p_name, p_partkey) AS v FROM part),
planted(batch_id, path) AS (
  SELECT v, v FROM low UNION ALL SELECT 'x-' || v || '-y', 'x-' || v || '-y' FROM many
  UNION ALL SELECT 'planted-path', '2024/of' || v || 's' FROM high),
ev AS (
  SELECT d.batch_id, concat_ws(' ', d.batch_id, d.added, d.missing, d.changed, o.observed_schema,
           'incoming/orders/' || d.batch_id || '.csv') AS txt
  FROM d1 d JOIN obs_text o USING (batch_id)
  UNION ALL SELECT batch_id, concat_ws(' ', batch_id, 'incoming/orders/' || path || '.csv') FROM planted),
vals AS (SELECT DISTINCT c_name AS value, 'customer.c_name' AS source FROM customer
         UNION SELECT DISTINCT p_name, 'part.p_name' FROM part)
SELECT sha256(concat_ws(':', 'orders', 'silver', e.batch_id, 'orders-day-batches', '1')) AS event_id,
  e.batch_id, v.value, v.source
FROM ev e JOIN vals v ON contains(e.txt, v.value)""",
        "quarantine_rows": _with(_FEED, d1) + """
SELECT batch_id, decision, added AS added_fields, missing AS missing_fields, changed AS changed_fields,
  'incoming/orders/' || batch_id || '.csv' AS bronze_path, reason
FROM d1 WHERE decision = 'quarantine'""",
        "silver_rows": _with(_FEED, d1) + f"""
,s1 AS ({_typed("d1 USING (batch_id) WHERE d1.decision = 'allow'", False)})
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, batch_id FROM s1""",
        "silver_promote": _with(_FEED, d1) + f"""
,s1 AS ({_typed("d1 USING (batch_id) WHERE d1.decision = 'allow'", False)})
SELECT batch_id, count(*) AS n_rows, CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS sum_totalprice
FROM s1 GROUP BY batch_id""",
        "silver_replay_v2": _with(_FEED, d1, d2, _SILVER) + """
SELECT batch_id, contract_version, count(*) AS n_rows, count(o_orderpriority) AS n_priority,
  CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS sum_totalprice
FROM silver GROUP BY batch_id, contract_version""",
        "gold_release": _with(_FEED, d1, d2, _SILVER) + f"""
SELECT batch_id, count(*) AS n_rows, CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS sum_totalprice,
  {_COLS.format(c='gold')} AS gold_columns
FROM silver GROUP BY batch_id""",
        "gold_release_blocked": _with(_FEED, d1, d2, _SILVER) + """
SELECT batch_id, 'no silver rows' AS reason FROM batches WHERE batch_id NOT IN (SELECT batch_id FROM silver)""",
        "cast_failures": _with(_FEED) + """
,checks AS (
  SELECT batch_id, 'o_orderkey' AS column_name,
    count(*) FILTER (WHERE o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) AS failures
  FROM feed_rows GROUP BY batch_id
  UNION ALL SELECT batch_id, 'o_custkey',
    count(*) FILTER (WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS BIGINT) IS NULL) FROM feed_rows GROUP BY batch_id
  UNION ALL SELECT batch_id, 'o_totalprice',
    count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NULL)
    FROM feed_rows GROUP BY batch_id
  UNION ALL SELECT batch_id, 'o_orderdate',
    count(*) FILTER (WHERE o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) IS NULL) FROM feed_rows GROUP BY batch_id)
SELECT batch_id, column_name, failures FROM checks WHERE failures > 0""",
        "resume_adds_new_batches": _with(_FEED, d1) + """
SELECT d1.batch_id, 1 AS events, d1.decision, 1 AS landed,
  CASE WHEN d1.decision = 'allow' THEN (SELECT count(*) FROM feed_rows r WHERE r.batch_id = d1.batch_id) ELSE 0 END AS silver_rows
FROM d1""",
        "value_holds": _with(_FEED) + """
,holds AS (SELECT batch_id, any_value(k) AS k, count(*) AS n FROM feed_rows GROUP BY batch_id)
SELECT batch_id, 'allow' AS decision,
  CASE WHEN k = 3 THEN 'cast_failure:o_totalprice' WHEN k IN (2, 5) THEN 'required_null:o_custkey' ELSE '' END AS hold,
  CASE WHEN k IN (2, 3, 5) THEN 0 ELSE n END AS silver_rows
FROM holds""",
        "csv_gate_run": _with(_FEED) + """
,names AS (SELECT batch_id, string_agg(name, ',' ORDER BY ordinal) AS header FROM observed GROUP BY batch_id),
sums AS (SELECT batch_id, any_value(k) AS k, count(*) AS n,
  sum(CASE WHEN k IN (0, 4) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS total FROM feed_rows GROUP BY batch_id)
SELECT batch_id, CASE WHEN k IN (0, 3, 4) THEN 'allow' ELSE 'quarantine' END AS decision,
  CASE WHEN k = 3 THEN 'cast_failure:o_totalprice' ELSE '' END AS hold, header,
  CASE WHEN k IN (0, 4) THEN n ELSE 0 END AS silver_rows, CAST(total AS DECIMAL(38,2)) AS silver_sum
FROM sums JOIN names USING (batch_id)""",
        "gated_release_twice": _with(_FEED) + """
,rows_of AS (SELECT batch_id, any_value(k) AS k, count(*) AS n,
  CAST(sum(CASE WHEN k IN (0, 4) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS total FROM feed_rows GROUP BY batch_id)
SELECT batch_id, CASE WHEN k = 1 THEN 'quarantine' ELSE 'allow' END AS decision, k = 1 AS refused,
  CASE WHEN k = 1 THEN 0 ELSE n END AS silver_rows, CASE WHEN k = 1 THEN 0 ELSE n END AS gold_rows, total AS silver_sum, total AS gold_sum
FROM rows_of WHERE k IN (0, 1, 4)""",
        "header_last_wins": _with(_FEED) + """
SELECT batch_id,
  CASE WHEN k = 0 THEN 'allow' ELSE 'quarantine' END AS decision,
  CASE WHEN k = 3 THEN 'o_totalprice:decimal->string' ELSE '' END AS changed,
  CASE WHEN k = 0 THEN 'header_collision' ELSE '' END AS hold,
  CASE WHEN k = 0 THEN 0 ELSE 0 END AS silver_rows
FROM batches WHERE k IN (0, 3)""",
        "sidecar_gate_run": _with(_FEED) + """
,sums AS (SELECT batch_id, any_value(k) AS k, count(*) AS n,
  CAST(sum(CASE WHEN k IN (0, 4) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS total FROM feed_rows GROUP BY batch_id)
SELECT batch_id, CASE WHEN k IN (0, 4, 5) THEN 'allow' ELSE 'quarantine' END AS decision,
  CASE WHEN k = 5 THEN 'header_mismatch' ELSE '' END AS hold,
  CASE WHEN k IN (0, 4) THEN n ELSE 0 END AS silver_rows, total AS silver_sum
FROM sums""",
        "control_guards": """
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'events_with_a_payload' AS guard, 'refused' AS outcome, n AS "rows" FROM n
UNION ALL SELECT 'gold_with_an_unreleased_column', 'refused', 0 FROM n
UNION ALL SELECT 'gold_once_it_has_none', 'released', n FROM n
UNION ALL SELECT 'run_with_held_batches', 'raised', n FROM n
UNION ALL SELECT 'tables_after_reset', 'none', 0 FROM n
UNION ALL SELECT 'silver_after_reset_and_rerun', 'released', n FROM n""",
        "layer_counts": _with(_FEED, d1, d2, _SILVER) + """
SELECT 'silver' AS layer, 'before_approval' AS stage, count(*) AS "rows" FROM s1
UNION ALL SELECT 'gold', 'before_approval', count(*) FROM s1
UNION ALL SELECT 'silver', 'after_approval', count(*) FROM silver
UNION ALL SELECT 'gold', 'after_approval', count(*) FROM silver""",
        "feed_gate": _feed_gate_sql(),
        "gate_run": _with(_FEED, d1, d2, _SILVER) + """
,per_batch AS (SELECT batch_id, count(*) AS n, count(o_orderpriority) AS np,
                      CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS sm FROM silver GROUP BY batch_id)
SELECT d1.batch_id, d1.decision,
  CASE WHEN d1.decision = 'quarantine' THEN d2.decision END AS replay_decision,
  COALESCE(p.n, 0) AS silver_rows, COALESCE(p.np, 0) AS silver_priority, p.sm AS silver_sum,
  COALESCE(p.n, 0) AS gold_rows
FROM d1 JOIN d2 USING (batch_id) LEFT JOIN per_batch p USING (batch_id)""",
    }
