"""Nearest neighbours by a block matrix join with int8 tiles.

Method. Unit vectors are coded in int8 with a scale and the exact norm of
their rounding error, and packed into tiles of rows. Query tiles meet the
candidate tiles of a stripe in a Spark join on the stripe number; stripes
hold a bounded number of tiles. A tile pair's integer product gives every
cosine within e_u + (1 + e_u) e_w. Pairs whose upper bound reaches the k-th
best lower bound (or the k-th best found so far) are recomputed from the
original vectors in double precision and kept in a heap per query; the
heaps of the stripes are merged at the end. The bounds are strict, so the
result is exact (recall 1).

Each query is compared with all rows, in blocks: that is the search asked
for. A task holds one query tile and streams candidate tiles.

Edge cases. A vector that is null, empty, zero, or holds a null or a
non-finite component takes no part. Vectors of different lengths are not
compared. A row that repeats is a candidate of its copy; a null vec_id is
no query and sorts last among ties. Fewer candidates than k give all of
them. Empty input gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm.common import cut, table, take

K = 5
QUERY_STEP = 50
TILE_ROWS = 2048
QUERY_ROWS = 1024
STRIPE_TILES = 16
PAIRS = 1 << 15
NO_ID = np.iinfo(np.int64).max

TILE = "tile long, dim int, uids binary, ids binary, codes binary, scales binary, errors binary, vectors binary"
NAMES = [c.split()[0] for c in TILE.split(", ")]


def in_order(products: np.ndarray) -> np.ndarray:
    """Row sums, added from left to right."""
    return np.add.accumulate(products, axis=1)[:, -1]


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error norms of the unit vectors of ``v``."""
    v = v.astype(np.float64)
    big = np.abs(v).max(axis=1, keepdims=True)
    u = v / big
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    scale = np.abs(u).max(axis=1, keepdims=True) / 127
    codes = np.rint(u / scale)
    # a little more than the computed norm covers its own rounding
    error = np.sqrt(((u - codes * scale) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return codes.astype(np.int8), scale[:, 0], error


def usable(v: np.ndarray) -> np.ndarray:
    """Rows that take part: finite, and of a norm that is neither 0 nor infinite."""
    v = v.astype(np.float64)
    with np.errstate(all="ignore"):
        norm = in_order(v * v) if v.shape[1] else np.zeros(len(v))
    return np.isfinite(v).all(axis=1) & np.isfinite(norm) & (norm > 0)


class _Tiler:
    """Collects rows per vector length and gives tiles of ``rows`` rows."""

    def __init__(self, rows: int, kind: int):
        self.rows, self.held = rows, {}
        self.next = (TaskContext.get().partitionId() << 32) | (kind << 31)

    def add(self, dim, *columns):
        held = self.held.setdefault(dim, [])
        held.append(columns)
        if sum(len(c[0]) for c in held) >= self.rows:
            yield from self.flush(dim, False)

    def flush(self, dim, last: bool):
        joined = [np.concatenate(c) for c in zip(*self.held.get(dim, []))]
        n = len(joined[0]) if joined else 0
        lo = 0
        while n - lo >= self.rows or (last and lo < n):
            uid, vid, v = (c[lo:lo + self.rows] for c in joined)
            codes, scales, errors = quantise(v)
            blobs = [uid, vid, codes, scales, errors, np.ascontiguousarray(v)]
            self.next += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.next], pa.int64()), pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], NAMES)
            lo += self.rows
        self.held[dim] = [tuple(c[lo:] for c in joined)] if n > lo else []

    def finish(self):
        for dim in list(self.held):
            yield from self.flush(dim, True)


def _rows(batches):
    """Per vector length: uids, ids and vectors that take part."""
    for batch in batches:
        column = batch.column("embedding")
        flat = column.flatten()
        values = pc.fill_null(flat.cast(pa.float64()) if not pa.types.is_floating(flat.type) else flat, float("nan")).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        ids = pc.fill_null(batch.column("vec_id"), int(NO_ID)).to_numpy(zero_copy_only=False)
        uids = batch.column("uid").to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes[sizes > 0]).tolist():
            pick = np.flatnonzero(sizes == dim)
            v = values[(at[pick][:, None] + np.arange(dim))]
            good = usable(v)
            if good.any():
                yield dim, uids[pick][good], ids[pick][good], v[good]


def _candidate_tiles(batches):
    tiler = _Tiler(TILE_ROWS, 0)
    for dim, uid, vid, v in _rows(batches):
        yield from tiler.add(dim, uid, vid, v)
    yield from tiler.finish()


def _query_tiles(batches):
    tiler = _Tiler(QUERY_ROWS, 1)
    for dim, uid, vid, v in _rows(batches):
        yield from tiler.add(dim, uid, vid, v)
    yield from tiler.finish()


def _unpack(dim, uids, ids, codes, scales, errors, vectors):
    n = len(uids) // 8
    kind = np.float32 if len(vectors) == n * dim * 4 else np.float64
    small = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64  # sums of products stay exact
    v = np.frombuffer(vectors, kind).reshape(n, dim).astype(np.float64)
    return (np.frombuffer(uids, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(codes, np.int8).reshape(n, dim).astype(small),
            np.frombuffer(scales, np.float64), np.frombuffer(errors, np.float64), v, np.sqrt(in_order(v * v)))


def _tile_pair(q, c, k: int, floor: np.ndarray):
    """Survivors of a tile pair with their exact cosines: query rows,
    candidate rows, scores; per query at most its best k of the tile."""
    q_uid, _, q_codes, q_scale, q_error, q_v, q_norm = q
    c_uid, c_id, c_codes, c_scale, c_error, c_v, c_norm = c
    near = (q_codes @ c_codes.T).astype(np.float64) * q_scale[:, None] * c_scale
    slack = q_error[:, None] + (1 + q_error)[:, None] * c_error + 1e-12
    own = q_uid[:, None] == c_uid
    lower = np.where(own, -np.inf, near - slack)
    if lower.shape[1] > k:
        floor = np.maximum(floor, -np.partition(-lower, k - 1, axis=1)[:, k - 1])
    qi, ci = np.nonzero((near + slack >= floor[:, None]) & ~own)
    score = np.empty(len(qi))
    for lo in range(0, len(qi), PAIRS):
        a, b = qi[lo:lo + PAIRS], ci[lo:lo + PAIRS]
        score[lo:lo + PAIRS] = in_order(q_v[a] * c_v[b]) / (q_norm[a] * c_norm[b])
    order = np.lexsort((c_id[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    first = np.searchsorted(qi, qi, "left")
    best = np.arange(len(qi)) - first < k
    return qi[best], ci[best], score[best]


def _search(k: int):
    def run(batches):
        current, q, heaps = None, None, []

        def give():
            rows = [(int(q[0][i]), int(q[1][i]), -m, s) for i, h in enumerate(heaps) for s, m in h]
            columns = list(zip(*rows)) if rows else [[]] * 4
            ids = [None if v == NO_ID else v for v in columns[2]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(ids, pa.int64()), pa.array(columns[3], pa.float64())],
                ["query_uid", "query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ["q_tile", "dim"]}
                if row["q_tile"] != current:
                    if heaps:
                        yield give()
                    current = row["q_tile"]
                    q = _unpack(row["dim"], *(batch.column("q_" + n)[i].as_buffer() for n in NAMES[2:]))
                    heaps = [[] for _ in range(len(q[0]))]
                c = _unpack(row["dim"], *(batch.column(n)[i].as_buffer() for n in NAMES[2:]))
                floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
                for qi, ci, s in zip(*(x.tolist() for x in _tile_pair(q, c, k, floor))):
                    item = (s, -int(c[1][ci]))  # larger score first, then smaller id
                    if len(heaps[qi]) < k:
                        heapq.heappush(heaps[qi], item)
                    else:
                        heapq.heappushpop(heaps[qi], item)
        if heaps:
            yield give()
    return run


def nearest(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every query row
    (vec_id divisible by ``query_step``)."""
    v = take(vectors, "vec_id", "embedding").filter("embedding is not null")
    v = v.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    c_tiles = cut(v.mapInArrow(_candidate_tiles, TILE), "ann-tiles")
    q_tiles = cut(v.filter(F.col("vec_id") % query_step == 0).mapInArrow(_query_tiles, TILE), "ann-queries")
    stripes = max(1, -(-c_tiles.count() // STRIPE_TILES))
    c = c_tiles.withColumn("stripe", F.pmod(F.xxhash64("tile"), F.lit(stripes)).cast("int")).drop("tile")
    q = q_tiles.withColumn("q_stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    q = q.select("q_stripe", F.col("dim").alias("q_dim"), F.col("tile").alias("q_tile"), *(F.col(n).alias("q_" + n) for n in NAMES[2:]))
    pairs = q.hint("merge").join(c, (F.col("q_stripe") == F.col("stripe")) & (F.col("q_dim") == F.col("dim")))
    found = pairs.drop("q_stripe", "q_dim", "stripe").mapInArrow(_search(k), "query_uid long, query_id long, vec_id long, score double")
    best = W.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
ok AS (SELECT * FROM n WHERE norm > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) / (q.norm * c.norm) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
