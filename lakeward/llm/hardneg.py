"""Hard-negative mining with an inverted multi-index.

Method. Vectors are whole numbers, floor(256 x). Two codebooks, one for each
half of the components, are fitted on a sample; a row's cell is the pair of
its nearest codewords. The index holds every row, in tiles of bounded size
whose rows are sorted by cell; a tile knows the radius of each codeword, the
largest distance of one of its half-rows to it. For an anchor a, a half-row
at codeword c with radius r scores at most a.c + |a| r, so the two halves'
bounds add up to a bound for a cell. Anchors are searched for in blocks: a
heap walks the cells of a tile in falling order of the block's largest bound
(multi-sequence order), and the walk stops when the next bound is below what
every window still needs. Cells that lie below what each anchor needs, or above
all its windows, are passed over. The rows of the other cells are scored by one
product of matrices for some thousand rows, in whole numbers that the number
type holds exactly.

Two searches use that walk. The first finds each anchor's best rows of its
own label, the positives. Each positive gives a window of scores; the second
search finds the best rows of other labels in every window, and stops on
windows that are certified: full, with their last score above the bound, or
with the bound below their lower end. The bounds are strict, so both are exact.

Anchors are compared with all rows, in blocks: a task holds one tile of
anchors and streams tiles of the index, so what it has found so far prunes
what comes. Both searches are exact, so on vectors without clusters, where no
bound prunes, products grow with anchors times rows.

Edge cases. A null label, a null or empty vector, and a null or non-finite
component take a row out. So does a component of 2**14 or more in size,
whose products leave the whole numbers that a double can hold. Vectors of
different lengths are not compared. A null vec_id is no anchor and comes last
among ties; rows that repeat a vec_id are rows of their own. Positives of
score below 0 have no window. Fewer rows than asked for give all of them; an
empty table gives no rows; extra columns are ignored.
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

from lakeward.llm import textvec
from lakeward.llm.common import cut, table, take

ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative scores between these hundredths of the positive's score.
LOW, HIGH = 30, 90
#: Rows that the codebooks are fitted on, at most, and codewords of a half.
SAMPLE = 4096
CODEWORDS = 16
TILE_ROWS = 8192
ANCHOR_ROWS = 1024
#: Anchors of a block, and rows of a product: it starts with a few, so that the next ones are pruned.
BLOCK_ROWS = 128
FIRST_ROWS, PRODUCT_ROWS = 256, 2048
#: Bytes of the tiles of a stripe, about, and fewer tiles where cores would be idle, but so many at least.
STRIPE_BYTES, LEAST_TILES = 64 << 20, 4
LARGEST = 1 << 22
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min

TILE = "tile long, dim int, ids binary, labels binary, cells binary, codes binary, radii binary"
ANCHOR = "uid long, vec_id long, label long, dim int, codes binary"


def whole(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length: which rows take part, and their floor(256 x)."""
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = {}
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        with np.errstate(all="ignore"):
            v = np.floor(flat[at[rows][:, None] + np.arange(dim)] * 256.0)
            good = (np.abs(v) < LARGEST).all(axis=1)  # false for NaN and infinity, too
        if good.any():
            out[dim] = rows[good], v[good].astype(np.int32)
    return out


def fit(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Codewords of ``rows`` by Lloyd's iterations from distinct rows."""
    x = rows.astype(np.float64)
    words = np.unique(x, axis=0)
    words = words[np.linspace(0, len(words) - 1, min(k, len(words))).astype(int)]
    for _ in range(rounds):
        near = nearest_word(x, words)
        for i in range(len(words)):
            mine = near == i
            if mine.any():
                words[i] = x[mine].mean(axis=0)
    return words


def nearest_word(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not x.shape[1] or len(words) == 1:
        return np.zeros(len(x), np.int64)
    return np.argmin((words * words).sum(axis=1) - 2 * (x @ words.T), axis=1)


def codebooks(vectors: DataFrame, sample: int = SAMPLE, k: int = CODEWORDS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length of the sample (``sample`` rows at most, by a
    hash of vec_id) the codewords of both halves. They steer the search, not
    its result."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow().combine_chunks()
    column = rows.column("embedding")
    column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float32()))
    return {dim: (fit(v[:, :dim // 2], k), fit(v[:, dim // 2:], k)) for dim, (_, v) in whole(column).items()}


def narrow(v: np.ndarray) -> np.ndarray:
    """``v`` in 16 bits where they hold it."""
    return v.astype(np.int16) if np.abs(v).max(initial=0) < 1 << 15 else v


def codes_of(blob, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.int16 if len(blob) == 2 * n * dim else np.int32).reshape(n, dim)


def _books(sent: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """A length that the sample lacks has one codeword, the origin."""
    return sent.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def _tiles(sent):
    """The rows of a task as tiles of the index."""
    def run(batches):
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 24

        def tile(dim, columns):
            nonlocal number
            ids, labels, v = columns
            books = _books(sent.value, dim)
            halves = v[:, :dim // 2].astype(np.float64), v[:, dim // 2:].astype(np.float64)
            words = [nearest_word(x, b) for x, b in zip(halves, books)]
            cell = words[0] * len(books[1]) + words[1]
            order = np.argsort(cell, kind="stable")
            radii = []
            for x, w, b in zip(halves, words, books):
                r = np.full(len(b), -1.0)  # a codeword without rows
                np.maximum.at(r, w, np.sqrt(((x - b[w]) ** 2).sum(axis=1)))
                radii.append(r)
            blobs = [ids[order], labels[order], cell[order].astype(np.int32), narrow(v[order]), np.concatenate(radii)]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([dim], pa.int32()), *(pa.array([np.ascontiguousarray(b).tobytes()], pa.binary()) for b in blobs)],
                ["tile", "dim", "ids", "labels", "cells", "codes", "radii"])

        for batch in textvec.released(batches):
            ids = pc.fill_null(batch.column("vec_id"), int(NO_ID)).to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for dim, (rows, v) in whole(batch.column("embedding")).items():
                held.setdefault(dim, []).append((ids[rows], labels[rows], v))
                while sum(len(c[0]) for c in held[dim]) >= TILE_ROWS:
                    joined = [np.concatenate(c) for c in zip(*held[dim])]
                    yield tile(dim, [c[:TILE_ROWS] for c in joined])
                    held[dim] = [tuple(c[TILE_ROWS:] for c in joined)]
        for dim, columns in held.items():
            joined = [np.concatenate(c) for c in zip(*columns)]
            if len(joined[0]):
                yield tile(dim, joined)
    return run


def _anchors(step: int):
    """The anchors among the rows of the index; uid tells a row from any other."""
    def run(batches):
        for batch in textvec.released(batches):
            for i in range(batch.num_rows):
                t = Tile(batch, i, "")
                rows = np.flatnonzero((t.ids % step == 0) & (t.ids != NO_ID))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.uids[rows]), pa.array(t.ids[rows]), pa.array(t.labels[rows]), pa.array(np.full(len(rows), t.dim, np.int32)),
                     pa.array([r.tobytes() for r in t.codes[rows]], pa.binary())], ["uid", "vec_id", "label", "dim", "codes"])
    return run


class Scored:
    """Rows of whole numbers, in the types that products are made in."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.as_type = codes, {}
        self.longest = np.sqrt((codes.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))

    def numbers(self, kind) -> np.ndarray:
        if kind not in self.as_type:
            self.as_type[kind] = self.codes.astype(kind)
        return self.as_type[kind]


def product_type(a: Scored, b: Scored):
    """The smallest type that holds every sum of products of two rows: none is
    larger than the product of their lengths, and all are whole numbers."""
    reach = a.longest * b.longest * (1 + 1e-9)
    return np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64


class Tile(Scored):
    """A tile of the index."""

    def __init__(self, batch, i, prefix):
        blob = lambda name: batch.column(prefix + name)[i].as_buffer()
        get = lambda name, kind: np.frombuffer(blob(name), kind)
        self.dim = batch.column(prefix + "dim")[i].as_py()
        self.ids, self.labels, cells = get("ids", np.int64), get("labels", np.int64), get("cells", np.int32)
        self.uids = (batch.column(prefix + "tile")[i].as_py() << 14) + np.arange(len(self.ids))
        super().__init__(codes_of(blob("codes"), len(self.ids), self.dim))
        self.radii = get("radii", np.float64)
        at = np.flatnonzero(np.diff(cells, prepend=-1, append=-1))
        self.span = {int(cells[lo]): (int(lo), int(hi)) for lo, hi in zip(at[:-1], at[1:])}


def walk(upper: tuple[np.ndarray, np.ndarray]):
    """Pairs (bound, i, j) of codewords in falling order of upper[0][i] +
    upper[1][j]. Codewords without rows have the bound -inf and are left out."""
    order = [np.argsort(-u, kind="stable")[:np.isfinite(u).sum()] for u in upper]
    first, second = (u[o] for u, o in zip(upper, order))
    if not len(first) or not len(second):
        return
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, order[0][i], order[1][j]
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


class Block(Scored):
    """Anchors that are searched for together. Each has some windows, the
    scores from ``low`` to ``high``, and in each the best ``k`` rows so far."""

    def __init__(self, codes, uids, labels, same: bool, low: np.ndarray, high: np.ndarray, k: int):
        super().__init__(codes)
        self.uids, self.labels, self.same, self.k = uids, labels, same, k
        self.low, self.high = low, high  # anchors by windows; a window that an anchor lacks has low > high
        shape = *low.shape, k
        self.scores, self.ids, self.found = np.full(shape, LEAST), np.full(shape, NO_ID), np.full(shape, -1)  # best first
        self.rows = FIRST_ROWS

    @property
    def needs(self) -> np.ndarray:
        """Scores below these cannot enter the windows."""
        return np.where(self.found[:, :, -1] >= 0, self.scores[:, :, -1], self.low)

    def search(self, tile: Tile, books, bounds) -> None:
        """Offer the rows of a tile to the windows."""
        upper, lower = bounds
        n_second = len(books[1])
        fits = np.isin(tile.labels, self.labels) if self.same else np.ones(len(tile.labels), bool)
        until = np.concatenate([[0], np.cumsum(fits)]).tolist()
        bottom = lower[0][:, :, None] + lower[1][:, None, :] <= self.high.max(axis=1)[:, None, None]
        above = upper[0][:, :, None] + upper[1][:, None, :]

        def wanted():
            least = self.needs.min(axis=1)
            return least.min(), (bottom & (above >= least[:, None, None])).any(axis=0)

        least, cells = wanted()
        spans, n = [], 0
        for bound, i, j in walk((upper[0].max(axis=0), upper[1].max(axis=0))):
            if bound < least:
                break
            span = tile.span.get(int(i) * n_second + int(j))
            if span is None or not cells[i, j]:
                continue
            spans.append(span)
            n += until[span[1]] - until[span[0]]
            if n >= self.rows:
                self.score(tile, spans, fits)
                self.rows = min(2 * self.rows, PRODUCT_ROWS)
                spans, n = [], 0
                least, cells = wanted()
        if n:
            self.score(tile, spans, fits)

    def score(self, tile: Tile, spans: list[tuple[int, int]], fits: np.ndarray) -> None:
        """Score the fitting rows of spans and offer those that a window needs."""
        rows = np.concatenate([np.arange(*span) for span in spans])
        rows = rows[fits[rows]]
        kind = product_type(self, tile)
        own, other, needs = self.numbers(kind), tile.numbers(kind), self.needs
        low, high = needs.min(axis=1).astype(kind), self.high.max(axis=1).astype(kind)
        for lo in range(0, len(rows), PRODUCT_ROWS):  # a cell may hold more
            part = rows[lo:lo + PRODUCT_ROWS]
            scores = own @ other[part].T
            a, r = np.divmod(np.flatnonzero((scores >= low[:, None]) & (scores <= high[:, None])), len(part))
            if not len(a):
                continue
            s, r = scores[a, r].astype(np.int64), part[r]
            mine = (tile.labels[r] == self.labels[a]) == self.same
            if self.same:
                mine &= tile.uids[r] != self.uids[a]
            self.offer(a[mine], s[mine], tile.ids[r[mine]], tile.uids[r[mine]])

    def offer(self, a: np.ndarray, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        """Rows with these scores for the anchors ``a``: larger scores come
        first, then smaller ids."""
        needs, last = self.needs[a], np.where(self.found[:, :, -1] >= 0, self.ids[:, :, -1], NO_ID)[a]
        s = scores[:, None]
        at, w = np.nonzero(((s > needs) | ((s == needs) & (ids[:, None] <= last))) & (s <= self.high[a]))
        if not len(at):
            return
        k, slot = self.k, a[at] * self.low.shape[1] + w
        # the rows of the windows that change, old and new
        mine = np.unique(slot)
        kept = [x.reshape(-1, k)[mine].ravel() for x in (self.scores, self.ids, self.found)]
        old = kept[2] >= 0
        slot = np.concatenate([np.repeat(mine, k)[old], slot])
        scores, ids, uids = (np.concatenate([x[old], y[at]]) for x, y in zip(kept, (scores, ids, uids)))
        order = np.lexsort((uids, ids, -scores, slot))
        slot = slot[order]
        nth = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        best = nth < k
        slot, nth, order = slot[best], nth[best], order[best]
        for x, y in zip((self.scores, self.ids, self.found), (scores, ids, uids)):
            x.reshape(-1, k)[slot, nth] = y[order]


def windows_of(scores: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positive scores by anchors, each once and none below 0, and the lowest
    and highest scores of their negatives; an anchor with fewer has empty windows."""
    distinct = [sorted({s for s in mine if s >= 0}) for mine in scores]
    n = max(map(len, distinct), default=0)
    at = np.array([mine + [-1] * (n - len(mine)) for mine in distinct], np.int64).reshape(len(distinct), n)
    # LOW * at / 100 rounded up and HIGH * at / 100 rounded down, without overflow
    q, r = np.divmod(at, 100)
    low, high = LOW * q - (-LOW * r // 100), HIGH * q + HIGH * r // 100
    return at, np.where(at < 0, NO_ID, low), np.where(at < 0, LEAST, high)


def _search(sent, positives: int, negatives: int):
    """Stream index tiles past each tile of anchors. With windows (the scores
    of the positives) rows of other labels are looked for, else positives."""
    names = ["uid", "window", "found_uid", "found_id", "score"]

    def block(q, dim, rows, books):
        code = np.stack([codes_of(q["codes"][i], 1, dim)[0].astype(np.int32) for i in rows])
        uids, labels = (np.array([q[c][i] for i in rows], np.int64) for c in ("uids", "labels"))
        same = q["windows"][rows[0]] is None
        if same:
            at, low, high = (np.full((len(rows), 1), x, np.int64) for x in (0, LEAST, NO_ID))
        else:
            at, low, high = windows_of([q["windows"][i] for i in rows])
        out = Block(code, uids, labels, same, low, high, positives if same else negatives)
        halves = code[:, :dim // 2].astype(np.float64), code[:, dim // 2:].astype(np.float64)
        middle = [h @ b.T for h, b in zip(halves, books)]
        length = [np.sqrt((h * h).sum(axis=1, keepdims=True)) for h in halves]
        size = [np.abs(m).max(axis=1, keepdims=True, initial=0.0) for m in middle]
        return out, at, list(zip(middle, length, size))

    def blocks_of(q, dim, books):
        """Blocks of like anchors: of few labels to find positives, else of few cells."""
        rows = [i for i, scores in enumerate(q["windows"]) if scores is None or any(s >= 0 for s in scores)]
        if not rows:
            return []
        code = np.stack([codes_of(q["codes"][i], 1, dim)[0].astype(np.float64) for i in rows])
        cell = [nearest_word(h, b) for h, b in zip((code[:, :dim // 2], code[:, dim // 2:]), books)]
        labels = [q["labels"][i] if q["windows"][i] is None else 0 for i in rows]
        rows = np.array(rows)[np.lexsort((cell[1], cell[0], labels))].tolist()
        return [block(q, dim, rows[lo:lo + BLOCK_ROWS], books) for lo in range(0, len(rows), BLOCK_ROWS)]

    def run(batches):
        current, blocks = None, []

        def give():
            for b, at, _ in blocks:
                a, w, n = np.nonzero(b.found >= 0)
                ids = b.ids[a, w, n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.uids[a]), pa.array(at[a, w]), pa.array(b.found[a, w, n]), pa.array(ids, mask=ids == NO_ID), pa.array(b.scores[a, w, n])], names)

        for batch in batches:
            for r in range(batch.num_rows):
                if (number := batch.column("q_tile")[r].as_py()) != current:
                    yield from give()
                    current, dim = number, batch.column("dim")[r].as_py()
                    books = _books(sent.value, dim)
                    blocks = blocks_of({c: batch.column("q_" + c)[r].as_py() for c in ("uids", "labels", "codes", "windows")}, dim, books)
                if not blocks:
                    continue
                tile = Tile(batch, r, "")
                radii = tile.radii[:len(books[0])], tile.radii[len(books[0]):]
                for b, _, halves in blocks:
                    upper, lower = [], []
                    for (m, n, s), radius in zip(halves, radii):
                        # a little more than the computed bound covers its rounding
                        reach = n * radius * (1 + 1e-9) + 1e-9 * s + 1e-6
                        upper.append(np.where(radius < 0, -np.inf, m + reach))
                        lower.append(m - reach)
                    b.search(tile, books, (upper, lower))
        yield from give()
    return run


def _against_index(anchors: DataFrame, tiles: DataFrame, stripes: int, sent, positives: int, negatives: int) -> DataFrame:
    """uid, window, found_uid, found_id, score: what each tile of anchors finds
    in each stripe of index tiles."""
    # anchors of one length share a tile
    number = F.monotonically_increasing_id()
    q = anchors.mapInArrow(_anchor_tiles, "dim int, uids array<long>, labels array<long>, codes array<binary>, windows array<array<long>>")
    q = q.withColumn("q_tile", number).withColumn("q_stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    q = q.select("q_tile", "q_stripe", F.col("dim").alias("q_dim"), *(F.col(c).alias("q_" + c) for c in ("uids", "labels", "codes", "windows")))
    c = tiles.withColumn("stripe", F.pmod(F.xxhash64("tile"), F.lit(stripes)).cast("int"))
    # the anchors asked for against all rows, in blocks
    blocks = q.hint("merge").join(c, (F.col("q_stripe") == F.col("stripe")) & (F.col("q_dim") == F.col("dim"))).drop("q_stripe", "q_dim", "stripe")
    return blocks.mapInArrow(_search(sent, positives, negatives), "uid long, window long, found_uid long, found_id long, score long")


def _anchor_tiles(batches):
    held: dict[int, list] = {}

    def tile(dim, rows):
        uids, labels, codes, windows = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([uids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())),
             pa.array([codes], pa.list_(pa.binary())), pa.array([windows], pa.list_(pa.list_(pa.int64())))],
            ["dim", "uids", "labels", "codes", "windows"])

    for batch in batches:
        for row in batch.to_pylist():
            rows = held.setdefault(row["dim"], [])
            rows.append((row["uid"], row["label"], row["codes"], row["windows"]))
            if len(rows) == ANCHOR_ROWS:
                yield tile(row["dim"], held.pop(row["dim"]))
    for dim, rows in held.items():
        yield tile(dim, rows)


def mine(vectors: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score for every anchor (vec_id divisible by ``anchor_step``)."""
    spark = vectors.sparkSession
    v = take(vectors, "vec_id", "embedding", "label").where("label is not null and embedding is not null")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    v = v.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", label.alias("label"))
    sent = spark.sparkContext.broadcast(codebooks(v))  # two codebooks of CODEWORDS words for each length
    tiles = cut(v.mapInArrow(_tiles(sent), TILE), "hardneg-index")
    n_tiles, n_bytes = tiles.agg(F.count("tile"), F.coalesce(F.sum(F.length("codes")), F.lit(0))).first()
    stripes = max(1, -(-n_bytes // STRIPE_BYTES), min(-(-n_tiles // LEAST_TILES), spark.sparkContext.defaultParallelism))
    anchors = cut(tiles.mapInArrow(_anchors(anchor_step), ANCHOR), "hardneg-anchors")

    none = F.lit(None).cast("array<bigint>")
    near = _against_index(anchors.withColumn("windows", none), tiles, stripes, sent, positives, negatives)
    order = [F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_uid"]
    best = F.row_number().over(W.partitionBy("uid").orderBy(*order))
    chosen = near.withColumn("nth", best).where(F.col("nth") <= positives).select(
        "uid", F.col("found_uid").alias("positive_uid"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = cut(chosen, "hardneg-positives")

    windows = chosen.groupBy("uid").agg(F.collect_set("positive_score").alias("windows"))  # at most ``positives`` scores
    far = _against_index(anchors.join(windows, "uid").select("uid", "vec_id", "label", "dim", "codes", "windows"), tiles, stripes, sent, positives, negatives)
    first = F.row_number().over(W.partitionBy("uid", "window").orderBy(*order))
    far = far.withColumn("rank", first).where(F.col("rank") <= negatives).select(
        "uid", F.col("window").alias("positive_score"), "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    return chosen.join(names, "uid").join(far, ["uid", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
    CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM base a JOIN base c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
  FROM scores WHERE label = anchor_label),
windows AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS r
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
  WHERE p.nth <= 5)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE r <= 10
"""
