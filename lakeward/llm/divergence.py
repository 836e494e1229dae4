"""Divergence between the sources of each language, term by term.

Method. Tasks count terms with sorted machine words. A term of at most 8
bytes is one left-aligned uint64, of at most 16 bytes two; they are radix
sorted (16-bit digits, least significant first, the group's number before
them) and runs are counted. Longer terms are sorted as bytes, in a bucket for
each length. Documents of a term are runs within its run, as occurrences
stay in document order. Spark sums the counts per (language, source, term),
keeps the terms in at least ``LEAST_DOCUMENTS`` documents of the language,
and turns counts into whole-number shares p.

Pairs of sources are compared in blocks: at most about ``TILE`` sources on
either side and ``CHUNK_TERMS`` terms, each a dense table whose cells without
a count hold the share of an absent term; the blocks' sums are added up.
A source takes part in every block of its language by a header row, so
nothing about sources or terms is broadcast or collected.

All numbers are whole. Shares are computed with 38-digit decimals.

Edge cases. A null text, language or source is ''. Every row of the table is
a document, repeated rows too. A group without terms has shares of absent
terms; a language without kept terms gives pairs of value 0 and no term rows.
A text of any length is counted whole, in pieces; a document that spans
pieces counts once per term. An empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm import textvec
from lakeward.llm.common import cut, table, take

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
TILE = 128
CHUNK_TERMS = 4096
#: Occurrences that a task sorts at once, and entries it keeps between sorts.
SORT_ROWS = 1 << 20
KEPT_ROWS = 1 << 20

TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[0x41:0x5B] = TERM_BYTE[0x61:0x7B] = TERM_BYTE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def radix_order(digits: list[np.ndarray]) -> np.ndarray:
    """The order that sorts rows by ``digits`` (most significant first, any
    unsigned kind), stable, by passes over 16-bit digits."""
    n = len(digits[0])
    order = np.arange(n)
    for key in reversed(digits):
        for shift in range(0, 8 * key.dtype.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if n and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before it in any of ``keys``."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class Bucket:
    """Counts of the terms of one width: ``words`` uint64 columns, or byte
    strings of one length."""

    def __init__(self, words: int):
        self.words = words
        self.rows: list[tuple] = []  # keys, doc, group, uses
        self.sums: list[tuple] = []  # keys, group, uses, docs
        self.n_rows = self.n_sums = 0

    def _order(self, keys, group):
        if self.words:
            return radix_order([*keys, group])
        by_group = np.argsort(group, kind="stable")
        return by_group[np.argsort(keys[0][by_group], kind="stable")]

    def add(self, keys, doc, group, uses) -> None:
        self.rows.append((*keys, doc, group, uses))
        self.n_rows += len(doc)

    def reduce(self, open_doc: int) -> None:
        """Count the collected occurrences; those of a document that is not
        complete yet stay, summed up."""
        if not self.rows:
            return
        *keys, doc, group, uses = (np.concatenate(c) for c in zip(*self.rows))
        # a document's group is known, so rows of a term stay in document order within its group
        order = self._order(keys, group)
        keys, doc, group, uses = [k[order] for k in keys], doc[order], group[order], uses[order]
        at = run_starts([*keys, doc])
        uses = np.add.reduceat(uses, at)
        keys, doc, group = [k[at] for k in keys], doc[at], group[at]
        still = doc == open_doc
        self.rows, self.n_rows = [], 0
        if still.any():
            self.add([k[still] for k in keys], doc[still], group[still], uses[still])
        if not still.all():
            done = ~still
            keys, group, uses = [k[done] for k in keys], group[done], uses[done]
            at = run_starts([*keys, group])
            self.sums.append((*[k[at] for k in keys], group[at], np.add.reduceat(uses, at), np.diff(np.append(at, len(group)))))
            self.n_sums += len(at)

    def merge(self) -> None:
        *keys, group, uses, docs = (np.concatenate(c) for c in zip(*self.sums))
        order = self._order(keys, group)
        keys, group = [k[order] for k in keys], group[order]
        at = run_starts([*keys, group])
        self.sums = [(*[k[at] for k in keys], group[at], np.add.reduceat(uses[order], at), np.add.reduceat(docs[order], at))]
        self.n_sums = len(at)

    def take_sums(self):
        """Terms, groups, uses and documents counted so far, which are given up."""
        if not self.sums:
            return None
        self.merge()
        *keys, group, uses, docs = self.sums[0]
        self.sums, self.n_sums = [], 0
        if self.words:
            raw = np.stack(keys, axis=1).astype(">u8").view(np.uint8).reshape(len(group), -1)
            sizes = (raw != 0).sum(axis=1)
            flat = raw[raw != 0].tobytes()  # no term holds a zero byte
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(group), pa.py_buffer(ends), pa.py_buffer(flat))
        else:
            terms = pa.array(keys[0].tolist(), pa.binary()).cast(pa.string())
        return terms, group, uses, docs


class TermCounter:
    """Counts terms per group over the documents of a task."""

    def __init__(self):
        self.buckets: dict[int, Bucket] = {}
        self.held = 0

    def _bucket(self, size: int) -> Bucket:
        # widths 1 and 2 are uint64 columns; a longer term's width is its length
        return self.buckets.setdefault(size, Bucket(size if size <= 2 else 0))

    def piece(self, part: np.ndarray, edges: np.ndarray, first_doc: int, group_of: np.ndarray) -> None:
        """Add the terms of a span of bytes; ``edges`` are the text starts in it."""
        part = LOWER[part]
        inside = TERM_BYTE[part]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        at = edges[(edges > 0) & (edges < len(part))]
        begins[at] = inside[at]
        closes[at - 1] = inside[at - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        if not len(starts):
            return
        sizes = ends - starts
        doc = np.searchsorted(edges, starts, "right") - 1 + first_doc
        group = group_of[doc]
        padded = np.append(part, np.zeros(16, np.uint8))
        for width, pick in ((1, sizes <= 8), (2, (sizes > 8) & (sizes <= 16))):
            rows = np.flatnonzero(pick)
            if len(rows):
                raw = np.lib.stride_tricks.sliding_window_view(padded, 8 * width)[starts[rows]]
                raw = np.where(np.arange(8 * width) < sizes[rows, None], raw, 0).astype(np.uint8)
                words = raw.view(">u8").astype(np.uint64)
                self._bucket(width).add([words[:, i] for i in range(width)], doc[rows], group[rows], np.ones(len(rows), np.int64))
        long = np.flatnonzero(sizes > 16)
        for size in np.unique(sizes[long]).tolist():
            rows = long[sizes[long] == size]
            raw = np.stack([part[s:s + size] for s in starts[rows].tolist()])
            self._bucket(size).add([raw.view(f"S{size}")[:, 0]], doc[rows], group[rows], np.ones(len(rows), np.int64))
        self.held += len(starts)

    def reduce(self, open_doc: int) -> None:
        for b in self.buckets.values():
            b.reduce(open_doc)
        self.held = 0

    def sums(self):
        for b in self.buckets.values():
            if (s := b.take_sums()) is not None:
                yield s


def _count_terms(batches):
    """lang, source, term, uses, docs of the task's documents."""
    counter, names, number, seen = TermCounter(), [], {}, 0
    group_of = np.zeros(0, np.uint32)

    def give():
        langs, sources = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
        for terms, group, uses, docs in counter.sums():
            for lo in range(0, len(group), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                at = pa.array(group[some].astype(np.int64))
                yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), terms[some], pa.array(uses[some]), pa.array(docs[some].astype(np.int64))],
                                                 ["lang", "source", "term", "uses", "docs"])

    for batch in textvec.released(batches):
        data, offsets = textvec.utf8(batch.column("text"))
        group_of = np.zeros(batch.num_rows, np.uint32)
        for i, g in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
            if g not in number:
                number[g] = len(names)
                names.append(g)
            group_of[i] = number[g]
        for lo, hi in textvec.pieces(data, offsets):
            # the texts that start in the span, and before them the one that goes on from the last span
            first = int(np.searchsorted(offsets[:-1], lo, "right")) - 1
            inner = offsets[first + 1:np.searchsorted(offsets, hi, "left")]
            counter.piece(data[lo:hi], np.append(0, inner - lo), first, group_of)
            if counter.held >= SORT_ROWS:
                counter.reduce(int(np.searchsorted(offsets[:-1], hi, "left")) - 1 if hi < len(data) and not np.any(offsets == hi) else -1)
        counter.reduce(-1)  # the documents of a batch are complete
        if sum(b.n_sums for b in counter.buckets.values()) > KEPT_ROWS:
            for b in counter.buckets.values():
                if b.sums:
                    b.merge()
            if sum(b.n_sums for b in counter.buckets.values()) > KEPT_ROWS // 2:
                yield from give()
    yield from give()


def share(uses: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (uses + 2) / (total + 2 * kept)), in whole numbers."""
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (uses + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    below = F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", wide, below) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def gaps(p: np.ndarray, q) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compare(key, rows):
    """Summed gaps of the sources of two tiles over the terms of a chunk."""
    lang, _, low, high = key
    head = rows[rows["term"].isna()]
    a, b = (head[head["tile"] == t].sort_values("source") for t in (low, high))
    body = rows[rows["term"].notna()]
    column, terms = pd.factorize(body["term"])

    def dense(side, tile):
        cells = np.repeat(side["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
        mine = (body["tile"] == tile).to_numpy()
        at = np.searchsorted(side["source"].to_numpy(), body["source"].to_numpy()[mine])
        cells[at, column[mine]] = body["p"].to_numpy(np.int64)[mine]
        return cells

    # kept terms of the chunk that no source of the two tiles has
    absent = (int(head["n_terms"].iloc[0]) if len(head) else 0) - len(terms)
    left = dense(a, low)
    right = left if low == high else dense(b, high)
    names_a, names_b, out = a["source"].to_numpy(), b["source"].to_numpy(), []
    none_a, none_b = a["p"].to_numpy(np.int64), b["p"].to_numpy(np.int64)
    for i, name in enumerate(names_a):
        first = i + 1 if low == high else 0
        sums = gaps(right[first:], left[i]).sum(axis=1) + absent * gaps(none_b[first:], none_a[i])
        out += zip([lang] * len(sums), [name] * len(sums), names_b[first:], sums.tolist())
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS,
          tile: int = TILE, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source is from
    the others of its language (part ``pair``), and its terms that lean most
    from the language to it (part ``term``)."""
    d = take(docs, "text", "lang", "source").select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = d.mapInArrow(_count_terms, "lang string, source string, term string, uses long, docs long")
    # one shuffle by (lang, term) serves the sums per source and those of the term
    counts = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    counts = counts.select("lang", "source", "term", "uses", F.sum("docs").over(term).alias("term_docs"), F.sum("uses").over(term).alias("lang_uses"),
                           F.row_number().over(term.orderBy("source")).alias("nth"))
    kept = cut(counts.where(F.col("term_docs") >= least_documents).drop("term_docs"), "divergence-counts")

    totals = kept.groupBy("lang", "source").agg(F.sum("uses").alias("total"), F.count_if(F.col("nth") == 1).alias("firsts"))
    groups = d.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"), F.count(F.lit(1)).alias("sources"))
    groups = cut(groups.select("lang", "source", "total").join(of_lang, "lang"), "divergence-groups")

    rows = kept.join(groups, ["lang", "source"])
    rows = rows.withColumn("p", share(F.col("uses"), F.col("total"), F.col("kept")))

    q = share(F.col("lang_uses"), F.col("lang_total"), F.col("kept"))
    own = W.partitionBy("lang", "source")
    terms = rows.withColumn("q", q).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    ranked = F.row_number().over(own.orderBy(F.col("value").desc(), "item"))
    terms = terms.withColumn("rank", ranked).where(F.col("rank") <= top_terms)

    chunks = F.greatest(F.ceil(F.col("kept") / chunk_terms), F.lit(1)).cast("int")
    tiles = F.ceil(F.col("sources") / tile).cast("int")
    place = [F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")]
    cells = rows.select("lang", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"), "source", "term", "p", *place)
    in_chunk = rows.where("nth = 1").groupBy("lang", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk")).agg(F.count(F.lit(1)).alias("n_terms"))
    heads = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).join(in_chunk, ["lang", "chunk"], "left")
    heads = heads.select("lang", "chunk", "source", F.lit(None).cast("string").alias("term"),
                         share(F.lit(0).cast("long"), F.col("total"), F.col("kept")).alias("p"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"), *place)
    blocks = cells.unionByName(heads, allowMissingColumns=True).select(
        "lang", "chunk", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "term", "p", "n_terms")
    sums = blocks.groupBy("lang", "chunk", "low", "high").applyInPandas(_compare, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    pairs = pairs.withColumn("rank", ranked)
    return pairs.unionByName(terms)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
occ AS (SELECT uid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT uid, lang, term FROM occ) GROUP BY lang, term HAVING count(*) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
tf AS (SELECT lang, source, term, count(*) AS c FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, sum(c) AS n FROM tf GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, kept.term, coalesce(tf.c, 0) AS c,
    CAST(1 + (1000000000::HUGEINT * (coalesce(tf.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v) AS BIGINT) AS p
  FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN tf ON tf.lang = g.lang AND tf.source = g.source AND tf.term = kept.term
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
lang_uses AS (SELECT lang, term, sum(c) AS c FROM tf GROUP BY ALL),
lang_shares AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (u.c + 2)) // ((SELECT sum(x.c) FROM lang_uses x WHERE x.lang = u.lang) + 2 * v.v) AS BIGINT) AS q
  FROM lang_uses u JOIN v USING (lang)),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pair_sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
term AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares s JOIN lang_shares l USING (lang, term) WHERE s.c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 10
"""
