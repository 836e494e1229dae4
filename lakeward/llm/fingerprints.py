"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Method. Every three successive bytes of a text are hashed into one of
``BUCKETS`` counters. The counters' quartiles turn each counter into a code
of two bits (how many quartiles lie below it); the digest is the codes, the
logarithm of the length and two quartile ratios, in hex. Two digests are
compared by the sum of their code differences plus a header difference,
and ``likeness`` maps that onto 0 to 1 (1: no difference; 0: as far apart
as unrelated codes or farther).

The edited texts need each document's successor in doc_id order: rows are
range-partitioned and sorted by doc_id once, each task pairs neighbours as
they stream by, and only the first and last row of every partition are
paired afterwards. Memory per task is a batch of rows.

Edge cases. A null text is empty; an empty text has the digest of zero
counts. Equal doc_ids are ordered by a hash of their text, a null doc_id
comes first, repeated rows are kept; the last document's successor is the
first (itself, if alone). Empty input gives an empty result. Extra columns
are ignored. A text shorter than three bytes has no triplet: its digest
tells its length only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm import textvec
from lakeward.llm.common import cut, table, take

BUCKETS = 512
PIECE = 1 << 20
#: Mean difference of two independent uniform codes 0..3.
UNRELATED = 1.25
LENGTH_STEP = 1.1


def triplet_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed byte triplets, one row per text."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for lo in range(0, max(len(data) - 2, 0), PIECE):
        hi = min(len(data) - 2, lo + PIECE)
        b = data[lo:hi + 2].astype(np.uint32)
        triplet = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        h = ((triplet + np.uint32(1)) * np.uint32(0x9E3779B1) >> shift).astype(np.int64)
        first = np.searchsorted(offsets, lo, "right") - 1
        last = np.searchsorted(offsets, hi, "left")
        edges = np.clip(offsets[first:last + 1], lo, hi)
        owner = np.repeat(np.arange(first, first + len(edges) - 1), np.diff(edges))
        inside = np.arange(lo, hi) + 2 < offsets[owner + 1]
        keys = (owner - first) * BUCKETS + h
        got = np.bincount(keys[inside], minlength=(last - first) * BUCKETS)
        counts[first * BUCKETS:first * BUCKETS + len(got)] += got
    return counts.reshape(n, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Header (length code, two ratios) and codes of each text."""
    counts = triplet_counts(data, offsets)
    ordered = np.sort(counts, axis=1)
    q = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q[:, :1]).astype(np.uint8) + (counts > q[:, 1:2]) + (counts > q[:, 2:])
    size = np.diff(offsets)
    length = np.minimum(np.round(np.log1p(size) / np.log(LENGTH_STEP)), 255)
    top = np.maximum(q[:, 2], 1)
    header = np.stack([length, np.minimum(15, q[:, 0] * 16 // top), np.minimum(15, q[:, 1] * 16 // top)], axis=1)
    return header.astype(np.uint8), codes


def encode(header: np.ndarray, codes: np.ndarray) -> list[str]:
    """The digests as hex strings: length (2 digits), two ratios, codes."""
    packed = codes.reshape(len(codes), -1, 4)
    packed = packed[:, :, 0] << 6 | packed[:, :, 1] << 4 | packed[:, :, 2] << 2 | packed[:, :, 3]
    head = np.stack([header[:, 0], header[:, 1] << 4 | header[:, 2]], axis=1)
    return [row.tobytes().hex() for row in np.concatenate([head, packed], axis=1)]


def decode(digest: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
    header = np.array([[raw[0], raw[1] >> 4, raw[1] & 15]], np.uint8)
    codes = np.stack([raw[2:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).reshape(1, -1)
    return header, codes


def _likeness(ha, ca, hb, cb) -> np.ndarray:
    body = np.abs(ca.astype(np.int16) - cb).sum(axis=1)
    head = np.abs(ha.astype(np.int16) - hb)
    difference = body + 2 * np.minimum(head[:, 0], 32) + head[:, 1] + head[:, 2]
    return 1.0 - np.minimum(1.0, difference / (UNRELATED * BUCKETS))


def likeness(a: str, b: str) -> float:
    """Likeness of two digests, 0 to 1."""
    return float(_likeness(*decode(a), *decode(b))[0])


def _edited(data: np.ndarray, offsets: np.ndarray, n: int):
    """Code points of each text, and the first ``n`` texts edited with the
    text after them: buffer, offsets."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(begins, offsets)
    chars = np.diff(first)
    raw = data.tobytes()
    byte_at = np.append(begins, len(data))
    out = []
    for i in range(n):
        half = int(chars[i]) // 2
        keep_to = int(byte_at[first[i + 1] - half]) if half else int(offsets[i + 1])
        take_to = int(byte_at[first[i + 1] + min(half, int(chars[i + 1]))]) if half and half < chars[i + 1] else int(offsets[i + 2] if half else offsets[i + 1])
        out.append(raw[offsets[i]:keep_to] + raw[offsets[i + 1]:take_to])
    at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)
    return chars, out, np.frombuffer(b"".join(out), np.uint8), at


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """Results of all texts but the last, each with the next as successor."""
    n = len(offsets) - 2
    chars, edited, e_data, e_offsets = _edited(data, offsets, n)
    head, codes = digests(data, offsets)
    e_head, e_codes = digests(e_data, e_offsets)
    return pa.RecordBatch.from_arrays(
        [doc_ids.slice(0, n), pa.array(chars[:n].astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in edited]),
         pa.array(encode(head[:n], codes[:n])), pa.array(encode(e_head, e_codes)),
         pa.array(_likeness(head[:n], codes[:n], e_head, e_codes)), pa.array(_likeness(head[:n], codes[:n], head[1:n + 1], codes[1:n + 1]))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


STEP_BYTES = 4 << 20


def _neighbours(batches):
    """Results of the rows of a sorted partition but its last, and the
    partition's first and last row with their texts."""
    part = TaskContext.get().partitionId()
    held = None  # doc_id and text of the row before
    first = None
    names = ["part", "edge", "text"]

    def out(result: pa.RecordBatch, edge: str, text: list):
        n = result.num_rows
        return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([edge] * n), pa.array(text, pa.string()), *result.columns],
                                          [*names, *result.schema.names])

    def edge(row, kind):
        empty = [pa.array([row[0]], pa.int64()), pa.nulls(1, pa.int64()), *(pa.nulls(1, pa.string()) for _ in range(3)),
                 *(pa.nulls(1, pa.float64()) for _ in range(2))]
        return out(pa.RecordBatch.from_arrays(empty, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                      "near_edited", "near_next"]), kind, [row[1]])

    for batch in textvec.released(batches):
        ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.string())
        if not batch.num_rows:
            continue
        _, sizes = textvec.utf8(texts)
        # long texts are taken in small groups
        group = (sizes[1:] // STEP_BYTES)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part_ids, part_texts = ids.slice(lo, hi - lo), texts.slice(lo, hi - lo)
            if held is not None:
                part_ids = pa.concat_arrays([pa.array([held[0]], pa.int64()), part_ids])
                part_texts = pa.concat_arrays([pa.array([held[1]], pa.string()), part_texts])
            if first is None:
                first = (part_ids[0].as_py(), part_texts[0].as_py())
            if len(part_ids) > 1:
                result = _compare(part_ids, *textvec.utf8(part_texts))
                yield out(result, "", [None] * result.num_rows)
            held = (part_ids[-1].as_py(), part_texts[-1].as_py())
    if first is not None:
        yield edge(first, "first")
        yield edge(held, "last")


def _pairs(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            texts = pa.array([batch.column("text")[i].as_py() or "", batch.column("next_text")[i].as_py() or ""])
            yield _compare(pa.array([batch.column("doc_id")[i].as_py(), None], pa.int64()), *textvec.utf8(texts))


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document (see the module)."""
    d = take(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("h", F.xxhash64("text"))
    d = d.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    done = cut(d.mapInArrow(_neighbours, "part int, edge string, text string, " + RESULT), "fp-rows")
    names = [c.split()[0] for c in RESULT.split(", ")]
    # two rows per partition are left: the last of each meets the first of the next
    firsts = done.filter("edge = 'first'").select("part")
    around = W.orderBy("part")
    ring = firsts.select(F.col("part").alias("r_part"), F.coalesce(F.lead("part").over(around), F.min("part").over(W.partitionBy())).alias("r_next"))
    lasts = done.filter("edge = 'last'").select("part", "doc_id", "text")
    heads = done.filter("edge = 'first'").select(F.col("part").alias("h_part"), F.col("text").alias("next_text"))
    pairs = lasts.join(ring, F.col("part") == F.col("r_part")).join(heads, F.col("r_next") == F.col("h_part"))
    rest = pairs.select("doc_id", "text", "next_text").mapInArrow(_pairs, RESULT)
    return done.filter("edge = ''").select(*names).unionByName(rest)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))
