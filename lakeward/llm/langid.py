"""Language identification with a blended-spectrum string kernel.

Method. A text is cut into windows of about ``WINDOW`` bytes. The features
of a window are the presence of its byte n-grams, n = 1 to ``MAX_N``, hashed
into ``BUCKETS``; the kernel of two windows is their number of common
n-grams over the root of the product of their sizes. ``LANDMARKS`` training
windows give the Nystroem map phi(x) = k(x, landmarks) K^(-1/2), and
one-versus-rest ridge regression on phi gives a score per language. Scoring
is two matrix products per batch of windows; a document's scores are the
means over all its windows, so whole texts of any length are used and
mixed texts go to the language that fills most windows.

What is learned. The model is fitted on at most about ``SAMPLE`` labelled
documents (equal numbers per language, chosen by a hash of doc_id, each
doc_id once; never more than four times as many) of the ``MAX_LANGS`` most
frequent languages, and four windows of each; these are parameters. lang,
source and doc_id are never inputs of a prediction.

Edge cases. A null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing can be learned. Null languages and null ids
are not learned from. Repeated rows are predicted each; ties go to the
language that sorts first. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import textvec
from lakeward.llm.common import filter_rows, is_held_out, is_train, table, take

WINDOW = 1024
MAX_N = 4
BUCKETS = 1 << 13
LANDMARKS = 192
SAMPLE = 2000
WINDOWS_PER_DOCUMENT = 4
RIDGE = 1e-2
SHARPNESS = 4.0
BATCH_BYTES = 1 << 18
UNDEFINED = "und"
#: Languages that are learned: the most frequent ones of the training rows.
MAX_LANGS = 256

# A-Z to a-z, and every other ASCII byte that is no letter to a space
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x80] = 0x20
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case letters of ASCII and Latin-1, spaces for other ASCII."""
    out = _FOLD[data]
    if len(out) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def presence(data: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Matrix of hashed n-gram presence: ``owner`` is the row of each byte,
    -1 for bytes of no row; n-grams do not cross rows."""
    flags = np.zeros(rows * BUCKETS, np.uint8)
    b = data.astype(np.uint32)
    h = np.zeros(len(b), np.uint32)
    for n in range(1, MAX_N + 1):
        if len(b) < n:
            break
        h = h[:len(b) - n + 1] * np.uint32(257) + b[n - 1:] + np.uint32(1)
        own = owner[:len(h)]
        same = (own >= 0) & (own == owner[n - 1:])
        x = (h ^ np.uint32(n * 0x3C6EF35F)) * np.uint32(0x9E3779B1)
        bucket = (x >> np.uint32(32 - (BUCKETS.bit_length() - 1))).astype(np.int64)
        flags[(own * BUCKETS + bucket)[same]] = 1
    return flags.reshape(rows, BUCKETS)


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of every row with every landmark."""
    a = np.sqrt(np.maximum(rows.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
    b = np.sqrt(np.maximum(landmarks.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
    return (rows.astype(np.float32) @ landmarks.astype(np.float32).T) / a[:, None] / b


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte edges of the windows of all texts, and the number of windows of
    each text (at least one for a text with bytes)."""
    size = np.diff(offsets)
    count = np.where(size > 0, np.maximum(1, np.round(size / WINDOW)), 0).astype(np.int64)
    text = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begins = offsets[text] + size[text] * nth // np.maximum(count[text], 1)
    return np.append(begins, offsets[-1]), count


def _sample_windows(batches):
    for batch in batches:
        data, offsets = textvec.utf8(batch.column("text"))
        lang = batch.column("lang").to_pylist()
        edges, count = windows(offsets)
        at = np.concatenate([[0], np.cumsum(count)])
        out_lang, out = [], []
        for i in range(len(lang)):
            picks = np.unique(np.linspace(0, max(count[i] - 1, 0), WINDOWS_PER_DOCUMENT).astype(int)) if count[i] else []
            for k in picks:
                out_lang.append(lang[i])
                out.append(data[edges[at[i] + k]:min(edges[at[i] + k + 1], offsets[i + 1])].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out_lang, pa.string()), pa.array(out, pa.binary())], ["lang", "part"])


def training_windows(docs: DataFrame, sample: int = SAMPLE):
    """Languages and byte windows of the bounded training sample."""
    d = take(docs, "doc_id", "text", "lang").filter("doc_id is not null and lang is not null and text is not null").filter(is_train())
    per_lang = d.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGS)
    counts = {r["lang"]: r["n"] for r in per_lang.collect()}
    if not counts:
        return [], []
    each = max(10, sample // len(counts))
    keep = F.lit(False)
    for lang, n in counts.items():
        share = min(1.0, each / n)
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1))
    # folded over the letters of the text, so texts without any teach nothing
    rows = d.filter(keep).filter(F.col("text").rlike(r"\p{L}"))
    # a doc_id is drawn once, however many rows have it; the limit holds whatever the ids are
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc_id", "r.*")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(4 * max(sample, 10 * len(counts))).select("lang", "text")
    rows = rows.mapInArrow(_sample_windows, "lang string, part binary")
    got = sorted((r["lang"], bytes(r["part"])) for r in rows.collect())
    return [g[0] for g in got], [g[1] for g in got]


def fit(langs: list[str], parts: list[bytes], landmarks: int = LANDMARKS) -> dict | None:
    """Nystroem landmarks and ridge weights from labelled windows."""
    names = sorted(set(langs))
    if not names:
        return None
    data = fold(np.frombuffer(b"".join(parts), np.uint8))
    sizes = np.array([len(p) for p in parts])
    x = presence(data, np.repeat(np.arange(len(parts)), sizes), len(parts))
    of = np.array([names.index(v) for v in langs])
    picks = []
    for c in range(len(names)):
        own = np.flatnonzero(of == c)
        picks.append(own[np.unique(np.linspace(0, len(own) - 1, max(2, landmarks // len(names))).astype(int))])
    marks = x[np.concatenate(picks)]
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    use = values > 1e-6 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])
    phi = kernel(x, marks).astype(np.float64) @ root
    phi = np.hstack([phi, np.ones((len(phi), 1))])
    # every language has the same total weight
    weight = 1.0 / np.bincount(of, minlength=len(names))[of]
    weight *= len(of) / weight.sum()
    target = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = (phi * weight[:, None]).T @ phi + RIDGE * len(phi) / 100 * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, (phi * weight[:, None]).T @ target)
    return {"names": names, "marks": marks, "beta": (root @ beta[:-1]).astype(np.float32), "bias": beta[-1].astype(np.float32)}


def _score_batch(m: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean window scores per text and language."""
    edges, count = windows(offsets)
    text_of = np.repeat(np.arange(len(count)), count)
    total = np.zeros((len(count), len(m["names"])))
    lo = 0
    n = len(text_of)
    while lo < n:
        hi = min(max(lo + 1, int(np.searchsorted(edges, edges[lo] + BATCH_BYTES, "right")) - 1), n)
        part = fold(data[edges[lo]:edges[hi]])
        owner = np.repeat(np.arange(hi - lo), np.diff(edges[lo:hi + 1]))
        k = kernel(presence(part, owner, hi - lo), m["marks"])
        np.add.at(total, text_of[lo:hi], k @ m["beta"] + m["bias"])
        lo = hi
    return total / np.maximum(count, 1)[:, None]


def _predictor(sent):
    """A function from an Arrow string column (null: undefined) to the
    predicted languages, scores and margins (how far the winner's
    one-versus-rest score is above the next one's, or above that of "no" if
    one language is known)."""
    m = sent.value

    def run(column: pa.Array):
        known = np.asarray(column.is_valid())
        s = _score_batch(m, *textvec.utf8(column))
        e = np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True)))
        p = e / e.sum(axis=1, keepdims=True)
        names = np.array([*m["names"], UNDEFINED], dtype=object)[np.where(known, p.argmax(axis=1), len(m["names"]))]
        best = np.sort(np.hstack([s, np.full((len(s), 1), -1.0)]), axis=1)[:, -2:]
        return names, np.where(known, p.max(axis=1), 0.0), best[:, 1] - best[:, 0]

    return run


def _lettered(text: Column) -> Column:
    """The text, or null where it has no letter."""
    return F.when(text.rlike(r"\p{L}"), text)


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    d = take(docs, "doc_id", "text").select("doc_id", _lettered(F.col("text")).alias("text"))
    if model is None:
        return d.select("doc_id", F.lit(UNDEFINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # LANDMARKS x BUCKETS bytes

    def run(batches):
        predictor = _predictor(sent)
        for batch in textvec.released(batches):
            names, score, _ = predictor(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    return d.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: dict | None, least: float) -> DataFrame:
    """The rows of ``docs`` with a predicted language and a margin of at least
    ``least``, unchanged; the margin does not depend on how many languages
    are known. Rows are judged where they are; nothing is joined.
    Without a model the rows with a letter stay."""
    if model is None:
        return filter_rows(docs, "text", _lettered, lambda: lambda column: column.is_valid().to_numpy(False))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep():
        predictor = _predictor(sent)

        def mark(column):
            names, _, margin = predictor(column)
            return (names != UNDEFINED) & (margin >= least)
        return mark

    return filter_rows(docs, "text", _lettered, keep)


def learn(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> dict | None:
    return fit(*training_windows(docs, sample), landmarks)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs)).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
