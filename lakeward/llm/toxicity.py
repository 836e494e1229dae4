"""Toxicity by maximum-scoring segment search over token log-odds.

Method. Tokens are words and their first 4, 5 and 6 bytes (inflected forms
share a stem), hashed into ``BUCKETS`` buckets. Each token gets the log-odds
of toxic against clean labelled documents under an informative Dirichlet
prior from the whole corpus, less ``Z`` standard errors; a token whose bound
is above ``LEAST`` is evidence. A document's words score the best bound of their
tokens, or a small negative drift. One linear pass finds all maximal scoring
segments (Ruzzo and Tompa). The scale of the scores is calibrated by extreme
values: lambda solves E[exp(lambda s)] = 1 for the scores that half of the
training data gives to the clean words of the other half, so a segment of
score S in n words has E = n exp(-lambda S) chance equals. Every segment with
E < ``MAX_E`` is a toxic passage; the document's score is exp(-E) of its
passages' summed evidence.

What is learned. Labels come from at most about ``SAMPLE`` labelled rows per
class (all of them if fewer), chosen by a hash of doc_id; their size bounds
what is broadcast. Near copies among them share their votes (a group by the
smallest 5-word shingle hash counts once), and so do the rows of a doc_id: a
labelled document that stands in the table n times has n rows with 1 / n of
its vote and of its uses. Corpus counts are over all documents. The model has at most BUCKETS rows.

Edge cases. A null or empty text has no passage and score 0. Null ids and
null labels are not learned from; repeated labels of a document count once,
toxic if any says so. Without both classes nothing scores above 0. Repeated
rows are scored each; extra columns are ignored. A text of any length is
scanned whole, in pieces of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import textvec
from lakeward.llm.common import cut, filter_rows, is_held_out, is_train, table, take

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
SAMPLE = 50_000
Z = 1.6
#: Tokens with a smaller bound are no evidence: common words lean a little to one side by chance.
LEAST = 1.2
PRIOR = 0.5
MAX_E = 1.0
THRESHOLD = 0.7
MAX_LAMBDA = 4.0
#: Rows of a batch of counts.
ROWS_OUT = 1 << 16


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 20)).astype(np.int64)


def _lower(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower(F.coalesce("text", F.lit(""))))


def train_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic (0/1) of the labelled rows to learn from: about ``sample``
    rows of each class at most, by a hash of doc_id."""
    y = take(labels, "doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)").filter(is_train())
    y = y.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for value, n in counts.items():
        share = min(1.0, sample / n)
        part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))
        keep = keep | ((F.col("toxic") == value) & (part if share < 1 else F.lit(True)))
    return y.filter(keep)


def _signatures(batches):
    """doc_id, toxic, fold and the smallest 5-word shingle hash."""
    for batch in textvec.released(batches):
        data, offsets = textvec.utf8(batch.column("text"))
        hashes, at = textvec.word_hashes(data, offsets)
        low = np.zeros(len(at) - 1, np.int64)
        for i in range(len(at) - 1):
            s = textvec.shingles(hashes[at[i]:at[i + 1]], 5)
            low[i] = np.int64(s.min().astype(np.int64)) if len(s) else 0
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(low)], ["doc_id", "toxic", "signature"])


def _count(batches):
    """Per bucket: uses in all documents, and for each class and fold the
    weighted number of labelled documents that have it. The clean and toxic
    words are counted in the bucket -1."""
    uses = np.zeros(BUCKETS, np.float64)
    votes = np.zeros((4, BUCKETS), np.float64)
    total = np.zeros(5, np.float64)
    for batch in textvec.released(batches):
        data, offsets = textvec.utf8(batch.column("text"))
        toxic = np.asarray(batch.column("toxic").fill_null(-1))
        weight = np.asarray(batch.column("weight").fill_null(0.0))
        fold = np.asarray(batch.column("fold").fill_null(0))
        share = np.asarray(batch.column("share").fill_null(1.0)) if "share" in batch.schema.names else np.ones(batch.num_rows)
        # a text may go on in the next piece: what the last one has voted for
        last, voted = -1, np.zeros(BUCKETS, bool)
        for texts, _, hashes, heads in textvec.words_of(data, offsets, PREFIXES):
            part = share[texts]
            total[4] += part.sum()
            kinds = [hashes, *heads]
            for h in kinds:
                uses += np.bincount(_buckets(h[h != 0]), weights=part[h != 0], minlength=BUCKETS)
            labelled = toxic[texts] >= 0
            if not labelled.any():
                continue
            who = texts[labelled]
            keys = np.concatenate([(who[v != 0] * BUCKETS + _buckets(v[v != 0])) for v in (h[labelled] for h in kinds)])
            keys = np.unique(keys)
            doc, bucket = keys // BUCKETS, keys % BUCKETS
            new = (doc != last) | ~voted[bucket]
            doc, bucket = doc[new], bucket[new]
            if who[-1] != last:
                last = who[-1]
                voted[:] = False
            voted[bucket[doc == last]] = True
            cell = toxic[doc] * 2 + fold[doc]
            for c in range(4):
                pick = cell == c
                np.add.at(votes[c], bucket[pick], weight[doc[pick]])
            words = np.bincount(toxic[who] * 2 + fold[who], weights=weight[who], minlength=4)
            total[:4] += words
    names = ["bucket", "uses", "clean0", "clean1", "toxic0", "toxic1"]
    yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([total[4]]), *(pa.array([total[c]]) for c in range(4))], names)
    used = np.flatnonzero(uses)  # every vote is a use
    for lo in range(0, len(used), ROWS_OUT):
        some = used[lo:lo + ROWS_OUT]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(uses[some]), *(pa.array(votes[c][some]) for c in range(4))], names)


def token_counts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict]:
    """Counts per bucket, and totals (documents per class and fold)."""
    chosen = cut(train_labels(labels, sample), "tox-labels")
    d = take(docs, "doc_id", "text")
    # at most 2 * sample rows of 12 bytes
    known = _lower(d.join(F.broadcast(chosen), "doc_id"))
    signed = cut(known.select("doc_id", "toxic", "text").mapInArrow(_signatures, "doc_id long, toxic int, signature long"), "tox-signed")
    signed = signed.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("signature").alias("signature"), F.count(F.lit(1)).alias("rows"))
    groups = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    signed = signed.join(groups, "signature", "left").select(
        "doc_id", "toxic", (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("weight"), (F.lit(1.0) / F.col("rows")).alias("share"),
        F.pmod(F.xxhash64("signature", F.lit(3)), F.lit(2)).cast("int").alias("fold"))
    signed = cut(signed, "tox-weights")
    totals = {(r["toxic"], r["fold"]): r["n"] for r in signed.groupBy("toxic", "fold").agg(F.sum("weight").alias("n")).collect()}
    voted = _lower(d).join(F.broadcast(signed), "doc_id", "left").select("text", "toxic", (F.col("weight") * F.col("share")).alias("weight"), "fold", "share")
    parts = voted.mapInArrow(_count, "bucket long, uses double, clean0 double, clean1 double, toxic0 double, toxic1 double")
    sums = parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("uses", "clean0", "clean1", "toxic0", "toxic1")))
    return sums, totals


def log_odds_bound(toxic, n_toxic, clean, n_clean, prior, z=Z):
    """Log of the odds that a text with the token is toxic rather than clean,
    against the odds of any text, under the prior, less z standard errors."""
    odds = np.log((toxic + prior) / (n_toxic + 2 * prior)) - np.log((clean + prior) / (n_clean + 2 * prior))
    return odds - z * np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model: evidence (bucket -> score), drift and lambda."""
    sums, totals = token_counts(docs, labels, sample)
    sums = cut(sums, "tox-counts")
    n = {k: totals.get(k, 0.0) for k in ((0, 0), (0, 1), (1, 0), (1, 1))}
    empty = {"buckets": np.zeros(0, np.int64), "scores": np.zeros(0), "drift": 0.05, "lambda": 1.0}
    whole = sums.filter("bucket = -1").agg(*(F.sum(c).alias(c) for c in ("uses", "clean0", "clean1", "toxic0", "toxic1"))).first()
    if min(n[0, 0] + n[0, 1], n[1, 0] + n[1, 1]) <= 0 or not whole["uses"]:
        return empty
    # only buckets that lean to the toxic side can be evidence: at most BUCKETS rows
    rows = sums.filter(f"bucket >= 0 and (toxic0 + toxic1) * {n[0, 0] + n[0, 1]} > (clean0 + clean1) * {n[1, 0] + n[1, 1]}").toPandas()
    # the corpus frequency spreads PRIOR * BUCKETS pseudo-documents; rare tokens keep a floor
    prior = np.maximum(PRIOR, np.minimum(rows["uses"].to_numpy() / whole["uses"] * 1000.0, 50.0))
    t = [rows["toxic0"].to_numpy(), rows["toxic1"].to_numpy()]
    c = [rows["clean0"].to_numpy(), rows["clean1"].to_numpy()]
    scores = log_odds_bound(t[0] + t[1], n[1, 0] + n[1, 1], c[0] + c[1], n[0, 0] + n[0, 1], prior)
    good = scores > LEAST
    if not good.any():
        return empty
    clean_words, toxic_words = whole["clean0"] + whole["clean1"], whole["toxic0"] + whole["toxic1"]
    rate = float((t[0] + t[1])[good] @ scores[good]) / max(toxic_words, 1.0)
    drift = min(0.2, max(0.01, rate / 8))
    # what one fold's evidence scores on the clean words of the other fold
    high, mass = [], []
    for a, b in ((0, 1), (1, 0)):
        if min(n[0, a], n[1, a]) <= 0:
            continue
        s = log_odds_bound(t[a], n[1, a], c[a], n[0, a], prior)
        up = s > LEAST
        high.append(s[up])
        mass.append(c[b][up])
    high = np.concatenate([*high, [float(np.median(scores[good]))]])
    mass = np.concatenate([*mass, [1.0]])  # one chance use, so that lambda stays finite
    p = mass / max(clean_words, mass.sum() + 1.0)
    low, top = 0.0, MAX_LAMBDA
    for _ in range(60):
        mid = (low + top) / 2
        if float(p @ np.exp(mid * high)) + (1 - p.sum()) * np.exp(-mid * drift) < 1:
            low = mid
        else:
            top = mid
    return {"buckets": rows["bucket"].to_numpy()[good].astype(np.int64), "scores": scores[good], "drift": drift, "lambda": max(low, 1e-3)}


def maximal_segments(scores: list[float], gaps: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of positive ``scores`` (first, last, sum),
    where gaps[i] is the total cost between item i - 1 and item i. A linear
    scan: each candidate keeps the running sums at its left and right end
    and is merged leftwards while the total still grows."""
    stack: list[tuple[float, float, int, int]] = []
    run = 0.0
    for i, s in enumerate(scores):
        run -= gaps[i]
        left, right, first = run, run + s, i
        run = right
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j -= 1
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, i))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(f, l, right - left) for left, right, f, l in stack]


def _segment_list(at: np.ndarray, values: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    gaps = np.diff(at, prepend=at[0]) - 1
    gaps[0] = 0
    return maximal_segments(values.tolist(), (np.maximum(gaps, 0) * drift).tolist())


def _scanner(sent):
    """A function that gives, for each document of an Arrow string column,
    the number of words, the score and the passages."""
    m = sent.value
    score_of = np.zeros(BUCKETS, np.float32)
    score_of[m["buckets"]] = m["scores"]
    lam, drift = m["lambda"], m["drift"]

    def scan(column: pa.Array):
        data, offsets = textvec.utf8(column)
        n = len(offsets) - 1
        counts = np.zeros(n, np.int64)
        docs_at, where, what = [], [], []
        for texts, _, hashes, heads in textvec.words_of(data, offsets, PREFIXES):
            value = score_of[_buckets(hashes)]
            for h in heads:
                value = np.maximum(value, np.where(h != 0, score_of[_buckets(h)], 0))
            hit = np.flatnonzero(value)
            if len(hit):
                first = np.searchsorted(texts, texts[hit], "left")
                where.append(hit - first + counts[texts[hit]])
                docs_at.append(texts[hit])
                what.append(value[hit])
            counts += np.bincount(texts, minlength=n)
        result = np.zeros(n)
        found: list[list[dict]] = [[] for _ in range(n)]
        if where:
            owner, at, value = np.concatenate(docs_at), np.concatenate(where), np.concatenate(what).astype(np.float64)
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
            for lo, hi in zip(edges[:-1], edges[1:]):
                i = owner[lo]
                size = np.log(counts[i])
                evidence, best = 0.0, -np.inf
                for f, l, s in _segment_list(at[lo:hi], value[lo:hi], drift):
                    bits = lam * s - size
                    best = max(best, bits)
                    if bits > -np.log(MAX_E):
                        evidence += bits
                        found[i].append({"first": int(at[lo + f]), "last": int(at[lo + l]), "evidence": float(bits)})
                result[i] = np.exp(-np.exp(-np.clip(evidence or best, -700.0, 700.0)))
        return counts, result, found

    return scan


def passages(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: doc_id, n_words, score (0 to 1), n_passages and
    passages (first word, last word, evidence) with E < MAX_E."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS entries
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())]))

    def run(batches):
        scan = _scanner(sent)
        for batch in textvec.released(batches):
            counts, result, found = scan(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(result), pa.array([len(x) for x in found], pa.int32()), pa.array(found, kind)],
                ["doc_id", "n_words", "score", "n_passages", "passages"])

    return _lower(take(docs, "doc_id", "text")).mapInArrow(
        run, "doc_id long, n_words long, score double, n_passages int, passages array<struct<first:long,last:long,evidence:double>>")


def keep_clean(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged. Rows
    are judged where they are; nothing is joined."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep():
        scan = _scanner(sent)
        return lambda column: scan(column)[1] < threshold

    return filter_rows(docs, "text", lambda text: F.lower(F.coalesce(text, F.lit(""))), keep)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    scored = passages(docs, model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "n_words", "n_passages", "passages")
