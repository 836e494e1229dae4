"""Near-duplicates by Order MinHash, verified by banded alignment.

Method. A text's 5-word shingles are labelled with their occurrence number.
Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest labelled
shingles and keeps them in text order; two texts that agree in one sketch
are candidates. So are two texts of at most ``SHORT`` shingles that share one
of their first shingles in hash order: so many that two texts without a
common one must be below the threshold. Candidates are verified by aligning their labelled shingles
(the longest chain of common shingles in the same order, inside the band
that the threshold allows): similarity = aligned / (all shingles of both,
aligned ones once), at least ``THRESHOLD``. It equals the Jaccard
similarity of 5-word shingles for texts that keep their order.

Equal texts are one text. In each group of texts that share a sketch, every
member is compared with the group's leader (the text that shares most with
others), which joins groups of copies without making their pairs. Where a
group then still holds several classes, the members outside its largest
class are compared with the members of other classes, but for pairs that
exact bounds exclude: shingles that no other such text has, and shingles
behind a bit that only one text's bitmap sets, cannot be shared. So no two texts that share a sketch and could be
similar enough end in different classes uncompared; nothing is capped. Verified pairs are links, and the classes are the
connected components of the links, found by spreading the smallest label
with pointer jumping.

All steps are joins and partial sums over light rows (a 16-byte text id).
Texts move once, and only those with a candidate go on. Hot sketches, copies
and leaders are split by adaptive skew joins.

Edge cases. A null text is an empty one; empty texts are equal texts. A text
of fewer than five words has one shingle. Rows that repeat get the same
class; a null doc_id is allowed (it sorts last). Empty input gives no rows.
Extra columns are ignored. Class ids are the smallest doc_id of the class.
"""

from __future__ import annotations

from bisect import bisect_left
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm import textvec
from lakeward.llm.common import cut, table, take

SHINGLE = 5
SKETCHES = 24
PICKED = 4
THRESHOLD = 0.8
#: Texts of at most so many shingles that are similar enough always share a key.
SHORT = 20
#: A text's shingles as a bitmap of so many 64-bit words.
BITMAP = 16

_rng = np.random.default_rng(20240501)
_FACTORS = (_rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_SALTS = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)
_COMBINE = np.uint64(0x9E3779B97F4A7C15)


def labelled_shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of a text's (shingle, occurrence number), in text order."""
    s = textvec.shingles(hashes, SHINGLE)
    if len(s) < 2:
        return s
    seen = textvec.occurrences(s)
    if not seen.any():
        return s
    return np.where(seen > 0, textvec.mix(s + seen.astype(np.uint64) * _COMBINE), s)


def sketches(labelled: np.ndarray) -> np.ndarray:
    """The order-min-hash keys of a text."""
    n = len(labelled)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(PICKED, n)
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 20) // n)  # a very long text takes its sketches in turn
    for lo in range(0, SKETCHES, step):
        h = labelled[None, :] * _FACTORS[lo:lo + step]
        h ^= h >> np.uint64(29)
        at = np.argpartition(h, k - 1, axis=1)[:, :k] if n > k else np.tile(np.arange(n), (len(h), 1))
        picked = labelled[np.sort(at, axis=1)]
        key = _SALTS[lo:lo + step].copy()
        for j in range(k):
            key = key * _COMBINE + picked[:, j]
        out[lo:lo + step] = textvec.mix(key)
    return out


def short_keys(labelled: np.ndarray) -> np.ndarray:
    """A key for each of the first shingles in hash order of a text of at most
    SHORT shingles. Of n shingles a similar text has at least p n / q, so one of
    any n - ceil(p n / q) + 1 is shared, and the first shared one is among the
    first of both."""
    n = len(labelled)
    if not 0 < n <= SHORT:
        return np.zeros(0, np.uint64)
    p, q = ratio()
    return textvec.mix(np.sort(labelled)[:n + -p * n // q + 1] ^ _COMBINE)


def ratio(threshold: float = THRESHOLD) -> tuple[int, int]:
    """The threshold as a ratio of whole numbers, so that bounds are exact."""
    return Fraction(str(threshold)).as_integer_ratio()


def enough(shared: Column, total: Column) -> Column:
    """True where texts of ``total`` shingles, ``shared`` of them in both, reach the threshold."""
    p, q = ratio()
    return shared * F.lit(p + q).cast("long") >= total * F.lit(p).cast("long")


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Aligned share of two labelled shingle sequences; 0 where an upper
    bound already shows that it is below ``threshold``."""
    na, nb = len(a), len(b)
    if not na or not nb:
        return 1.0 if na == nb else 0.0
    p, q = ratio(threshold)
    least = -(-p * (na + nb) // (p + q))  # aligned shingles that the threshold needs
    if min(na, nb) < least:
        return 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(ia) < least:
        return 0.0
    band = na + nb - 2 * least  # more shift would leave too many unaligned
    near = np.abs(ia - ib) <= band
    ia, ib = ia[near], ib[near]
    chain: list[int] = []
    for v in ib[np.argsort(ia)].tolist():
        if not chain or v > chain[-1]:
            chain.append(v)
        else:
            chain[bisect_left(chain, v)] = v
    return len(chain) / (na + nb - len(chain))


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _hash_texts(batches, emit):
    for batch in textvec.released(batches):
        data, offsets = textvec.utf8(batch.column("text"))
        hashes, at = textvec.word_hashes(data, offsets)
        yield emit(batch, [labelled_shingles(hashes[at[i]:at[i + 1]]) for i in range(len(at) - 1)])


def _sketch_rows(batches):
    def emit(batch, shingled):
        keys = pa.array([np.concatenate([sketches(s), short_keys(s)]).astype(np.int64) for s in shingled], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("uid"), keys], ["doc_id", "uid", "keys"])
    yield from _hash_texts(batches, emit)


def bitmap(labelled: np.ndarray) -> np.ndarray:
    """The shingles hashed to BITMAP * 64 bits. A bit that one text sets and
    another does not stands for a shingle that only the first has."""
    flags = np.zeros(BITMAP * 64, np.uint8)
    flags[(labelled >> np.uint64(20)) % np.uint64(BITMAP * 64)] = 1
    return np.packbits(flags).view(np.int64)


def _shingle_rows(batches):
    def emit(batch, shingled):
        return pa.RecordBatch.from_arrays([batch.column("uid"), pa.array([s.view(np.int64) for s in shingled], pa.list_(pa.int64())),
                                           pa.array([bitmap(s) for s in shingled], pa.list_(pa.int64()))], ["uid", "seq", "bits"])
    yield from _hash_texts(batches, emit)


def _verify(batches):
    for batch in textvec.released(batches):
        a, b = batch.column("seq_a"), batch.column("seq_b")
        keep = [similarity(a[i].values.to_numpy().view(np.uint64), b[i].values.to_numpy().view(np.uint64)) >= THRESHOLD
                for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])


def _lower(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.lower("text"))


def _verified(pairs: DataFrame, seqs: DataFrame, name: str) -> DataFrame:
    """a, b, linked of the distinct ``pairs`` (a, b)."""
    sides = pairs.join(seqs.select(F.col("uid").alias("a"), F.col("seq").alias("seq_a")), "a")
    sides = sides.join(seqs.select(F.col("uid").alias("b"), F.col("seq").alias("seq_b")), "b")
    return cut(sides.select("a", "b", "seq_a", "seq_b").mapInArrow(_verify, "a binary, b binary, linked boolean"), name)


def links(texts: DataFrame, keyed: DataFrame) -> DataFrame:
    """Verified pairs (a, b) of different texts that join all classes: any two
    texts of a group that end in different classes have been compared.
    ``texts`` has uid, text (rows may repeat); ``keyed`` has one row per
    text: uid, label, keys."""
    sk = keyed.select("uid", F.explode("keys").alias("key"))
    shared = sk.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = cut(sk.join(shared.hint("merge"), "key").select("key", "uid", "n"), "nd-members")
    mass = members.groupBy("uid").agg(F.sum("n").alias("mass"))
    one = texts.join(mass.select("uid"), "uid", "left_semi").groupBy("uid").agg(F.first("text").alias("text"))
    seqs = cut(_lower(one).mapInArrow(_shingle_rows, "uid binary, seq array<long>, bits array<long>"), "nd-seqs")
    # every member with the leader of its group
    best = members.join(mass, "uid").groupBy("key").agg(F.max(F.struct("mass", "uid")).alias("best"))
    leaders = best.select("key", F.col("best.uid").alias("leader"))
    met = members.join(leaders.hint("merge"), "key").filter(F.col("uid") != F.col("leader"))
    pairs = met.select(F.least("uid", "leader").alias("a"), F.greatest("uid", "leader").alias("b")).distinct()
    first = _verified(pairs, seqs, "nd-led")
    # groups that hold several classes by now: the members outside the group's largest class meet those of other classes
    classes = components(first.filter("linked").select("a", "b"), keyed.select("uid", "label"))
    classes = classes.select(F.col("uid").alias("c_uid"), F.col("label.root").alias("root"))
    of = members.join(classes.hint("merge"), F.col("uid") == F.col("c_uid"), "left").select("key", "uid", F.coalesce("root", "uid").alias("root"))
    of = cut(of, "nd-classed")
    sizes = of.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("largest"), F.count(F.lit(1)).alias("classes"))
    several = largest.filter("classes > 1").select("key", F.col("largest.root").alias("main"))
    mixed = cut(of.join(several, "key"), "nd-mixed")
    # exact bounds on what two texts can share: no shingle that no other of these texts has, and
    # none behind a bit that the other text's bitmap lacks
    of_mixed = seqs.join(mixed.select("uid").distinct(), "uid", "left_semi")
    once = of_mixed.select("uid", F.explode("seq").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"))
    own = once.filter("n = 1").groupBy("uid").agg(F.count(F.lit(1)).alias("own"))
    words = [f"w{i}" for i in range(BITMAP)]
    room = of_mixed.join(own, "uid", "left").select("uid", F.size("seq").alias("n"), (F.size("seq") - F.coalesce("own", F.lit(0))).alias("common"),
                                                    *(F.col("bits")[i].alias(w) for i, w in enumerate(words)))
    mixed = mixed.join(room.filter(enough(F.col("common"), F.col("common") + F.col("n"))), "uid")
    minor = mixed.filter(F.col("root") != F.col("main")).select(*(F.col(c).alias("m_" + c) for c in ["key", "uid", "root", "n", "common", *words]))
    lacks = sum((F.bit_count(F.col(w).bitwiseAND(F.bitwise_not(F.col("m_" + w)))) for w in words), F.lit(0))
    m_lacks = sum((F.bit_count(F.col("m_" + w).bitwiseAND(F.bitwise_not(F.col(w)))) for w in words), F.lit(0))
    most = F.least(F.col("common"), F.col("m_common"), F.col("n") - lacks, F.col("m_n") - m_lacks)
    cross = mixed.join(minor.hint("merge"), (F.col("key") == F.col("m_key")) & (F.col("root") != F.col("m_root"))
                       & enough(most, F.col("n") + F.col("m_n")))
    pairs = cross.select(F.least("uid", "m_uid").alias("a"), F.greatest("uid", "m_uid").alias("b")).distinct()
    second = _verified(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), seqs, "nd-crossed")
    return first.unionByName(second).filter("linked").select("a", "b")


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """uid, label of every text in ``edges`` (a, b): the smallest label of its
    component. ``labels`` gives the first label of each uid."""
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "nd-edges")
    nodes = both.select(F.col("a").alias("uid")).distinct()
    # the label carries the uid of the text it comes from, for pointer jumping
    now = cut(nodes.join(labels, "uid").select("uid", F.struct("label", F.col("uid").alias("root")).alias("label")), "nd-labels")
    while True:
        beside = both.join(now, both["b"] == now["uid"]).groupBy("a").agg(F.min("label").alias("beside"))
        step = now.join(beside, now["uid"] == beside["a"]).select("uid", "label", F.least("label", "beside").alias("new"))
        ahead = now.select(F.col("uid").alias("j_uid"), F.col("label").alias("jump"))
        step = step.join(ahead, step["new.root"] == ahead["j_uid"]).select("uid", "label", F.least("new", "jump").alias("new"))
        step = cut(step, "nd-labels")
        if step.filter(F.col("new") != F.col("label")).isEmpty():
            return step.select("uid", F.col("new").alias("label"))
        now = step.select("uid", F.col("new").alias("label"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class),
    text_id, links (verified links of its text), kept (true for the document
    of class_id, which stands for the class)."""
    d = take(docs, "doc_id", "text").withColumn("uid", text_id(F.col("text")))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), "uid", F.coalesce("text", F.lit("")).alias("text"))
    rows = cut(_lower(d).mapInArrow(_sketch_rows, "doc_id long, uid binary, keys array<long>"), "nd-sketches")
    # equal texts are one; a null doc_id sorts last
    last = F.lit((1 << 63) - 1)
    texts = rows.groupBy("uid").agg(F.min(F.coalesce("doc_id", last)).alias("label"), F.first("keys").alias("keys"))
    texts = cut(texts, "nd-texts")
    edges = cut(links(d.select("uid", "text"), texts), "nd-links")
    labels = components(edges, texts.select("uid", "label"))
    degree = edges.select(F.explode(F.array("a", "b")).alias("uid")).groupBy("uid").agg(F.count(F.lit(1)).alias("links"))
    found = labels.join(degree, "uid").select(F.col("uid").alias("f_uid"), F.col("label").alias("f_label"), "links")
    own = texts.select(F.col("uid").alias("o_uid"), F.struct("label", F.col("uid").alias("root")).alias("own"))
    of_text = own.join(found, F.col("o_uid") == F.col("f_uid"), "left").select(
        F.col("o_uid"), F.coalesce("f_label", "own").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    out = rows.select("doc_id", "uid").join(of_text, F.col("uid") == F.col("o_uid"))
    class_id = F.when(F.col("class.label") != last, F.col("class.label"))
    return out.select("doc_id", class_id.alias("class_id"), F.lower(F.hex("uid")).alias("text_id"), F.col("links").cast("long").alias("links"),
                      ((F.col("class.root") == F.col("uid")) & F.col("doc_id").eqNullSafe(class_id)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each class: the one of the class's
    smallest doc_id, whole (ties among equal rows: any one of them)."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    found = near_duplicates(docs).filter("kept")
    keep = found.select(F.col("text_id").alias("k_text"), F.col("doc_id").alias("k_doc")).distinct()
    d = take(docs, *columns).withColumn("text_id", F.lower(F.hex(text_id(F.col("text")))))
    d = d.join(keep, (F.col("text_id") == F.col("k_text")) & F.col("doc_id").cast("long").eqNullSafe(F.col("k_doc")), "left_semi")
    # a document that is there twice stays once
    first = W.partitionBy("text_id", "doc_id").orderBy("lang", "source", "n_chars")
    return d.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select(*columns)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
