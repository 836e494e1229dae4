"""Mixing sources to target weights, with DataFrame functions only.

Method. The words of each source are laid end to end (documents in a hash
order) and cut into blocks of ``block`` words, or fewer for a small source:
a 64th of its words, one at least, so that a source has 64 blocks or blocks
of one word, and rounding to whole blocks stays small against every target.
A source with target share
t of its words gets round(t * blocks) slots. The slots of all sources are
dealt to output shards by one pseudorandom permutation of the slot numbers:
the counts that a shard gets from each source are multinomial draws
conditioned on the totals, so the totals are met exactly instead of within
sampling noise. Slot t of a source stands for epoch t // blocks and place
t % blocks of that epoch; a permutation of the source's block indices for
that epoch gives the block, so each block is taken floor or ceil of
slots / blocks times. Slots and blocks are then joined by (source, block).

Nothing depends on the partitioning: a rerun gives the same rows.

Edge cases. A null text has size 0 and takes part; a null source is a
source of its own, ranked last. A source without words has target 0. Rows
that repeat are separate documents (told apart by a running number within
equal (source, doc_id, size)). Empty input gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeward.llm.common import cut, table, take

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
BLOCK = 64
SHARD_SLOTS = 1024
ROWS_PER_BUCKET = 10_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source (null kept), size in words of each row."""
    d = take(docs, "doc_id", "text", "source")
    return d.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, n_docs, weight, target.

    Targets are the weighted shares of ``total_share`` of all words, held at
    ``max_epochs`` times the source's size; what is above goes to the others
    by weight. The fixed point is min(cap, level * weight): sources in the
    order of cap / weight are held while their cap is below the level that
    the remaining words give. Works on one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_rank = W.orderBy(F.col("source").asc_nulls_last())
    list_of = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("weight", F.element_at(list_of, ((F.row_number().over(by_rank) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size").cast("double") * F.lit(float(max_epochs)))
    everything = W.partitionBy()
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    level = ((F.sum(F.col("source_size").cast("double")).over(everything) * F.lit(total_share)
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    per = per.withColumn("level", level).withColumn("held", F.col("cap") <= F.col("level") * F.col("weight"))
    # the level of the first source that is not held is the level of all that follow
    final = F.min(F.when(~F.col("held"), F.struct((F.col("cap") / F.col("weight")).alias("k"), F.col("level").alias("level")))).over(everything)
    per = per.withColumn("open", final["level"])
    return per.select("source", "source_size", "n_docs", "weight",
                      F.when(F.col("held"), F.col("cap")).otherwise(F.least("cap", F.col("open") * F.col("weight"))).alias("target"))


ROUNDS = 4


def domain(df: DataFrame, name: str, n: Column, key: Column) -> DataFrame:
    """Adds ``name``: a permutation of 0 .. n - 1 chosen by ``key``, as the
    numbers that ``permute`` needs."""
    one = F.lit(1).cast("long")
    df = df.withColumns({"_n": n.cast("long"), "_key": key})
    df = df.withColumn("_bits", F.greatest(F.floor(F.log2(F.col("_n").cast("double") + F.lit(0.5))).cast("int"), F.lit(0)))
    df = df.withColumn("_half", F.floor(F.col("_bits") / F.lit(2)).cast("int"))
    half = F.col("_half")
    numbers = {"n": F.col("_n"), "key": F.col("_key"), "top": F.call_function("shiftleft", one, F.col("_bits")), "half": half,
               "low": F.call_function("shiftleft", one, half) - one,
               "high": F.call_function("shiftleft", one, F.col("_bits") - half) - one}
    numbers |= {f"turn{r}": F.pmod(F.xxhash64("_key", F.lit(1000 + r)), F.col("_n")) for r in range(ROUNDS)}
    return df.withColumns({f"{name}_{k}": v for k, v in numbers.items()}).drop("_n", "_key", "_bits", "_half")


def permute(df: DataFrame, out: str, index: Column, of: str) -> DataFrame:
    """Adds ``out``: where the permutation ``of`` (see ``domain``) sends ``index``.

    Each round is a bijection: among the numbers below the largest power of
    two <= n, one half of the bits is xored with a hash of the other (a
    Feistel step), then all numbers are rotated by a keyed offset."""
    n, key, top, half, low, high = (F.col(f"{of}_{k}") for k in ("n", "key", "top", "half", "low", "high"))
    df = df.withColumn("_x", index.cast("long"))
    x = F.col("_x")
    for r in range(ROUNDS):
        if r % 2 == 0:
            flip = F.xxhash64(F.call_function("shiftright", x, half), key).bitwiseAND(low)
        else:
            flip = F.call_function("shiftleft", F.xxhash64(x.bitwiseAND(low), key).bitwiseAND(high), half)
        df = df.withColumn("_x", F.when(x < top, x.bitwiseXOR(flip)).otherwise(x) + F.col(f"{of}_turn{r}"))
        df = df.withColumn("_x", F.when(x >= n, x - n).otherwise(x))
    # not null, so that no filter on it is inferred and inlined through the rounds
    return df.withColumn(out, F.coalesce(x, F.lit(0).cast("long"))).drop("_x")


def document_spans(sized: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds nth (a number within the source), start (words of the source before the document) and
    source_size to rows of doc_id, source, size.

    The order within a source is (bucket, hash, doc_id, size). The running
    sum is taken within buckets of a source, and the buckets' own sums are
    added up apart, so a source with a third of all rows is spread over
    many tasks; the number of buckets grows with the rows."""
    n = sized.count()
    buckets = max(64, -(-n // rows_per_bucket))
    d = sized.withColumn("h", F.xxhash64("doc_id", "size"))
    d = d.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"),
                       F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base_rows"),
                       F.sum("words").over(W.partitionBy("source")).alias("source_size"))
    d = d.withColumn("within", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size"))
    d = d.withColumn("nth", F.row_number().over(inside))
    d = d.join(base, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    return d.select("doc_id", "source", "size", "source_size", (F.col("base") + F.col("within")).alias("start"),
                    (F.col("base_rows") + F.col("nth")).alias("nth"))


def block_words(source_size: Column, block: int) -> Column:
    """Words in a block of a source: ``block``, or a 64th of a smaller source."""
    return F.greatest(F.least(F.floor(source_size / F.lit(64)), F.lit(block)), F.lit(1)).cast("long")


def slots(targets: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """One row per slot of the mix: shard, place, source, epoch, block."""
    per = targets.filter(F.col("source_size") > 0).withColumn("blocks", F.ceil(F.col("source_size") / block_words(F.col("source_size"), block)))
    per = per.withColumn("n_slots", F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("first", F.sum("n_slots").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_slots"))
    per = per.withColumn("all_slots", F.sum("n_slots").over(W.partitionBy()))
    per = per.filter(F.col("n_slots") > 0)
    per = per.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / F.col("blocks")))))
    per = per.withColumn("epoch_slots", F.least(F.col("blocks"), F.col("n_slots") - F.col("epoch") * F.col("blocks")))
    step = 1 << 14  # the slots of an epoch are made in runs of this length, dealt over the tasks
    runs = per.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("epoch_slots") - 1) / F.lit(step)))))
    # the deal of all slots to shards, and the epoch's own order of the source's blocks
    runs = domain(runs, "deal", F.col("all_slots"), F.lit(seed).cast("long"))
    runs = domain(runs, "own", F.col("blocks"), F.xxhash64(F.lit(seed), F.col("source"), F.col("epoch")))
    runs = runs.repartition(F.col("source"), F.col("epoch"), F.col("run"))
    each = runs.withColumn("t", F.explode(F.sequence(
        F.col("run") * F.lit(step), F.least(F.col("epoch_slots"), (F.col("run") + 1) * F.lit(step)) - 1)))
    each = permute(each, "at", F.col("first") + F.col("epoch") * F.col("blocks") + F.col("t"), "deal")
    each = permute(each, "block", F.col("t"), "own")
    return each.select(F.floor(F.col("at") / F.lit(shard_slots)).cast("long").alias("shard"),
                       F.pmod(F.col("at"), F.lit(shard_slots)).cast("int").alias("place"),
                       "source", F.col("epoch").cast("int").alias("epoch"), "block")


def block_pieces(spans: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and block that it touches: the words
    [lo, hi) of the document that lie in the block."""
    b = block_words(F.col("source_size"), block)
    p = spans.filter(F.col("size") > 0).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))))
    lo = F.greatest(F.col("block") * b - F.col("start"), F.lit(0).cast("long"))
    hi = F.least((F.col("block") + 1) * b - F.col("start"), F.col("size"))
    return p.select("source", "block", "doc_id", "nth", lo.alias("lo"), hi.alias("hi"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
                max_epochs: int = MAX_EPOCHS, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0):
    """The mix as three relations: spans of documents (with target), slots,
    and taken pieces (source, nth, doc_id, epoch, shard, place, lo, hi)."""
    sized = cut(sizes(docs), "mix-sizes")
    targets = cut(source_targets(sized, weights, total_share, max_epochs), "mix-targets")
    spans = cut(document_spans(sized), "mix-spans")
    dealt = slots(targets, block, shard_slots, seed)
    at = dealt.select(F.col("source").alias("s_source"), F.col("block").alias("s_block"), "shard", "place", "epoch")
    parts = block_pieces(spans, block)
    # explode hides the size of both sides from the planner: never broadcast either
    taken = parts.join(at.hint("merge"), parts["source"].eqNullSafe(at["s_source"]) & (parts["block"] == at["s_block"]))
    return spans, targets, taken.select("source", "nth", "doc_id", "epoch", "shard", "place", "lo", "hi")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, n_pieces of every document."""
    spans, targets, taken = mix_sources(docs, **options)
    per = taken.groupBy("source", "nth").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"), F.count(F.lit(1)).alias("n_pieces"))
    per = per.select(F.col("source").alias("p_source"), F.col("nth").alias("p_nth"), "taken", "n_pieces")
    of = targets.select(F.col("source").alias("t_source"), "target")
    rows = spans.join(per.hint("merge"), spans["source"].eqNullSafe(per["p_source"]) & (spans["nth"] == per["p_nth"]), "left")
    rows = rows.join(of, rows["source"].eqNullSafe(of["t_source"]))
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                       F.coalesce("n_pieces", F.lit(0)).cast("long").alias("n_pieces"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``documents``: one row for each document and epoch
    in which any of its words are taken, with the taken words (and the white
    space that follows each) in text order, and their n_chars."""
    d = take(docs, "doc_id", "text", "lang", "source")
    spans, _, taken = mix_sources(docs, **options)
    per = taken.groupBy("source", "nth", "doc_id", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs"), F.sum(F.col("hi") - F.col("lo")).alias("words"))
    # the same running number as in document_spans tells repeated rows apart
    numbered = spans.select(F.col("source").alias("n_source"), F.col("doc_id").alias("n_doc_id"), F.col("nth").alias("n_nth"),
                            F.row_number().over(W.partitionBy("source", "doc_id", "size").orderBy("nth")).alias("n_copy"),
                            F.col("size").alias("n_size"))
    per = per.join(numbered.hint("merge"), per["source"].eqNullSafe(F.col("n_source")) & (per["nth"] == F.col("n_nth")))
    per = per.select("n_source", "n_doc_id", "n_copy", "n_size", "epoch", "runs", "words")
    d = d.withColumn("size", F.regexp_count("text", F.lit(WORD)).cast("long"))
    repeated = spans.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():  # no text need be sorted to tell equal rows apart
        d = d.withColumn("copy", F.lit(1))
    else:
        d = d.withColumn("copy", F.row_number().over(W.partitionBy("source", "doc_id", "size").orderBy(F.xxhash64("text", "lang"))))
    rows = d.join(per.hint("merge"), d["source"].eqNullSafe(F.col("n_source")) & d["doc_id"].eqNullSafe(F.col("n_doc_id"))
                  & (d["size"] == F.col("n_size")) & (d["copy"] == F.col("n_copy")))
    with_space = F.regexp_extract_all("text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    picked = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(
        F.col("pieces"), (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))), "")
    # a text is split once: the generator's column cannot be inlined into the lambda below, which would split it for every run
    rows = rows.select("*", F.explode(F.array(F.when(F.col("words") < F.col("size"), with_space))).alias("pieces"))
    text = F.when(F.col("words") < F.col("size"), picked).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"), "lang", "source").select(
        "doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))
