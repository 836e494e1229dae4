"""Byte-level BPE encoding and decoding through a distinct-word table.

Method. Texts are split into the words (pre-tokens) of the vocabulary's
byte-level pre-tokenizer. A block of neighbouring texts becomes a list of its
distinct words and, for every place, the number of the word there. The
distinct words of all blocks make one table, in which each word is encoded
once, wherever and however often it occurs; a join on the word brings its
ids back to the blocks that have it, where they are laid out by place.
Decoding joins the distinct ids of some neighbouring rows to the table of
pieces (the bytes of each id) and puts the pieces in the order of the ids.

Words are told apart by their bytes (Arrow dictionaries), not by hashes.
The classes of characters (letter, number, white space, other) come from the
tokenizer itself, which is asked once about every code point, so they agree
with it whatever its Unicode version. An occurrence of a special token's
string is one word, with that token's id.

Sizes. A block has about ``BLOCK_BYTES`` bytes of text, or one longer text;
what is grouped per block is at most its distinct words. The number of rows
of a word in the join is the number of blocks that hold it. The table of
pieces has one row per vocabulary entry and is broadcast; so are the
vocabulary file's bytes, which workers need no copy of.

Lost executors. The documents are split twice (once for the words, once for
the numbers of the places), which needs the same rows in the same order, as
a scan of stored files gives them. Each block carries a checksum of its text,
which the pieces of its ids must meet; a source whose order changed between
the two stops the job instead of giving wrong ids. Write such a source first.

Edge cases. A null or empty text has no ids and decodes to an empty text.
Texts of any length are split whole, in parts that end before white space.
Rows that repeat (also with one doc_id, or a null one) give a row each. Ids
that no piece has decode to nothing; bytes that are no UTF-8 decode to
U+FFFD. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.llm import textvec
from lakeward.llm.common import table, take
from lakeward.llm.packing import byte_alphabet, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 1 << 17
PART_CHARS = 1 << 19
#: Rows of the word join that a task bundles at once.
BUNDLE_ROWS = 1 << 20
#: A place is a partition, a block in it and a word number in that.
BLOCK_BITS, NUMBER_BITS = 10, 32

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


def plain_tokenizer(config: bytes):
    """The tokenizer of a vocabulary file, without truncation and padding."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(config.decode())
    t.no_truncation()
    t.no_padding()
    return t


def character_classes(tokenizer) -> np.ndarray:
    """The class of every code point, as the pre-tokenizer takes it: a
    character joins the run of a letter, a digit or a mark before it, or it
    is white space."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, _SPACE, np.uint8)
    for lo in range(0, 0x110000, 1 << 9):
        codes = [c for c in range(lo, lo + (1 << 9)) if not 0xD800 <= c < 0xE000]
        # "\na?\n1?\n!?" for each code point: the run that ends after it tells its class
        text = "".join(f"\na{c}\n1{c}\n!{c}" for c in map(chr, codes))
        begins = {b for _, (b, _) in split(text)}
        for i, c in enumerate(codes):
            for j, kind in enumerate((_LETTER, _NUMBER, _OTHER)):
                if 9 * i + 3 * j + 2 not in begins:
                    kinds[c] = kind
    return kinds


class Splitter:
    """Cuts texts into the words of the byte-level pre-tokenizer."""

    def __init__(self, kinds: np.ndarray, specials: list[str]):
        self.kinds, self.specials = kinds, specials

    def _starts(self, cp: np.ndarray, fence: np.ndarray) -> np.ndarray:
        """Marks the first code point of every word; ``fence`` marks places
        where a word must start (first of a text, borders of special tokens)."""
        n = len(cp)
        kind = self.kinds[cp]
        edge = fence.copy()
        edge[0] = True
        edge[1:] |= kind[1:] != kind[:-1]
        space = kind == _SPACE
        # the last white space of a run before a word stands alone, or leads the word if it is a blank
        before = np.flatnonzero(space[:-1] & ~space[1:] & ~fence[1:])
        edge[before] = True
        edge[before[cp[before] == 0x20] + 1] = False
        # 's 't 'm 'd 're 've 'll end a word of their own where an apostrophe starts one
        for i in np.flatnonzero((cp == 0x27) & edge).tolist():
            room = n - i if (f := fence[i + 1:i + 4]).sum() == 0 else int(np.argmax(f)) + 1
            after = "".join(map(chr, cp[i + 1:i + min(3, room)].tolist()))
            size = 2 if after[:1] in ("s", "t", "m", "d") and after else 3 if after in ("re", "ve", "ll") else 0
            if size:
                edge[i + 1:i + size] = False
                if i + size < n:
                    edge[i + size] = True
                    # a blank after it leads the next word as before
        return np.flatnonzero(edge)

    def word_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte offsets where words start, over all texts of the buffer."""
        found = []
        for lo, hi in self._parts(data, offsets):
            raw = data[lo:hi].tobytes()
            cp = np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
            width = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
            at = np.cumsum(width) - width
            fence = np.zeros(len(cp), bool)
            inner = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
            fence[np.searchsorted(at, inner)] = True
            whole = []
            for s in self.specials:
                mark, from_ = s.encode(), 0
                while (p := raw.find(mark, from_)) >= 0:
                    from_ = p + len(mark)
                    if not np.any((inner > p) & (inner < from_)):
                        whole.append((p, from_))
            ends = []
            for p, q in whole:
                i, j = np.searchsorted(at, p), np.searchsorted(at, q)
                fence[i] = True
                if j < len(cp):
                    fence[j] = True
                ends.append((i, j))
            starts = self._starts(cp, fence)
            for i, j in ends:
                starts = starts[(starts <= i) | (starts >= j)]
            found.append((at[starts] + lo).astype(np.int32 if len(data) < 1 << 31 else np.int64))
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def _parts(self, data: np.ndarray, offsets: np.ndarray):
        """Spans of about PART_CHARS bytes that end with a text, or where an
        ASCII letter or digit is followed by white space."""
        lo, n = 0, len(data)
        word = np.zeros(256, bool)
        word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        while lo < n:
            hi = lo + PART_CHARS
            if hi >= n:
                yield lo, n
                return
            k = np.searchsorted(offsets, hi)
            stop = int(offsets[k])  # the next end of a text
            while hi < stop:
                some = data[hi - 1:min(stop, hi + PART_CHARS)]
                gap = np.flatnonzero(word[some[:-1]] & ((some[1:] == 0x20) | (some[1:] == 0x0A)))
                if len(gap):
                    hi += int(gap[0])
                    break
                hi += PART_CHARS
            hi = min(hi, stop)
            yield lo, hi
            lo = hi


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers as deflated byte planes: the most frequent words have the
    smallest numbers, so the upper planes are almost empty."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_numbers(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word its number, and the distinct words by number, the most
    frequent first."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    at = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(at, minlength=len(coded.dictionary)), kind="stable").astype(np.int32)
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return rank[at], coded.dictionary.take(pa.array(order))


class Blocks:
    """Collects rows until they are a block's worth of text."""

    def __init__(self, limit: int = BLOCK_BYTES):
        self.limit = limit
        self.next = TaskContext.get().partitionId() << BLOCK_BITS
        self.held, self.size = [], 0

    def add(self, batch: pa.RecordBatch):
        texts = pc.fill_null(batch.column("text"), "")
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        lo = 0
        while lo < len(sizes):
            room = self.limit - self.size
            hi = lo + max(1 if not self.held else 0, int(np.searchsorted(np.cumsum(sizes[lo:]), room, "right")))
            hi = min(hi, lo + BLOCK_ROWS)
            if hi > lo:
                self.held.append((batch.column("doc_id").slice(lo, hi - lo), texts.slice(lo, hi - lo)))
                self.size += int(sizes[lo:hi].sum())
            if hi < len(sizes):
                yield from self.flush()
            lo = hi

    def flush(self):
        if self.held:
            ids = pa.concat_arrays([d for d, _ in self.held])
            texts = pa.concat_arrays([t.cast(pa.large_string()) for _, t in self.held])
            self.held, self.size = [], 0
            yield self.next, ids, texts
            self.next += 1
            if not self.next % (1 << BLOCK_BITS):
                raise RuntimeError(f"more than {1 << BLOCK_BITS} blocks in a partition; use more partitions or larger blocks")


def _blocks(batches, limit):
    blocks = Blocks(limit)
    for batch in textvec.released(batches):
        yield from blocks.add(batch)
    yield from blocks.flush()


def _words(splitter, texts):
    """The bytes and text offsets of a block, its words in order and where each starts."""
    data, offsets = textvec.utf8(texts)
    starts = splitter.word_starts(data, offsets)
    kind = pa.StringArray if starts.dtype == np.int32 else pa.LargeStringArray
    ends = np.append(starts, np.array(len(data), starts.dtype))
    return data, offsets, starts, kind.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))


def _word_rows(sent, limit):
    def run(batches):
        splitter = Splitter(*sent.value)
        for block, _, texts in _blocks(batches, limit):
            _, distinct = numbered(_words(splitter, texts)[3])
            for lo in range(0, len(distinct), 1 << 16):
                some = distinct.slice(lo, 1 << 16).cast(pa.string())
                yield pa.RecordBatch.from_arrays([some, pa.array((block << NUMBER_BITS) + np.arange(lo, lo + len(some)))], ["word", "place"])
    return run


def _body_rows(sent, limit):
    def run(batches):
        splitter = Splitter(*sent.value)
        for block, ids, texts in _blocks(batches, limit):
            data, offsets, starts, words = _words(splitter, texts)
            ends = np.searchsorted(starts, offsets.astype(starts.dtype))
            del starts
            numbers, distinct = numbered(words)
            parts = [pack_numbers(numbers[ends[lo]:ends[hi]]) for lo, hi in text_groups(ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(ends).astype("<i8").tobytes()], pa.binary()),
                 pa.array([parts], pa.list_(pa.binary())), pa.array([len(distinct)]), pa.array([zlib.crc32(data)])],
                ["block", "doc_ids", "counts", "numbers", "n_distinct", "checksum"])
            del data, offsets, words, numbers, distinct
    return run


def text_groups(ends: np.ndarray):
    """Spans of whole texts with about PART_CHARS words, one longer text alone."""
    lo = 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PART_CHARS, "right")) - 1)
        yield lo, hi
        lo = hi


def _encode_words(sent):
    def run(batches):
        config, kind = sent.value
        tokenizer = plain_tokenizer(config)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        model, alphabet = tokenizer.model, {b: c for b, c in enumerate(byte_alphabet())}
        for batch in textvec.released(batches):
            blobs = []
            for word in batch.column("word").to_pylist():
                if word in special:
                    ids = [special[word]]
                else:
                    ids = [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(alphabet))]
                blobs.append(np.array(ids, kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(blobs, pa.binary())], ["word", "ids"])
    return run


def _bundle(batches):
    """The words of a block that a task has at a time, as one row: their
    numbers (as steps), how many ids each has, and the ids."""
    def give(held):
        place = np.concatenate([np.asarray(b.column("place")) for b in held])
        ids = pa.concat_arrays([b.column("ids") for b in held])
        order = np.argsort(place)
        block, number = place[order] >> NUMBER_BITS, place[order] & ((1 << NUMBER_BITS) - 1)
        ids = ids.take(pa.array(order))
        sizes = np.asarray(pc.binary_length(ids))
        at = np.append(0, np.cumsum(sizes, dtype=np.int64))
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        blobs = [[pack_numbers(np.diff(number[lo:hi], prepend=0)), pack_numbers(sizes[lo:hi]), zlib.compress(b"".join(ids[lo:hi].to_pylist()), 1)]
                 for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return pa.RecordBatch.from_arrays([pa.array(block[edges[:-1]]), *(pa.array([b[i] for b in blobs], pa.binary()) for i in range(3))],
                                          ["block", "numbers", "sizes", "ids"])

    held, n = [], 0
    for batch in textvec.released(batches):
        held.append(batch)
        n += batch.num_rows
        if n >= BUNDLE_ROWS:
            yield give(held)
            held, n = [], 0
    if n:
        yield give(held)


def _lay_out(sent):
    """The ids of each text of a block, by place."""
    def run(batches):
        pieces, kind = sent.value
        for batch in textvec.released(batches):
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("counts", "numbers", "n_distinct", "checksum", "codes")}
                n = row["n_distinct"].as_py()
                size_of, first_of, flat, at, seen = np.zeros(n, np.int32), np.zeros(n, np.int32), [], 0, 0
                for code in row["codes"].as_py() or []:
                    number = np.cumsum(unpack_numbers(code["numbers"]), dtype=np.int64)
                    sizes = unpack_numbers(code["sizes"]).astype(np.int32) // np.dtype(kind).itemsize
                    flat.append(np.frombuffer(zlib.decompress(code["ids"]), kind))
                    if len(number) and number[-1] >= n:
                        raise RuntimeError(SPLIT_DIFFERS)
                    size_of[number], first_of[number] = sizes, np.cumsum(sizes) - sizes + at
                    at += len(flat[-1])
                    seen += len(number)
                if seen != n or not size_of.all():
                    raise RuntimeError(SPLIT_DIFFERS)
                codes = np.concatenate(flat) if flat else np.zeros(0, kind)
                word_ends = np.append(0, np.cumsum(np.frombuffer(row["counts"].as_py(), "<i8")))
                doc_ids = batch.column("doc_ids")[i].values
                checksum = 0
                for (lo, hi), blob in zip(text_groups(word_ends), row["numbers"]):
                    mine = unpack_numbers(blob.as_py())
                    long = size_of[mine]
                    ends = np.append(0, np.cumsum(long, dtype=np.int64))
                    ids = codes[np.repeat(first_of[mine] - ends[:-1], long) + np.arange(ends[-1])].astype("<u4")
                    checksum = zlib.crc32(b"".join([pieces[j] for j in ids.tolist()]), checksum)
                    raw, cuts = ids.tobytes(), ends[word_ends[lo:hi + 1] - word_ends[lo]]
                    out = [raw[4 * x:4 * y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    yield pa.RecordBatch.from_arrays([doc_ids[lo:hi], pa.array(np.diff(cuts)), pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids"])
                if checksum != row["checksum"].as_py():
                    raise RuntimeError(SPLIT_DIFFERS)
    return run


SPLIT_DIFFERS = "a block's words are not those that were encoded: the source gave other rows when it was read again"


def pieces_of(config: bytes) -> list[bytes]:
    """The bytes of every id; a hole in the vocabulary has none."""
    tokenizer = plain_tokenizer(config)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    out = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        if i >= len(out):
            out += [b""] * (i + 1 - len(out))
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


_configs: dict[str, tuple] = {}


def vocabulary(path: str | None = None) -> tuple[bytes, list[bytes], np.ndarray, list[str]]:
    """The vocabulary file's bytes, the pieces, the classes of characters and
    the special strings; read once per process."""
    path = path or tokenizer_path(VOCABULARY)
    if path not in _configs:
        with open(path, "rb") as f:
            config = f.read()
        tokenizer = plain_tokenizer(config)
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        _configs[path] = (config, pieces_of(config), character_classes(tokenizer), specials)
    return _configs[path]


ENCODED = "doc_id long, n_tokens long, ids binary"
PARTS = "part long, distinct_ids array<long>, body binary"


def _coded_blocks(docs: DataFrame, path: str | None, block_bytes: int):
    """Blocks with the ids of their words, and the task function that lays
    the ids out by place."""
    config, pieces, kinds, specials = vocabulary(path)
    sc = docs.sparkSession.sparkContext
    kind = "<u2" if len(pieces) <= 1 << 16 else "<u4"
    splitter = sc.broadcast((kinds, specials))  # a byte per code point
    d = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # no word is null; saying so, and reading the least place, lets the table of
    # distinct words and the join share one shuffle
    places = d.mapInArrow(_word_rows(splitter, block_bytes), "word string, place long").where("word is not null").repartition("word")
    distinct = places.groupBy("word").agg(F.min("place").alias("first"))
    encoded = distinct.mapInArrow(_encode_words(sc.broadcast((config, kind))), "word string, ids binary")
    coded = places.join(encoded, "word").select("place", "ids")
    bundles = coded.mapInArrow(_bundle, "block long, numbers binary, sizes binary, ids binary").groupBy("block").agg(
        F.collect_list(F.struct("numbers", "sizes", "ids")).alias("codes"))
    bodies = d.mapInArrow(_body_rows(splitter, block_bytes),
                          "block long, doc_ids array<long>, counts binary, numbers array<binary>, n_distinct long, checksum long")
    return bodies.join(bundles, "block", "left").drop("block"), _lay_out(sc.broadcast((pieces, kind)))


def encode(docs: DataFrame, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of
    every text of ``docs``."""
    blocks, lay_out = _coded_blocks(docs, path, block_bytes)
    return blocks.mapInArrow(lay_out, ENCODED)


def _gather_ids(batches):
    """One row for the rows of a batch (they are laid out again after the
    join): their values, the distinct ids, and where each id stands."""
    first = TaskContext.get().partitionId() << 32
    for batch in textvec.released(batches):
        lo, sizes = 0, np.asarray(pc.fill_null(pc.binary_length(batch.column("ids")), 0)).astype(np.int64)
        while lo < batch.num_rows:
            hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), 4 * PART_CHARS, "right")))
            part = batch.slice(lo, hi - lo)
            flat = np.frombuffer(b"".join(x or b"" for x in part.column("ids").to_pylist()), "<u4")
            distinct = np.unique(flat).astype(np.int64)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            first += 1
            # an id that no vocabulary has stands for "no id", so that every group has a row
            yield pa.RecordBatch.from_arrays(
                [pa.array([first]), pa.array([np.append(distinct, -1).tolist()], pa.list_(pa.int64())), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["part", "distinct_ids", "body"])
            lo = hi


def _spell(names):
    """Rows of a group, one per distinct id with its piece, to texts."""
    def run(batches):
        open_parts: dict = {}
        for batch in textvec.released(batches):
            for part, n, i, piece, body in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "id", "piece", "body"))):
                group = open_parts.setdefault(part, [{}, None, n])
                group[0][i] = piece or b""
                if body is not None:
                    group[1] = body
                if len(group[0]) == n:
                    found, raw, _ = open_parts.pop(part)
                    with pa.ipc.open_stream(raw) as f:
                        rows = f.read_next_batch()
                    get = found.__getitem__
                    texts = [None if x is None else b"".join(map(get, np.frombuffer(x, "<u4").tolist())).decode("utf-8", "replace")
                             for x in rows.column("ids").to_pylist()]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names)
        if open_parts:
            raise RuntimeError("rows of a group were split between tasks")
    return run


def _spelled(parts: DataFrame, schema: T.StructType, path: str | None) -> DataFrame:
    """The rows in ``parts`` with their texts. The join with the pieces is a
    broadcast join, so what belongs to a part stays in its task."""
    pieces = vocabulary(path)[1]
    spark = parts.sparkSession
    by_id = spark.createDataFrame(pa.table({"id": pa.array(range(len(pieces)), pa.int64()), "piece": pa.array(pieces, pa.binary())}))
    ids = parts.select("part", F.size("distinct_ids").alias("n"), "body", F.posexplode("distinct_ids").alias("at", "id"))
    ids = ids.select("part", "n", F.when(F.col("at") == 0, F.col("body")).alias("body"), "id")
    joined = ids.join(F.broadcast(by_id), "id", "left").select("part", "n", "id", "piece", "body")
    out = T.StructType([*schema.fields, T.StructField("text", T.StringType())])
    return joined.mapInArrow(_spell(out.names), out)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` (a binary column ``ids``) with the text that
    the ids spell as the last column ``text`` (null ids: null)."""
    return _spelled(encoded.mapInArrow(_gather_ids, PARTS), encoded.schema, path)


def round_trip(docs: DataFrame, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``decode(encode(docs))``: doc_id, n_tokens, ids and text, with the ids
    laid out and gathered for decoding by one task function."""
    blocks, lay_out = _coded_blocks(docs, path, block_bytes)
    schema = T._parse_datatype_string(ENCODED)
    return _spelled(blocks.mapInArrow(lambda batches: _gather_ids(lay_out(batches)), PARTS), schema, path)


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = round_trip(table(spark, sf_dir, "documents"))
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
