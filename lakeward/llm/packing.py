"""Harmonic packing of tokenised documents into sequences.

Method. A document's ids are cut into full sequences of the capacity C; what
remains, r ids, belongs to the class j of the lengths in (C/(j+1), C/j], for j
up to ``CLASSES`` (shorter ones are of the last class), and goes whole into
that class's open bin, which takes exactly j of them. The room that a bin has
left then is filled by the next document's first ids: as many as fit, or the
whole document if it is shorter. So a document adds one piece, a full
sequence another, and a bin one or a few more; with any padding left out that
is about the least possible (as many pieces as documents and sequences).
Every task fills its own bins and shares nothing with other tasks. At the end
of a task what lies in unfilled bins is laid end to end and cut at powers of
two, which need no padding.

Tokens. ``tokenizers`` gives the ids. White space never lies inside a
pre-token of this vocabulary, and a pre-token's ids depend on it alone, so
each distinct pre-token is tokenised once per task and looked up afterwards
(a bounded cache keyed by 64-bit hashes). Texts that need more than the
plain rules (special-token strings, unnormalised or unassigned characters,
capitals with long lower forms) go through the tokenizer as a whole.

Edge cases. A null or empty text has the end id alone. A text of any length
is tokenised whole, in parts cut at spaces. Rows that repeat are packed
each; null doc_ids are kept. Empty input gives no rows. Extra columns are
ignored. sequence_id is unique over all tasks (task number and a counter).
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import textvec
from lakeward.llm.common import table, take

CAPACITY = 2048
END_ID = 1
#: Reciprocal classes: C/1, C/2, ... C/32.
CLASSES = 32
VOCABULARY = "word_bpe_49k.json"
PART_CHARS = 1 << 18
CACHE_SLOTS = 1 << 19
CACHE_IDS = 1 << 21

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


def tokenizer_path(name: str = VOCABULARY) -> str:
    """The vocabulary's place, from the installed tokenizer files."""
    import sys
    if "/opt/tokenizers" not in sys.path:
        sys.path.append("/opt/tokenizers")
    import importlib
    try:
        return importlib.import_module("public_tokenizers").path(name)
    except ImportError:
        import importlib.util
        spec = importlib.util.spec_from_file_location("public_tokenizers", "/opt/tokenizers/__init__.py")
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        return module.path(name)


class Characters:
    """Class and lower form of every code point, and which are plain."""

    def __init__(self):
        n = 0x110000
        self.kind = np.full(n, _OTHER, np.uint8)
        self.lower = np.arange(n, dtype=np.uint32)
        self.plain = np.ones(n, bool)
        for c in range(n):
            category = unicodedata.category(chr(c))
            if category[0] == "L":
                self.kind[c] = _LETTER
                low = chr(c).lower()
                if len(low) == 1:
                    self.lower[c] = ord(low)
                else:
                    self.plain[c] = False
            elif category[0] == "N":
                self.kind[c] = _NUMBER
                low = chr(c).lower()
                self.lower[c] = ord(low) if len(low) == 1 else c
            elif category in ("Cn", "Cs"):
                self.plain[c] = False
            elif category == "So":
                self.lower[c] = ord(chr(c).lower())
        # White_Space (fixed values of the Unicode standard)
        space = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
        self.kind[space] = _SPACE


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable in Latin-1, else the next free one from 256 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


@lru_cache(maxsize=1)
def characters() -> Characters:
    """The table of a worker process, 7 MB; its tokenizers and their caches go with the task."""
    return Characters()


class Encoder:
    """Ids of texts, equal to ``tokenizers`` with add_special_tokens=False."""

    def __init__(self, vocabulary: str | bytes):
        """Of a vocabulary file's path or its bytes."""
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(vocabulary) if isinstance(vocabulary, str) else Tokenizer.from_str(vocabulary.decode())
        self.model = self.whole.model
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.chars = characters()
        self.alphabet = byte_alphabet()
        self.reset()

    def reset(self):
        self.key = np.zeros(CACHE_SLOTS, np.uint64)
        self.at = np.zeros(CACHE_SLOTS, np.int64)
        self.size = np.zeros(CACHE_SLOTS, np.int64)
        self.store = np.zeros(CACHE_IDS, np.uint32)
        self.used = 0

    def needs_whole(self, text: str, cp: np.ndarray) -> bool:
        if not self.chars.plain[cp].all():
            return True
        if len(cp) and cp.max() >= 0x300 and not unicodedata.is_normalized("NFC", text):
            return True
        return "<|" in text and any(s in text for s in self.specials)

    def _tokenise(self, cp: np.ndarray) -> list[int]:
        raw = cp.astype("<u4").tobytes().decode("utf-32-le").encode()
        return [t.id for t in self.model.tokenize("".join([self.alphabet[b] for b in raw]))]

    def plain_ids(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain code points, and for each id where its pre-token starts."""
        kind = self.chars.kind[cp]
        cp = self.chars.lower[cp]
        n = len(cp)
        edge = np.ones(n, bool)
        edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        # an apostrophe that starts a run takes 's 't 'm 'd 're 've 'll with it
        for i in np.flatnonzero((cp == 0x27) & edge).tolist():
            two = "".join(map(chr, cp[i + 1:i + 3].tolist()))
            k = 2 if two[:1] in ("s", "t", "m", "d") and two else 3 if two in ("re", "ve", "ll") else 0
            if k:
                edge[i + 1:i + k] = False
                if i + k < n and kind[i + k] == _LETTER:
                    edge[i + k] = True
        at = np.flatnonzero(edge)
        ends = np.append(at[1:], n)
        real = kind[at] != _SPACE
        starts, ends = at[real], ends[real]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * textvec.powers(textvec._BASE, n), out=sums[1:])
        h = textvec.mix((sums[ends] - sums[starts]) * textvec.powers(textvec._BASE_INVERSE, n)[starts])
        slot = (h & np.uint64(CACHE_SLOTS - 1)).astype(np.int64)
        hit = self.key[slot] == h
        place, size = self.at[slot], self.size[slot]
        miss = np.flatnonzero(~hit)
        if len(miss):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            ids = [self._tokenise(cp[starts[i]:ends[i]]) for i in miss[first].tolist()]
            sizes = np.array([len(x) for x in ids])
            flat = np.array([v for x in ids for v in x], np.uint32)
            if self.used + len(flat) > len(self.store):
                self.store = np.concatenate([self.store[:self.used], np.zeros(len(flat) + CACHE_IDS, np.uint32)])
            self.store[self.used:self.used + len(flat)] = flat
            places = self.used + np.cumsum(sizes) - sizes
            self.used += len(flat)
            place[miss], size[miss] = places[back], sizes[back]
            to = (new & np.uint64(CACHE_SLOTS - 1)).astype(np.int64)
            self.key[to], self.at[to], self.size[to] = new, places, sizes
        total = int(size.sum())
        before = np.cumsum(size) - size
        ids = self.store[np.repeat(place - before, size) + np.arange(total)]
        where = np.repeat(starts, size)
        if self.used > CACHE_IDS // 2:
            self.reset()
        return ids, where

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        group, chars = [], 0

        def flush():
            if group:
                joined = np.concatenate([x for _, cp in group for x in (cp, np.array([0x20], np.uint32))])
                ids, where = self.plain_ids(joined)
                cuts = np.searchsorted(where, np.cumsum([len(cp) + 1 for _, cp in group]))
                for (i, _), part in zip(group, np.split(ids, cuts[:-1])):
                    out[i] = part if out[i] is None else np.concatenate([out[i], part])
                group.clear()

        for i, text in enumerate(texts):
            cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            if self.needs_whole(text, cp):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
                continue
            lo = 0
            while True:  # a long text is cut at spaces
                hi = len(cp)
                if hi - lo > PART_CHARS and (gap := _GAP.search(text, lo + PART_CHARS)):
                    hi = gap.start()
                group.append((i, cp[lo:hi]))
                chars += hi - lo + 1
                lo = hi
                if chars >= PART_CHARS:
                    flush()
                    chars = 0
                if lo >= len(cp):
                    break
        flush()
        return out


_GAP = re.compile(r"[ \n\t\r]")


class Bins:
    """The bins that one task fills. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, task: int, capacity: int = CAPACITY, with_ids: bool = False):
        self.next_id = task << 40
        self.capacity = capacity
        self.open: dict[int, list] = {}  # by class
        self.gaps: list[list] = []  # [pieces, room] of bins with their fixed number of pieces
        self.rows: list[tuple] = []
        self.with_ids = with_ids

    def put_sequence(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, doc_tokens in pieces:
            row = (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, self.next_id, at)
            self.rows.append((*row, ids) if self.with_ids else row)
            at += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, lo, capacity = len(ids), 0, self.capacity
        if self.gaps:
            # a gap takes the document's head, or all of it
            gap = self.gaps[0]
            lo = min(n, gap[1])
            gap[0].append(self._piece(doc_id, 0, ids[:lo], n))
            gap[1] -= lo
            if not gap[1]:
                self.put_sequence(self.gaps.pop(0)[0])
        while n - lo >= capacity:
            self.put_sequence([(doc_id, lo, ids[lo:lo + capacity], n)])
            lo += capacity
        if lo < n:
            count = min(CLASSES, capacity // (n - lo))
            bin_ = self.open.setdefault(count, [])
            bin_.append(self._piece(doc_id, lo, ids[lo:], n))
            if len(bin_) == count:
                room = capacity - sum(len(p[2]) for p in self.open.pop(count))
                if room:
                    self.gaps.append([bin_, room])
                else:
                    self.put_sequence(bin_)

    @staticmethod
    def _piece(doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> tuple:
        """A piece that outlives its batch keeps its own copy."""
        return doc_id, start, ids.copy(), doc_tokens

    def finish(self) -> None:
        """What is left is laid end to end, longest pieces first, and cut at
        the capacity and at last at powers of two."""
        left = [p for pieces, _ in self.gaps for p in pieces] + [p for j in sorted(self.open) for p in self.open[j]]
        self.open, self.gaps = {}, []
        total = sum(len(p[2]) for p in left)
        while total:
            room = self.capacity
            while room > total:
                room //= 2
            total -= room
            sequence = []
            while room:
                doc_id, start, ids, n = left[0]
                if len(ids) <= room:
                    sequence.append(left.pop(0))
                    room -= len(ids)
                else:
                    sequence.append((doc_id, start, ids[:room], n))
                    left[0] = (doc_id, start + room, ids[room:], n)
                    room = 0
            self.put_sequence(sequence)

    def take_rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * (8 if self.with_ids else 7)
        self.rows = []
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        if self.with_ids:
            arrays.append(pa.array(list(columns[7]), pa.list_(pa.uint32())).cast(pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, COLUMNS[:len(arrays)])


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece (see COLUMNS; ids only where asked for)."""
    with open(path or tokenizer_path(), "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary file

    def run(batches):
        enc = Encoder(sent.value)
        bins = Bins(TaskContext.get().partitionId(), capacity, with_ids)
        end = np.array([END_ID], np.uint32)
        for batch in textvec.released(batches):
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts)):
                    bins.add(doc_id, np.concatenate([ids, end]) if ids is not None else end)
            yield bins.take_rows()
        bins.finish()
        yield bins.take_rows()
        del enc, bins
        textvec.give_back()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
    return take(docs, "doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
