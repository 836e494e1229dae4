"""BPE round trip, source divergence and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeward.llm import bpe, divergence, hardneg
from tests.llm.fixtures import CLASHING, collect, documents, prose, write_table

# byte-level BPE

TRICKY = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "B", "1", "9", "!", "é", "ß", "中", " ", "　", "<|endoftext|>",
          "<|", "|>", "'s", "ǅ", "́", "\U0001f600", "\r\n", "²", "​", "\x00", "\U0010ffff"]


@pytest.fixture(scope="module")
def reference():
    return bpe.plain_tokenizer(bpe.vocabulary()[0])


def rows_expected(tokenizer, rows):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_bpe_equals_the_tokenizer(spark, scratch, reference, block_bytes):
    r = random.Random(3)
    rows = [(i, "".join(r.choice(TRICKY) for _ in range(r.randrange(40)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, prose(1, 500)), (1002, prose(1, 500)), (None, "it's 12's <|endoftext|>'s"), (1003, "x" * 5000), (1004, " " * 5000 + "a")]
    folder = write_table(documents(spark, rows).repartition(3, "doc_id"), scratch, "documents")
    docs = spark.read.parquet(folder + "/documents.parquet").select("*", *(F.lit("x").alias(c) for c in CLASHING))
    got = bpe.decode(bpe.encode(docs, block_bytes=block_bytes)).select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("text", 256))
    assert sorted(map(tuple, got.collect()), key=str) == rows_expected(reference, rows)
    got = bpe.round_trip(docs, block_bytes=block_bytes).select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("text", 256))
    assert sorted(map(tuple, got.collect()), key=str) == rows_expected(reference, rows)


def test_bpe_texts_longer_than_a_part(spark, scratch, reference, monkeypatch):
    kinds, specials = bpe.vocabulary()[2:]
    splitter = bpe.Splitter(kinds, specials)
    texts = [prose(5, 3000) + "<|endoftext|>" + "中" * 3000 + prose(6, 100), "", "don't " * 2000]
    data, offsets = bpe.textvec.utf8(bpe.pa.array(texts))
    whole = splitter.word_starts(data, offsets)
    monkeypatch.setattr(bpe, "PART_CHARS", 97)
    assert np.array_equal(splitter.word_starts(data, offsets), whole)


def test_bpe_query(spark, reference):
    sf = "/root/testdata/sf0.001"
    got = bpe.op11_bpe_round_trip(spark, sf)
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == rows_expected(reference, rows)


def test_bpe_empty_and_unknown_ids(spark):
    assert bpe.decode(bpe.encode(documents(spark, []))).collect() == []
    raw = np.array([15496, 10**6, 187, 50256], "<u4").tobytes()
    got = collect(bpe.decode(spark.createDataFrame([(1, raw, "x"), (2, None, "y"), (3, b"", "z")], "k int, ids binary, text2 string")))
    by = {r["k"]: r["text"] for r in got}
    assert by == {1: "Hello�<|endoftext|>", 2: None, 3: ""} and got[0]["text2"]


def test_bpe_refuses_a_source_that_changes(spark):
    """The words were taken from other rows than the places: no wrong ids."""
    sent = spark.sparkContext.broadcast((bpe.vocabulary()[1], "<u2"))
    run = bpe._lay_out(sent)
    import pyarrow as pa
    codes = {"numbers": bpe.pack_numbers(np.array([0])), "sizes": bpe.pack_numbers(np.array([2])), "ids": bpe.zlib.compress(np.array([15496], "<u2").tobytes())}
    row = {"doc_ids": [[1]], "counts": [np.array([1], "<i8").tobytes()], "numbers": [[bpe.pack_numbers(np.array([0]))]], "n_distinct": [1],
           "checksum": [bpe.zlib.crc32(b"Hullo")], "codes": [[codes]]}
    batch = pa.RecordBatch.from_pydict(row)
    with pytest.raises(RuntimeError, match="other rows"):
        list(run([batch]))
    row["checksum"] = [bpe.zlib.crc32(b"Hello")]
    assert next(run([pa.RecordBatch.from_pydict(row)])).column("n_tokens").to_pylist() == [1]


# source divergence

def divergence_by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [(r[0], r[1], r[2], r[3]) for r in rows])
    return sorted(con.execute(divergence.ORACLE_SQL).fetchall(), key=str)


def divergence_rows(seed, n=160, sources=7):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [w for _ in range(r.randrange(60)) for w in [r.choice(["the", "AND", "Größe", "internationally", "counterrevolutionary", "naïveté", "x" * 40, "ab1cd", "q%d" % r.randrange(9),
                                                                   "w" * r.randrange(1, 20), "中文字" * r.randrange(1, 7)])]]
        rows.append((i, " ".join(words) if i % 13 else None, r.choice(["en", "de", None]), r.choice(["s%d" % r.randrange(sources), None, "s0", "s0"])))
    return rows + rows[:9]


@pytest.mark.parametrize("tile,chunk", [(128, 4096), (2, 3)])
def test_divergence_matches_sql(spark, tile, chunk):
    rows = divergence_rows(tile)
    got = divergence.audit(documents(spark, rows, clashing=True).repartition(4), tile=tile, chunk_terms=chunk)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect()), key=str) == divergence_by_sql(rows)


def test_divergence_small_sorts(spark, monkeypatch):
    """Documents that span pieces and sorts count once per term."""
    rows = [(i, prose(i % 4, 3000).replace("1", "one "), "en", "s%d" % (i % 3)) for i in range(14)]
    batch = bpe.pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "source": [r[3] for r in rows], "text": [r[1] for r in rows]})

    def counted():
        found = {}
        for b in divergence._count_terms(iter([batch, batch])):
            for lang, source, term, uses, docs in zip(*(c.to_pylist() for c in b.columns)):
                u, d = found.get((lang, source, term), (0, 0))
                found[lang, source, term] = u + uses, d + docs
        return found

    expect = {}
    for _, text, lang, source in rows * 2:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        for t in set(terms):
            u, d = expect.get((lang, source, t), (0, 0))
            expect[lang, source, t] = u + terms.count(t), d + 1
    assert counted() == expect
    monkeypatch.setattr(divergence, "SORT_ROWS", 500)
    monkeypatch.setattr(divergence, "KEPT_ROWS", 50)
    monkeypatch.setattr(divergence.textvec, "PIECE", 700)
    assert counted() == expect


def test_divergence_edge_cases(spark):
    assert divergence.audit(documents(spark, [])).collect() == []
    rows = [(1, None, "en", "a"), (2, "", "en", "b"), (3, "rare", None, None)]
    got = sorted(map(tuple, divergence.audit(documents(spark, rows)).collect()))
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == divergence_by_sql(rows)


def test_radix_order():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2**64, 2000, dtype=np.uint64) >> np.uint64(50), r.integers(0, 5, 2000).astype(np.uint32)
    assert np.array_equal(divergence.radix_order([a, b]), np.lexsort((np.arange(2000), b, a)))


# hard negatives

def hard_by_brute(rows, step=100, positives=5, negatives=10):
    base = []
    for uid, (i, e, label) in enumerate(rows):
        if label is None or not e or any(x is None or not np.isfinite(x) for x in e):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        base.append((uid, i, label, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    out = []
    for uid, i, label, e in base:
        if i is None or i % step:
            continue
        scored = [(-sum(x * y for x, y in zip(e, f)), float("inf") if j is None else j, u, m) for u, j, m, f in base if u != uid and len(f) == len(e)]
        for s, j, _, _ in sorted(x for x in scored if x[3] == label)[:positives]:
            ok = sorted(x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k, _, _) in enumerate(ok)]
    return sorted(((a, None if b == float("inf") else b, c, None if d == float("inf") else d, e, f) for a, b, c, d, e, f in out), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, LABEL string, uid string")


def hard_rows(seed, n=900, dim=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = []
    for i in range(n):
        k = int(r.integers(6))
        rows.append((i, [float(x) for x in centres[k] * 0.4 + r.normal(size=dim) * 0.3], k if r.random() < 0.9 else int(r.integers(10))))
    return rows


@pytest.mark.parametrize("tile_rows", [8192, 100])
def test_hard_negatives_match_brute_force(spark, monkeypatch, tile_rows):
    rows = hard_rows(tile_rows)
    rows += [(5000, [1.0] * 12, None), (5100, None, 3), (5200, [float("nan")] * 12, 3), (5300, [float("inf")] + [0.0] * 11, 3), (5400, [None] + [0.1] * 11, 3), (5500, [], 3),
             (5600, [0.0] * 12, 3), (None, rows[0][1], rows[0][2]), (5700, [0.5, 0.5], 1), (5701, [0.5, 0.4], 1), (5702, [0.4, 0.3], 2)]
    rows += [(6000 + i, rows[100][1], i % 4) for i in range(60)] + [rows[200]] * 3  # ties, and repeated rows
    monkeypatch.setattr(hardneg, "TILE_ROWS", tile_rows)
    got = hardneg.mine(vectors(spark, rows).repartition(3))
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == hard_by_brute(rows) and len(got) > 200


def test_hard_negatives_edge_cases(spark):
    assert hardneg.mine(vectors(spark, [])).collect() == []
    assert hardneg.mine(vectors(spark, [(100, [0.5, 0.5], 1)])).collect() == []
    rows = [(100, [0.5], 1), (101, [0.5], 1), (102, [0.3], 2), (103, [-0.3], 2), (200, [-1.0], 1)]
    assert sorted(map(tuple, hardneg.mine(vectors(spark, rows)).collect()), key=str) == hard_by_brute(rows) != []


@pytest.mark.parametrize("size, dim", [(1.0, 8), (16000.0, 8), (16000.0, 600)])
def test_hard_negatives_in_each_number_type(spark, size, dim):
    """Sums of products that 32-bit, 64-bit floats and only whole numbers hold."""
    r = np.random.default_rng(dim)
    rows = [(i * 20, [float(np.float32(x)) for x in size * r.uniform(0.4, 1, size=dim)], int(r.integers(3))) for i in range(60)]
    rows += [(7 * i + 1, [x * 0.5 for x in rows[i][1]], 4) for i in range(30)] + [(9001 + i, [size * 0.4] * dim, 5) for i in range(30)]
    got = sorted(map(tuple, hardneg.mine(vectors(spark, rows)).collect()), key=str)
    assert got == hard_by_brute(rows) and len(got) > 200


def test_hard_negatives_cost_where_no_cell_is_pruned(monkeypatch):
    """Vectors without clusters: the bounds prune nothing, and each search of
    256 anchors and 8,192 rows takes a fraction of a second (1.6 s and more
    when each anchor walked each cell by itself)."""
    r = np.random.default_rng(5)
    n, step = 8192, 32
    v = r.normal(size=(n, 64))
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    labels = r.integers(10, size=n)
    monkeypatch.setattr(hardneg, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    e = np.floor(v * 256)
    sent = SimpleNamespace(value={64: (hardneg.fit(e[:4096, :32], 16), hardneg.fit(e[:4096, 32:], 16))})
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(list(v)), pa.array(labels)], ["vec_id", "embedding", "label"])
    [tile] = hardneg._tiles(sent)([rows])
    [anchors] = hardneg._anchors(step)([tile])

    def found(windows):
        asked = anchors.append_column("windows", pa.array(windows, pa.list_(pa.int64())))
        blocks = [pa.RecordBatch.from_arrays([pa.array([i]), *q.columns[1:], *tile.columns], ["q_tile", *("q_" + c for c in q.schema.names[1:]), *tile.schema.names])
                  for i, q in enumerate(hardneg._anchor_tiles([asked]))]
        began = time.process_time()
        out = list(hardneg._search(sent, 5, 10)(iter(blocks)))
        assert time.process_time() - began < 0.8
        return sorted((x["uid"], x["window"], -x["score"], x["found_id"]) for b in out for x in b.to_pylist())

    uids, ids = anchors.column("uid").to_pylist(), anchors.column("vec_id").to_numpy()
    scores = (e[ids] @ e.T).astype(int)
    expect, windows = [], []
    for uid, i, s in zip(uids, ids.tolist(), scores):
        best = sorted((-s[j], j) for j in np.flatnonzero(labels == labels[i]) if j != i)[:5]
        expect += [(uid, 0, *x) for x in best]
        windows.append([int(-x) for x, _ in best])
    assert found([None] * len(ids)) == sorted(expect)
    expect = []
    for uid, i, s, mine in zip(uids, ids.tolist(), scores, windows):
        for p in set(mine):
            ok = np.flatnonzero((labels != labels[i]) & (30 * p <= 100 * s) & (100 * s <= 90 * p))
            expect += [(uid, p, *x) for x in sorted((-s[j], j) for j in ok)[:10]]
    assert found(windows) == sorted(expect)


def test_cells_are_walked_in_falling_order():
    r = np.random.default_rng(4)
    upper = r.normal(size=7), r.normal(size=5)
    upper[0][2] = -np.inf
    got = list(hardneg.walk(upper))
    assert len(got) == 30 and [b for b, *_ in got] == sorted((b for b, *_ in got), reverse=True)
    assert all(b == upper[0][i] + upper[1][j] for b, i, j in got) and len({(i, j) for _, i, j in got}) == 30
