"""Packing (exact round trip), language and toxicity (held-out accuracy), the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakeward.llm import langid, packing, textvec, toxicity
from tests.llm.fixtures import collect, documents, edited, prose, write_table

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


TRICKY = ["", "Hello, world's best!! it's we'll they've x'd 'start ''s !'s 'lls", "café CAFÉ é İstanbul ΣΣ 123 4²5 Ⅰx",
          "<|startoftext|>a<|endoftext|> <|x", "a b c\x1cd\x00e​f", "\U0001f600\U0001f601 中文字 हिन्दी", "'", "a'", "'re", "don't'll",
          "x" * 3000, "Å ring", "K kelvin", "ﬁ ligature 한글", "tab\tnew\r\nline sep", "1'2's3", "͸ unassigned"]


def test_encoder_equals_the_tokenizer(whole, monkeypatch):
    monkeypatch.setattr(packing, "PART_CHARS", 50)
    enc = packing.Encoder(PATH)
    r = random.Random(1)
    alphabet = "abcXYZ 'éÉß12,.!-\n\t <|>́中"
    texts = TRICKY + ["".join(r.choice(alphabet) for _ in range(r.randrange(120))) for _ in range(400)]
    for _ in range(2):  # again from the cache
        for t, ids in zip(texts, enc.encode(texts)):
            got = [] if ids is None else ids.tolist()
            assert got == whole.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("clashing", [False, True])
def test_packing_round_trip(spark, whole, clashing):
    rows = [(i, prose(i, n), "en", "s") for i, n in enumerate([0, 1, 5, 30, 300, 3000, 700, 701, 702, 12, 12, 900, 20_000])]
    rows += [(100, None), (101, TRICKY[1]), (5, rows[5][1]), (None, "null id")]
    got = collect(packing.pack(documents(spark, rows, clashing).repartition(3), with_ids=True))
    check_sequences(got)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, whole.encode(t or "", add_special_tokens=False).ids + [1])
    for i, ids in texts.items():
        copies = sum(1 for r in rows if r[0] == i)
        pieces = sorted((p for p in got if p["doc_id"] == i), key=lambda p: p["start"])
        assert sum(p["length"] for p in pieces) == copies * len(ids)
        for p in pieces:
            part = ids[p["start"]:p["start"] + p["length"]]
            assert p["ids"] == part and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())


def check_sequences(pieces, capacity=2048, most=0.01):
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append(p)
    used = padding = 0
    for seq in by.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
        used += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding <= most * used


def test_packing_many_small(spark):
    rows = [(i, prose(i, i % 40)) for i in range(2000)]
    check_sequences(collect(packing.pack(documents(spark, rows).coalesce(1))))


def test_packing_empty(spark):
    assert collect(packing.pack(documents(spark, []))) == []


# language

SYLLABLES = {"aa": "ka lo mi ne ru ta ssi vo".split(), "bb": "sté què dou ler tion ça eux rai".split(), "cc": "sch ung über keit zw pf ach ß".split()}


def language_text(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize()


def language_rows():
    return [(i, language_text(lang, i, 3 + i * 7 % 300), lang) for i in range(300) for lang in [("aa", "bb", "cc")[i % 3]]]


def test_language_held_out(spark, scratch):
    rows = language_rows()
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 --- !!", "cc"), (1003, language_text("bb", 1, 60_000), None), (None, language_text("cc", 2, 50), "cc"),
             (3, rows[3][1], "aa"), (1004, language_text("aa", 5, 20) + " " + language_text("bb", 5, 400), "bb"), (1005, "中文", None)]
    docs = documents(spark, rows, clashing=True)
    got = collect(langid.predict(docs, langid.learn(docs)))
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    held = [(by[i]["lang_pred"], lang) for i, _, lang in rows[:300] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.97
    for i in (1000, 1001, 1002):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0.0
    assert by[1003]["lang_pred"] == by[1004]["lang_pred"] == "bb" and by[None]["lang_pred"] == "cc" and by[1005]["lang_pred"] in SYLLABLES
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_known(docs, langid.learn(docs), 0.3)
    assert kept.columns == docs.columns
    assert {1000, 1001, 1002}.isdisjoint({r["doc_id"] for r in collect(kept)}) and kept.count() >= len(rows) - 4


def test_language_kernel_is_the_normalised_intersection():
    texts = [b"hello world", b"hello there", b"zzz"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    x = langid.presence(data, np.repeat(np.arange(3), [len(t) for t in texts]), 3)
    grams = [{t[i:i + n] for n in range(1, 5) for i in range(len(t) - n + 1)} for t in texts]
    k = langid.kernel(x, x)
    for i in range(3):
        for j in range(3):
            assert k[i, j] == pytest.approx(len(grams[i] & grams[j]) / (len(grams[i]) * len(grams[j])) ** 0.5, abs=0.06)


def test_language_nothing_to_learn(spark):
    docs = documents(spark, [(1, "some words", None), (2, None, None)])
    assert langid.learn(docs) is None
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in collect(langid.predict(docs, None))} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert collect(langid.predict(documents(spark, []), None)) == []


# toxicity

BAD = "grobnik skarl vuzzer morkel".split()


def toxic_rows(n=900):
    rows, labels = [], []
    r = random.Random(4)
    for i in range(n):
        words = prose(i, 20 + i % 150, 600).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(2 + i % 4):
                words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "en", "ist"]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    labels += [(1, None, None), (None, 1, 1), (8, 1, 1), (8, 0, 0)]
    rows += [(2000, None), (2001, ""), (2002, prose(1, 80_000, 600)), (2003, prose(1, 30_000, 600) + " skarl vuzzer grobnik morkelen skarl vuzzer"), (5, rows[5][1]), (None, "skarl skarl vuzzer")]
    docs = documents(spark, rows, clashing=True)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, table)
    got = collect(toxicity.passages(docs, model))
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    predicted = {i: by[i]["score"] >= toxicity.THRESHOLD for i in held}
    assert np.mean([predicted[i] for i in held if i % 8 == 0]) > 0.95
    assert np.mean([predicted[i] for i in held if i % 8]) < 0.01
    assert by[2000]["score"] == by[2001]["score"] == 0.0 and by[2002]["score"] < 0.5
    assert by[2003]["score"] >= 0.7 and by[2003]["passages"][-1]["first"] >= 30_000 and by[2003]["passages"][-1]["last"] == 30_005
    assert by[None]["score"] >= 0.7
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r["score"] < toxicity.THRESHOLD for r in got)


def test_toxicity_counts_do_not_depend_on_partitions(spark):
    rows, labels = toxic_rows()
    table = spark.createDataFrame([x for x in labels if x[0] < 300], "doc_id long, quality int, toxic int")
    one = documents(spark, rows).coalesce(1)
    many = documents(spark, rows[:300]).coalesce(1).unionByName(documents(spark, rows[300:]).repartition(7))
    a, b = toxicity.learn(one, table), toxicity.learn(many, table)
    first, second = np.argsort(a["buckets"]), np.argsort(b["buckets"])
    assert len(first) and a["buckets"][first].tolist() == b["buckets"][second].tolist()
    assert a["scores"][first] == pytest.approx(b["scores"][second])
    assert (a["drift"], a["lambda"]) == pytest.approx((b["drift"], b["lambda"]))
    uses = toxicity.token_counts(many, table)[0].filter("bucket >= 0").agg({"uses": "sum"}).first()[0]
    words = [w for _, text in rows for w in text.split()]
    assert uses == sum(1 + sum(len(w) >= k for k in toxicity.PREFIXES) for w in words)


@pytest.mark.parametrize("piece", [textvec.PIECE, 100])
def test_toxicity_votes_once_per_document(monkeypatch, piece):
    monkeypatch.setattr(textvec, "PIECE", piece)
    long = 150_000 if piece > 1000 else 300
    texts = [prose(1, 30), prose(2, long), prose(3, 20), "", prose(4, long), prose(5, long), prose(6, 5)]
    toxic, weight, fold = [0, 1, None, 0, 0, 1, 1], [1.0, 1.0, None, 1.0, 0.5, 1.0, 1.0], [0, 1, None, 0, 0, 1, 1]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(toxic, pa.int32()), pa.array(weight), pa.array(fold, pa.int32())],
                                       ["text", "toxic", "weight", "fold"])
    got = pa.Table.from_batches(list(toxicity._count([batch, batch]))).to_pylist()
    plain = {}
    for text, t, w, f in zip(texts, toxic, weight, fold):
        if t is None or not text:
            continue
        words = sorted(set(text.split()))
        tokens = {toxicity._buckets(h[h != 0]).tobytes() for _, _, hashes, heads in textvec.words_of(*textvec.utf8(pa.array(words)), toxicity.PREFIXES)
                  for h in (hashes, *heads)}
        for bucket in set(np.frombuffer(b"".join(tokens), np.int64).tolist()):
            plain.setdefault(bucket, [0.0] * 4)[t * 2 + f] += 2 * w  # the batch is there twice
    votes = {r["bucket"]: [r[c] for c in ("clean0", "clean1", "toxic0", "toxic1")] for r in got if r["bucket"] >= 0}
    assert {b: v for b, v in votes.items() if any(v)} == plain


def test_maximal_segments_match_brute_force():
    r = random.Random(2)
    for _ in range(300):
        n = r.randrange(1, 12)
        scores = [r.choice([1.0, 2.0, 3.0]) for _ in range(n)]
        gaps = [0.0] + [r.choice([0.0, 0.5, 1.5, 2.5, 4.0]) for _ in range(n - 1)]
        got = toxicity.maximal_segments(scores, gaps)
        assert got == brute_segments(scores, gaps)


def brute_segments(scores, gaps):
    """Take the best contiguous run (shortest, then leftmost), and go on left and right of it."""
    flat = []
    for s, g in zip(scores, gaps):
        flat += [-g, s]

    def rest(lo, hi):
        best = None
        for i in range(lo, hi):
            for j in range(i + 1, hi + 1):
                total = sum(flat[i:j])
                if total > 0 and (best is None or (total, i - j) > (best[0], best[1] - best[2])):
                    best = (total, i, j)
        if best is None:
            return []
        total, i, j = best
        return rest(lo, i) + [(i // 2, (j - 1) // 2, total)] + rest(j, hi)
    return rest(0, len(flat))


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in collect(toxicity.passages(docs, toxicity.learn(docs, none)))} == {0.0}
    empty = documents(spark, [])
    assert collect(toxicity.passages(empty, toxicity.learn(empty, none))) == []


# the pipeline


def test_pipeline(spark, scratch):
    import corpus_pipeline as C
    rows, labels = toxic_rows(600)
    # two languages, copies, near copies, and texts without letters
    rows = [(i, t, "en", f"s{i % 3}") for i, t in rows]
    rows += [(1000 + i, language_text("bb", i, 120), "fr", "s1") for i in range(100)]
    rows += [(2000 + i, rows[2 * i + 1][1], "en", "s0") for i in range(20)]
    base = prose(555, 400, 5000)
    rows += [(3000 + i, edited(base, i, 2), "en", "s2") for i in range(10)]
    rows += [(4000, None, "en", "s0"), (4001, "123 456", None, None), (4002, "", "en", "s0")]
    write_table(documents(spark, rows), scratch, "documents")
    write_table(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), scratch, "labels")
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "packing"]
    docs, seen = documents(spark, rows), []
    for name, stage in C.STAGES:
        out = stage(spark, docs, scratch)
        out.write.parquet(f"{scratch}/out-{name}")
        docs = spark.read.parquet(f"{scratch}/out-{name}")
        if name != "packing":
            assert docs.columns == list(C.COLUMNS)
        seen.append({r["doc_id"] for r in collect(docs.select("doc_id"))})
    toxic, language, near, mixed, packed = seen
    toxics = {i for i in range(600) if i % 8 == 0}
    assert len(toxic & toxics) <= 4 and len(set(range(600)) - toxics - toxic) <= 2
    assert {4000, 4001, 4002}.isdisjoint(language) and len(toxic - language) <= 5
    assert not near & set(range(2000, 2020)) - toxics and len(near & set(range(3000, 3010))) == 1
    assert mixed <= near and packed == mixed
    check_sequences(collect(docs))
    again = C.run(spark, scratch)
    assert sorted(map(str, again.groupBy("doc_id").sum("length").collect())) == sorted(map(str, docs.groupBy("doc_id").sum("length").collect()))
