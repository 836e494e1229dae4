"""Inputs that broke earlier versions: many hits, small sources, repeated labelled rows, unclear languages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeward.llm import langid, licenses, mixing, toxicity
from tests.llm.fixtures import collect, documents, prose


def test_licenses_many_hits_in_one_text(spark):
    """100,000 hits in one text: all places count, in time linear in them."""
    docs = documents(spark, [(1, "cc by " * 100_000), (2, "x " * 200_000 + "cc by"), (3, "cc by"), (4, None)])
    got = {r["doc_id"]: r for r in collect(licenses.license_report(docs))}
    assert [got[i]["n_base"] for i in (1, 2, 3, 4)] == [100_000, 1, 1, 0]
    assert (got[1]["first_word"], got[1]["last_word"], got[2]["first_word"]) == (0, 199_998, 200_000)


def test_licenses_lower_only_a_to_z(spark):
    rows = [(1, "GENERAL Public LICENSE"), (2, "general public licenſe"), (3, "CC KBY cc BY"), (4, "ALL RİGHTS reserved")]
    got = {r["doc_id"]: (r["n_base"], r["base_labels"]) for r in collect(licenses.license_report(documents(spark, rows)))}
    assert got == {1: (1, "gpl"), 2: (0, ""), 3: (1, "cc-by"), 4: (0, "")}


def test_mixing_small_sources_meet_their_targets(spark):
    rows = [(i, prose(i, 50), "en", f"small{i:02}") for i in range(60)]
    rows += [(100 + i, prose(i, 10), "en", "ten words" if i < 1 else "tens") for i in range(30)]
    rows += [(1000 + i, prose(i, 400), "en", "large") for i in range(40)] + [(5000, "one", "en", "one word"), (5001, None, "en", "none")]
    docs = documents(spark, rows)
    report = mixing.mix_report(docs)
    per = report.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for r in collect(per):
        assert abs(r["taken"] - r["target"]) <= max(2, 0.05 * r["target"]), r
        assert r["over"] <= 0
    # the mix as documents holds the words that the report counts
    words = mixing.mixed_documents(docs).select(F.regexp_count("text", F.lit(mixing.WORD)).alias("n")).agg(F.sum("n")).first()[0]
    assert words == report.agg(F.sum("taken")).first()[0]


def toxic_corpus():
    rows, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        rows.append((i, prose(i, 60) + (" vile slur%d filth" % (i % 3) if toxic else " kind calm words") + " " + prose(i + 999, 20)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def scores(spark, rows, labels):
    model = toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    texts = documents(spark, [(1, "a vile slur1 filth here"), (2, "flat harmless nothing stand"), (3, prose(5, 80)), (4, rows[0][1])])
    return {r["doc_id"]: r["score"] for r in collect(toxicity.passages(texts, model))}


def test_toxicity_repeated_labelled_rows(spark):
    """A labelled document that stands in the table 40 times has one vote."""
    rows, labels = toxic_corpus()
    odd = next(i for i in range(1000, 1100) if i % 4 == 0 and spark.range(1).select((F.crc32(F.lit(str(i))) % 3 != 1)).first()[0])
    rows.append((odd, "flat harmless nothing stand " + prose(7, 50)))
    labels.append((odd, 1, 1))
    once, often = scores(spark, rows, labels), scores(spark, rows + [rows[-1]] * 39, labels)
    assert once == pytest.approx(often, abs=1e-6)
    assert often[2] < 0.5 < 0.9 < often[1]


LANGS = {"aa": "abab cdcd baba dcdc", "bb": "efef ghgh fefe hghg", "cc": "ijij klkl jiji lklk", "dd": "mnmn opop nmnm popo", "ee": "qrqr stst rqrq tsts"}


@pytest.mark.parametrize("n_langs", [1, 2, 5])
def test_language_margin_rejects_unclear_texts(spark, n_langs):
    names = list(LANGS)[:n_langs]
    rows = [(i, " ".join([LANGS[names[i % n_langs]]] * (1 + i % 9)), names[i % n_langs]) for i in range(200)]
    model = langid.learn(documents(spark, rows))
    clear = [(1000 + i, LANGS[n]) for i, n in enumerate(names)]
    unclear = [(2000, "uvuv wxwx"), (2001, "12 34")] + ([(2002, LANGS["aa"] + " " + LANGS["bb"])] if n_langs > 1 else [])
    kept = {r[0] for r in langid.keep_known(documents(spark, clear + unclear), model, 0.05).select("doc_id").collect()}
    assert kept >= {r[0] for r in clear} and 2001 not in kept
    if n_langs > 1:
        assert 2002 not in kept and 2000 not in kept


def test_language_sample_is_bounded(spark):
    """A repeated doc_id is drawn once; the most frequent languages are learned."""
    first = next(i for i in range(100) if spark.range(1).select((F.crc32(F.lit(str(i))) % 3 != 1)).first()[0])
    rows = [(first, LANGS["aa"], "aa")] * 3000 + [(500 + i, LANGS["bb"], "bb") for i in range(30)]
    langs, _ = langid.training_windows(documents(spark, rows), sample=20)
    assert langs.count("aa") == 1 and 0 < langs.count("bb") <= 80


def test_packing_takes_few_pieces():
    """Reciprocal classes: about as many pieces as documents and sequences together, without padding but at the end."""
    import numpy as np

    from lakeward.llm import packing

    r = np.random.default_rng(1)
    for lengths in (r.integers(1, 4000, 3000), r.integers(1, 200, 5000), r.integers(700, 1024, 2000), np.full(2000, 1025), np.full(3000, 683)):
        bins = packing.Bins(0)
        for i, n in enumerate(lengths.tolist()):
            bins.add(i, np.full(n, i, np.uint32))
            assert len(bins.gaps) <= 2 and all(len(b) < j for j, b in bins.open.items())
        bins.finish()
        used = {}
        for _, _, length, _, _, seq, _ in bins.rows:
            used[seq] = used.get(seq, 0) + length
        assert sum(used.values()) == lengths.sum()
        assert sum(2048 - u for u in used.values() if u & (u - 1)) == 0
        assert len(bins.rows) <= len(lengths) + len(used) + 40
