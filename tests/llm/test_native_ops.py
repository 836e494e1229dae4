"""License scan, mixing and WARC against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeward.llm import licenses, mixing, warc
from tests.llm.fixtures import collect, documents, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LICENSE_TEXTS = [
    (1, "All rights reserved. CC-BY all RIGHTS reserved"), (2, None), (3, ""), (4, "general public general public license license"),
    (5, "cc by cc by " * 50), (6, "nothing " + prose(1, 300)), (7, "État cc by cc BY 4"), (8, "Released under the MIT License."),
    (9, "intro words here Permission is hereby granted, free of charge, to any person obtaining one copy of this software and "
        "associated documentation files, the software, to deal in the software without any restriction"),
    (1, "All rights reserved. CC-BY all RIGHTS reserved"), (None, "all rights reserved"), (10, "rights reserved all"), (11, "x" * 200_000 + " cc by"),
]


def base_of(text):
    words = WORDS.findall((text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in licenses.BASE for p in [phrase.split()] for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return (len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({v for _, v in hits})))


@pytest.mark.parametrize("clashing", [False, True])
def test_license_base_matches_brute_force(spark, clashing):
    got = collect(licenses.license_report(documents(spark, LICENSE_TEXTS, clashing)))
    rows = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got)
    assert rows == Counter((i, *base_of(t)) for i, t in LICENSE_TEXTS)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_license_notices(spark):
    got = {r["doc_id"]: r for r in collect(licenses.license_report(documents(spark, LICENSE_TEXTS)))}
    assert got[8]["labels"] == "mit" and got[8]["score"] == 1.0
    assert got[9]["labels"] == "mit" and 0.8 <= got[9]["score"] < 1.0  # one word differs, one is put in
    assert got[6]["labels"] == "" and got[6]["score"] == 0.0
    assert set(got[1]["labels"].split(",")) == {"cc-by", "reserved"}
    versions = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "GNU general public license version 2 or later")]
    assert {r["doc_id"]: r["labels"] for r in collect(licenses.license_report(documents(spark, versions)))} == {1: "gpl,gpl-3.0", 2: "gpl,gpl-2.0"}


def test_license_empty_table(spark):
    assert collect(licenses.license_report(documents(spark, []))) == []


MIX = [(i, prose(i, 5 + 13 * i % 90), "en", f"s{i % 4}") for i in range(80)]
MIX += [(100, None, "en", "s1"), (101, "", "en", None), (102, prose(7, 400), "en", None), (5, MIX[5][1], "en", "s1"), (None, "a b c", "en", "s0"),
        (103, "  one\x0btwo", "en", "é"), (104, prose(9, 3000), "en", "hot")]


def targets_of(rows):
    """Shares by weight; what is above twice the size is reshared until none is."""
    size = Counter()
    for _, text, _, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    total, held = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in held]
        level = (total - sum(2.0 * size[s] for s in held)) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if level * weight[s] > 2.0 * size[s]]
        if not above:
            return size, {s: 2.0 * size[s] if s in held else level * weight[s] for s in names}
        held |= set(above)


@pytest.mark.parametrize("clashing", [False, True])
def test_mix_targets_and_taken(spark, clashing):
    docs = documents(spark, MIX, clashing)
    size, target = targets_of(MIX)
    got = collect(mixing.source_targets(mixing.sizes(docs)))
    assert {r["source"] for r in got} == set(size)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
    spans, _, taken = mixing.mix_sources(docs, block=8)
    rows = collect(mixing.mix_report(docs, block=8))
    assert len(rows) == len(MIX)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    per = {s: 0 for s in size}
    for r in collect(taken):
        per[r["source"]] += r["hi"] - r["lo"]
    for s, t in target.items():
        assert abs(per[s] - t) <= 16
    # every slot of the mix has one place
    places = [(r["shard"], r["place"]) for r in collect(taken.select("shard", "place").distinct())]
    assert len(places) == len(set(places))


def test_mix_reruns_agree(spark):
    docs = documents(spark, MIX)
    a, b = (sorted(map(str, collect(mixing.mix_report(d)))) for d in (docs, docs.repartition(5).orderBy(F.rand(1))))
    assert a == b


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 7, 64, 65, 1000):
        df = mixing.domain(spark.range(n), "p", F.lit(n).cast("long"), F.lit(n * 17).cast("long"))
        assert sorted(r["o"] for r in mixing.permute(df, "o", F.col("id"), "p").collect()) == list(range(n))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = documents(spark, MIX)
    taken = Counter()
    for r in collect(mixing.mix_report(docs)):
        taken[r["doc_id"]] += r["taken"]
    words = Counter()
    texts = {}
    for r in collect(mixing.mixed_documents(docs)):
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        texts.setdefault(r["doc_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert words == Counter({k: v for k, v in taken.items() if v})
    whole = dict((i, t) for i, t, *_ in MIX)
    assert all(any(x in whole[i] for x in t) for i, t in texts.items() if len(t) > 1)


def test_mix_empty(spark):
    empty = documents(spark, [])
    assert collect(mixing.mix_report(empty)) == [] and collect(mixing.mixed_documents(empty)) == []


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


MAGIC = "WARC/1.1\r\n"
TRAP = "<pre>" + MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + MAGIC + "Content-Length: 9999999\r\n\r\n</pre>"
BIG = "é" * 700
PAGES = [(1, "http://a/\r\nx: y", BIG), (2, None, BIG), (7, "u", BIG), (3, "u", None), (4, "u", ""), (5, "u", TRAP), (6, "u", MAGIC * 3),
         (8, "u", "small"), (9, "u", "small"), (10, "u", "x\r\n\r\n" + "y" * 200_000), (11, "u", TRAP + "y" * 3000), (12, "u", TRAP + "y" * 3000),
         (7, "u", BIG), (None, "u", BIG)]


def test_warc_round_trip(spark, scratch):
    path = scratch + "/warc"
    warc.write_warc(pages(spark, PAGES), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # records and traps straddle splits
    try:
        records = collect(warc.read_warc(spark, path))
        rows = collect(warc.page_records(warc.read_warc(spark, path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    top = {}
    for i, _, h in PAGES:
        if h and len(h.encode()) >= 1000 and i is not None:
            top[h] = max(top.get(h, i), i)
    expect = Counter()
    for i, _, h in PAGES:
        b = (h or "").encode()
        revisit = i is not None and top.get(h, i) > i
        expect[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top[h] if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == expect
    bodies = Counter(bytes(r["payload"]) for r in records)
    responses = Counter((h or "").encode() for i, _, h in PAGES if i is None or top.get(h, i) == i)
    responses[b""] += sum(1 for i, _, h in PAGES if i is not None and top.get(h, i) > i)
    assert bodies == responses


def test_warc_broken_chain_raises(spark, scratch):
    path = scratch + "/warc"
    spark.createDataFrame([(MAGIC + "Content-Length: 50\r\n\r\nshort",)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(ValueError, match="broken record chain"):
        warc.read_warc(spark, path)


def test_warc_empty(spark, scratch):
    warc.write_warc(pages(spark, []), scratch + "/warc")
    assert collect(warc.read_warc(spark, scratch + "/warc")) == []
