"""Extraction, nearest neighbours, fingerprints, near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import fingerprints, mainhtml, neardup, neighbours, textvec
from tests.llm.fixtures import collect, documents, edited, prose

# main text


def test_extract_article(spark):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar">
    <header class=site-header><p>The daily page brings you the news of every day and night</p></header><nav><a href=x>Home</a></nav>
    <div class="cookie-banner"><p>We use cookies on this page for many good reasons that we list here</p></div>
    <article><h1>A &amp; B&nbsp;title</h1><p><b>Bold start.<br>Second&#32;line <a href=q>with a link</a> and more words.<p>A second paragraph
    without an end tag, a &lt;tag&gt; and 3 < 4.<div class=ad>Buy now</div><form><p>Your mail address here please</p></form>
    <ul><li>First point of it</li><li>Second point of it</li></ul><div id="comments"><p>A reader wrote this long comment about the story.</p></div>
    </article><aside><p>Other stories that were read by many people today.</p></aside><footer>&copy; 2024 All rights reserved by us</footer>"""
    got = collect(mainhtml.extract(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")))[0]
    assert got["text"] == ("A & B title\nBold start. Second line with a link and more words.\n"
                           "A second paragraph without an end tag, a <tag> and 3 < 4.\nFirst point of it\nSecond point of it")
    assert got["n_chars"] == len(got["text"])


def test_extract_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav>a b c</nav>"), (4, "u", "<p unclosed"), (5, "u", "<article><p>x " + "y " * 200_000),
            (6, "u", "<article><script>" + "z" * 100), (7, "u", "<article><p title=\"a>b\">It is here.</p></b></i></article>"), (None, "u", "<!-- c"),
            (7, "u", "<article><p title=\"a>b\">It is here.</p></b></i></article>")]
    got = collect(mainhtml.extract(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[3]["text"] == by[6]["text"] == ""
    assert by[5]["n_chars"] == 1 + 2 * 200_000 and by[7]["text"] == "It is here."
    assert collect(mainhtml.extract(spark.createDataFrame([], "page_id long, url string, html string"))) == []


@pytest.mark.parametrize("before", [
    "<datalist><option value=a><option value=b></datalist>", "<select><optgroup label=x><option>a<option>b<optgroup><option>c</select>",
    "<div><button>Share</div>", "<button>Menu", "<div><video src=x></div>", "<video src=x>", "<div><button>A<button>B</div>", "<p><svg><path d=x></p>",
    "<select><option>a</option><option>b", "<div><object><canvas></div>", "<noscript><img src=x>", "<button/><svg/>",
    "<svg><svg></svg><text>no</text></svg>", "<video><p>no</p><option></video>", "<BUTTON><div>no</div></BUTTON >", "<div><button></div></button>"])
def test_extract_goes_on_after_unclosed_elements(before):
    tree = mainhtml.train_tree()
    rest = "<article><p>The first line of the story.</p><div><button>no</button><select><option>no</select></div><p>Its second line.</p></article>"
    expect = "The first line of the story.\nIts second line."
    assert mainhtml.main_text(before + rest, tree) == expect
    assert mainhtml.main_text(f"<html><body>{before}{rest}</body></html>", tree) == expect
    assert mainhtml.main_text("<article><p>The first line of the story.</p><textarea><p>no</p></article>", tree) == "The first line of the story."


def test_tree_on_labelled_pages_it_has_not_seen():
    """Blocks of other pages against their labels, the brute-force labeller."""
    tree = mainhtml.train_tree()
    lost = wrong = n = 0
    for seed in (11, 12):
        for page in mainhtml.labelled_pages(300, seed):
            for b in mainhtml.blocks(page):
                main, kept = b["label"] == "main", mainhtml.keeps(tree, mainhtml.row(b))
                n, wrong = n + 1, wrong + (main != kept)
                lost += main and not kept and b["words"] >= 15
    assert n > 4000 and wrong <= 0.01 * n and lost <= 0.001 * n
    used = set()

    def walk(t):
        if not isinstance(t, int):
            used.add(mainhtml.FEATURES[t[0]])
            walk(t[2])
            walk(t[3])
    walk(tree)
    assert {"words", "links", "links_around", "links_after", "aside"} <= used


LONG = "The river rose in the night and by the morning the lower fields were under water, so the farmers moved their herds up the hill."


@pytest.mark.parametrize("page,expect", [
    (f"<div class=post><h1>T</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div class=foot><a>t</a></div>", f"T\n{LONG}\nYes.\n{LONG}"),
    (f"{LONG} {LONG}", f"{LONG} {LONG}"),
    (f"<main><p>{LONG}</p><p class=\"share-price\">{LONG}</p></main>", f"{LONG}\n{LONG}"),
    (f"<p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n{LONG}"),
    (f"<div class=content><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p></article><section><h3>Comments</h3><p>{LONG}</p></section>", LONG),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div><h3>2 Comments</h3><div><p>{LONG}</p></div></div>", f"{LONG}\n{LONG}"),
    (f"<header><h2>The Page</h2><p>{LONG}</p></header><article><header><h1>T</h1><p>{LONG}</p></header><p>{LONG}</p></article>", f"T\n{LONG}\n{LONG}"),
])
def test_extract_keeps_every_paragraph_of_the_article(page, expect):
    assert mainhtml.main_text(page, mainhtml.train_tree()) == expect


@pytest.mark.parametrize("page", [
    "<div>" * 40_000 + "x" + "</span>" * 40_000, "<a " * 200_000, "<a href=x>" * 40_000 + "</b>" * 40_000, "<b class=x>" + "<a href=x>" * 40_000 + "</b>" * 40_000,
    "<div>" * 40_000 + "x" + "</div>" * 80_000, "<p>" * 100_000 + "x", "<!--" * 50_000])
def test_extract_is_linear_in_deep_pages(page):
    began = time.time()
    mainhtml.main_text(page, mainhtml.train_tree())
    assert time.time() - began < 10


# nearest neighbours


def brute_nearest(rows, k=5, step=50):
    good = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows)
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, v in good:
        if i is None or i % step:
            continue
        scored = []
        for m, j, w in good:
            if m != n and len(w) == len(v):
                score = sum(a * b for a, b in zip(v, w)) / (math.sqrt(sum(a * a for a in v)) * math.sqrt(sum(b * b for b in w)))
                scored.append((-score, j if j is not None else 1 << 62, j))
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_matches_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "STRIPE_TILES", 1)
    r = np.random.default_rng(5)
    hot = r.normal(size=8).astype(np.float32).tolist()
    rows = [(i, hot if i % 3 == 0 else r.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000, None), (1050, []), (1100, [0.0] * 8), (1150, [1.0, float("nan")] + [0.0] * 6), (1200, [1.0, None] + [0.0] * 6),
             (1250, [float("inf")] + [1.0] * 7), (1300, [1.0, 2.0]), (1301, [2.0, 1.0]), (None, hot), (100, rows[100][1]), (1350, [3.0, 4.0, 5.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, uid string").repartition(3)
    got = sorted((x["query_id"], x["rank"], x["vec_id"] if x["vec_id"] is not None else -1, x["score"]) for x in collect(neighbours.nearest(df)))
    expect = sorted((a, b, c if c is not None else -1, s) for a, b, c, s in brute_nearest(rows))
    assert [g[:3] for g in got] == [e[:3] for e in expect]
    assert [g[3] for g in got] == [e[3] for e in expect]  # the very same doubles


def test_nearest_empty(spark):
    assert collect(neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"))) == []


# fingerprints

TEXTS = [(5, "café " * 40), (1, None), (2, ""), (3, "a"), (3, "ab"), (9, prose(1, 900)), (10, edited(prose(1, 900), 2, 20)), (None, "null id \U0001f600"),
         (11, prose(1, 900)), (12, prose(4, 60_000))] + [(100 + i, prose(i, 30 + i)) for i in range(60)]


def test_fingerprints_of_edited_texts(spark):
    got = collect(fingerprints.fingerprint_neighbours(documents(spark, TEXTS, clashing=True).repartition(4)))
    assert len(got) == len(TEXTS)
    # equal ids are ordered by a hash of the text: take that order from the result
    unique = [(i, t or "") for i, t in TEXTS if i != 3]
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 3}
    order = sorted(unique, key=lambda x: (x[0] is not None, x[0] or 0))
    for (i, t), (j, n) in zip(order, order[1:] + order[:1]):
        assert by[i]["n_chars"] == len(t)
        if 3 not in range(i or 0, (j or 0)):
            half = len(t) // 2
            assert by[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
            assert by[i]["near_next"] == fingerprints.likeness(by[i]["fingerprint"], by[j]["fingerprint"])
        assert by[i]["near_edited"] == fingerprints.likeness(by[i]["fingerprint"], by[i]["edited_fingerprint"])
    assert by[9]["fingerprint"] == by[11]["fingerprint"]
    assert fingerprints.likeness(by[9]["fingerprint"], by[10]["fingerprint"]) > 0.7


def test_fingerprint_counts_are_those_of_a_loop():
    texts = ["", "ab", "abcabc", "x" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    counts = fingerprints.triplet_counts(data, offsets)
    assert counts.sum(axis=1).tolist() == [max(0, len(t) - 2) for t in texts]
    assert (counts[2] > 0).sum() == 3 and sorted(counts[2][counts[2] > 0].tolist()) == [1, 1, 2] and counts[3].max() == 48


@pytest.mark.parametrize("rows", [[], [(4, "only one text here")], [(4, None)]])
def test_fingerprint_few_rows(spark, rows):
    got = collect(fingerprints.fingerprint_neighbours(documents(spark, rows)))
    assert len(got) == len(rows)
    for r, (_, t) in zip(got, rows):
        t = t or ""
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - len(t) // 2] + t[:len(t) // 2]).encode()).hexdigest() and r["near_next"] == 1.0


# near-duplicates


def jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def near_rows():
    rows, n = [], 0
    for family in range(12):
        base = prose(family, 300, 5000)
        for copy in range(1 + family):
            rows.append((n, edited(base, 50 * family + copy, copy % 8)))
            n += 1
    shared = prose(999, 60, 5000)
    rows += [(n + i, prose(2000 + i, 90, 5000) + " " + shared) for i in range(40)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (2, rows[2][1]), (1002, None), (1003, ""), (None, rows[3][1]), (1004, "one two"), (1005, "one two"),
             (1006, prose(77, 20_000))]
    return rows


def classes_of(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i][1] or "", rows[j][1] or "") >= 0.8:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return {frozenset(g) for g in groups.values()}


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    got = collect(neardup.near_duplicates(documents(spark, rows, clashing=True).repartition(3)))
    assert len(got) == len(rows)
    class_of = {}
    for g in classes_of(rows):
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            class_of[rows[i][0]] = min(ids)
    assert {r["doc_id"]: r["class_id"] for r in got} == class_of
    assert {r["doc_id"] for r in got if r["kept"]} == set(class_of.values())


def test_near_duplicates_dissimilar_members_of_a_sketch(spark):
    """Members that fail their leader meet the members of other classes."""
    base = prose(5, 120, 5000).split()
    rows = []
    for i in range(12):  # pairs of near copies that share half their words with all others
        own = prose(100 + i, 60, 5000).split()
        rows += [(2 * i, " ".join(base[:60] + own)), (2 * i + 1, " ".join(base[:60] + own[:-1] + ["end"]))]
    got = {r["doc_id"]: r["class_id"] for r in collect(neardup.near_duplicates(documents(spark, rows)))}
    assert got == {i: i - i % 2 for i in range(24)}


def test_drop_near_duplicates_keeps_one_of_each(spark):
    rows = near_rows()
    kept = collect(neardup.drop_near_duplicates(documents(spark, rows)))
    assert len(kept) == len(classes_of(rows)) and len({r["doc_id"] for r in kept}) == len(kept)
    texts = {(i, t) for i, t in rows}
    assert all((r["doc_id"], r["text"]) in texts for r in kept)


def test_bitmap_bounds_what_is_shared():
    r = np.random.default_rng(1)
    for _ in range(50):
        a = r.integers(0, 1 << 63, 200, dtype=np.uint64)
        b = np.concatenate([a[:150], r.integers(0, 1 << 63, 60, dtype=np.uint64)])
        x, y = neardup.bitmap(a).view(np.uint64), neardup.bitmap(b).view(np.uint64)
        only = sum(int(v).bit_count() for v in (x & ~y))
        assert only <= len(set(a.tolist()) - set(b.tolist())) and only >= 30


def test_near_duplicates_empty(spark):
    assert collect(neardup.near_duplicates(documents(spark, []))) == []
    assert collect(neardup.drop_near_duplicates(documents(spark, [(1, "a b c d e f g")])))[0]["doc_id"] == 1


def test_similarity_is_order_aware_jaccard():
    r = random.Random(3)
    for _ in range(50):
        a = [r.randrange(1 << 60) for _ in range(40)]
        b = [x for x in a if r.random() > 0.05] + [r.randrange(1 << 60)]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        expect = len(set(a) & set(b)) / len(set(a) | set(b))
        assert neardup.similarity(x, y) == pytest.approx(expect if expect >= 0.8 else neardup.similarity(x, y))
    moved = np.array(a[20:] + a[:20], np.uint64)
    assert neardup.similarity(np.array(a, np.uint64), moved) < 0.8


def test_similarity_of_exactly_the_threshold(spark):
    for k in range(1, 1000):
        a = np.arange(5 * k, dtype=np.uint64)
        assert neardup.similarity(a[:4 * k], a) == neardup.similarity(a, a[k:]) == 0.8
        assert neardup.similarity(a[:4 * k - 1], a) < 0.8
    k = spark.range(1, 4000).select((F.col("id") * 4).alias("shared"), (F.col("id") * 9).alias("total"))
    assert k.filter(~neardup.enough(F.col("shared"), F.col("total"))).isEmpty()
    assert k.filter(neardup.enough(F.col("shared") - 1, F.col("total"))).isEmpty()
    words = prose(8, 39, 5000).split()
    got = collect(neardup.near_duplicates(documents(spark, [(1, " ".join(words[:32])), (2, " ".join(words))])))
    assert {r["class_id"] for r in got} == {1}


def test_short_similar_texts_share_a_key():
    """Every pair of texts of 4k and 5k shingles, of which one is the head, tail or middle of the other."""
    import pyarrow as pa
    texts = []
    for seed in range(3000):
        k = 1 + seed % 4
        words = prose(seed, 5 * k + 4, 10**6).split()
        lo = seed % (k + 1)
        texts += [" ".join(words), " ".join(words[lo:lo + 4 * k + 4])]
    ids = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["doc_id", "uid", "text"])
    keys = [set(k) for b in neardup._sketch_rows([batch]) for k in b.column("keys").to_pylist()]
    assert not [i for i in range(0, len(keys), 2) if not keys[i] & keys[i + 1]]


# the shared text helpers


def test_word_hashes_match_a_loop(monkeypatch):
    import pyarrow as pa
    texts = ["", "one two  one", None, "x" * 500 + " y", "café,café;1a", "  ", "one"]
    for piece in (16, 1 << 20):
        monkeypatch.setattr(textvec, "PIECE", piece)
        data, offsets = textvec.utf8(pa.array(texts))
        hashes, at = textvec.word_hashes(data, offsets)
        seen = {}
        for i, t in enumerate(texts):
            words = "".join(c if c.isalnum() else " " for c in (t or "")).split()
            got = hashes[at[i]:at[i + 1]].tolist()
            assert len(got) == len(words)
            for w, h in zip(words, got):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)
