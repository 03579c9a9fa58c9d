"""Exact, passage and similarity deduplication against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarterfold.llm import op3_substrings, op6_exact, op7_jaccard, wordhash
from quarterfold.llm.components import components
from tests.llm.helpers import odd_documents, odd_texts, prose, rows_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [odd_texts(), [], [(1, "a")] * 3])
def test_exact(spark, rows):
    got = op6_exact.exact_dedup(odd_documents(spark, rows))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256") == exact(rows)
    kept = [r for r in got.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got.collect()})
    assert all(r.doc_id == r.keep_id for r in kept)


def passages(rows):
    words = [(t or "").encode().split() for _, t in rows]
    n = op3_substrings.WINDOW
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for a in range(len(w) - n + 1) if seen[tuple(w[a : a + n])] > 1 for j in range(a, a + n)}
        left = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_cover_has_every_difference():
    p, cover = op3_substrings.PERIOD, op3_substrings.COVER
    assert {(a - b) % p for a in cover for b in cover} == set(range(p))
    assert op3_substrings.ANCHOR + p - 1 == op3_substrings.WINDOW


@pytest.mark.parametrize("rows", [odd_texts(), []])
def test_passages(spark, rows):
    got = op3_substrings.substring_dedup(odd_documents(spark, rows))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == passages(rows)


def test_passages_at_every_offset(spark):
    shared = prose(50, 36)
    rows = [(k, f"{prose(100 + k, k)} {shared} {prose(200 + k, 30 - k)}") for k in range(25)]
    rows += [(100, prose(51, 34)), (101, prose(51, 34)), (102, f"{prose(52, 35)} {prose(52, 35)}")]
    got = op3_substrings.substring_dedup(odd_documents(spark, rows))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == passages(rows)


def linked(rows, n, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            both = len(x & y)
            if None not in (rows[a][0], rows[b][0]) and both and 100 * both >= percent * (len(x) + len(y) - both):
                lo, hi = sorted((top(rows[a][0]), top(rows[b][0])))
                parent[hi] = lo
    return sorted(((i, len(s), top(i) if i is not None else None) for (i, _), s in zip(rows, sets, strict=True)), key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_similarity(spark, n, percent):
    rows = odd_texts()
    got = op7_jaccard.jaccard_components(odd_documents(spark, rows), n, percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == linked(rows, n, percent)


def test_similarity_of_many_near_copies(spark):
    """More near copies than a list of rare tokens holds, some of which only reach each other over a third."""
    base = prose(60, 120).split()
    rows = []
    for k in range(40):
        w = list(base)
        for j in range(k % 5):
            w[(7 * k + 29 * j) % len(w)] = f"edit{k}{j}"
        rows.append((1000 - k, " ".join(w)))
    rows += [(k, prose(300 + k, 12 + k)) for k in range(30)] + [(k + 500, f"{prose(61, 10)} tail{k}") for k in range(20)]
    for n, percent in ((3, 90), (5, 80)):
        got = op7_jaccard.jaccard_components(odd_documents(spark, rows), n, percent)
        assert rows_of(got, "doc_id", "n_shingles", "component_id") == linked(rows, n, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_combination(percent):
    """Pairs just within the threshold, above all of few tokens, where cells are often empty."""
    rule, r, hollow = op7_jaccard.Rule(3, percent), np.random.default_rng(percent), 0
    for k in range(4000):
        size = int(r.integers(2, 25 if k % 4 else 400))
        both = r.integers(0, 2**64, size, dtype=np.uint64)
        spare = 100 * size // percent - size  # tokens that the sets may have besides
        left = int(r.integers(0, spare + 1))
        x, y = (np.unique(np.concatenate([both, r.integers(0, 2**64, n, dtype=np.uint64)])) for n in (left, spare - left))
        a, b = op7_jaccard.combinations(rule, x), op7_jaccard.combinations(rule, y)
        assert len(np.intersect1d(a, b))
        level = rule.level(len(x))
        hollow += len(np.unique((x >> np.uint64(32)) % np.uint64(rule.parts(level)))) < rule.parts(level)
    assert hollow > 100


def test_linked_sets_agree_in_an_empty_cell_alone():
    """Every cell that has tokens differs: found by a half of a cell, or by the empty cell."""
    rule, r = op7_jaccard.Rule(5, 80), np.random.default_rng(1)
    for k in range(2000):
        size = 5 + k % 36
        p = rule.parts(rule.level(size))
        cells = np.sort(r.permutation(p)[: min(size // 5, p - 1)])
        at = np.concatenate([cells, r.choice(cells, size - len(cells))]).astype(np.uint64)
        high = at + np.uint64(p) * r.integers(0, 2**31 // p, size, dtype=np.uint64)
        x = np.sort(high << np.uint64(32) | r.integers(0, 2**32, size, dtype=np.uint64))
        at = (x >> np.uint64(32)) % np.uint64(p)
        y = np.delete(x, [int(r.choice(np.flatnonzero(at == c))) for c in cells])  # one token less in each
        assert 100 * len(y) >= 80 * len(x) and rule.level(size) - rule.level(len(y)) in (0, 1)
        assert len(np.intersect1d(op7_jaccard.combinations(rule, x), op7_jaccard.combinations(rule, y)))


def test_sketches_tell_sets_apart_that_just_miss(spark):
    """Sets of 400 tokens that differ in a quarter more than linked ones may seldom pass the bound; linked ones always do."""
    rule, rng = op7_jaccard.Rule(5, 80), np.random.default_rng(7)
    rows = []
    for i in range(200):
        tokens = rng.integers(0, 1 << 63, 455, dtype=np.uint64)
        for kind, shared in (("far", 345), ("linked", 356)):
            sketches = []
            for s in (tokens[:400], np.concatenate([tokens[:shared], tokens[400 : 800 - shared]])):
                bits = np.bincount((s % np.uint64(op7_jaccard.SKETCH)).astype(np.int64), minlength=op7_jaccard.SKETCH) & 1
                sketches.append((400, np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()))
            rows.append((kind, *sketches))
    sketch = "struct<size: long, sketch: array<long>>"
    found = spark.createDataFrame(rows, f"kind string, x {sketch}, y {sketch}").where(op7_jaccard._near(rule, "x", "y"))
    passed = Counter(r.kind for r in found.collect())
    assert passed["linked"] == 200 and passed["far"] < 20


def test_similarity_of_nothing(spark):
    assert op7_jaccard.jaccard_components(odd_documents(spark, [])).count() == 0


def test_one_of_each_keeps_all_columns(spark):
    docs = odd_documents(spark)
    got = op7_jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} & {12, 13} == {12}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (103, 101), (7, 7), (200, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 200: 0, 100: 100, 101: 100, 103: 100}


def test_words_and_runs():
    import pyarrow as pa

    w = wordhash.words(pa.array(["a b\tc", None, "", "  a b ", "é x"]))
    assert w.counts.tolist() == [3, 0, 0, 2, 1]
    h = w.hashes()
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 4
    runs = wordhash.runs(h, 2)
    assert runs[0] == runs[3] and runs[0] != runs[1]
