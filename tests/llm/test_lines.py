"""Line dedup against brute force, through insertions and deletions."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterfold.llm import cuckoo, op11_lines
from quarterfold.sources.scratch import fresh_path
from tests.llm.helpers import odd_documents, odd_texts

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    holders = defaultdict(set)
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(FOLD) for line in (t or "").split("\n")] for _, t in rows]
    for (i, _), of in zip(rows, keys, strict=True):
        for key in of:
            if len(key) >= 10 and i is not None:
                holders[key].add(i)
    out = []
    for (i, t), of in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, of, strict=True) if i is None or len(k) < 10 or min(holders[k]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(index, docs):
    got = index.kept(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    return sorted(map(tuple, got.collect()), key=str)


def texts(n, seed):
    r = random.Random(seed)
    common = [f"a common line number {k}" for k in range(40)] + ["short", "", "  \t", "exactly 10", " exactly 10\r", "EXACTLY 10", "ninechars"]
    return [(seed * 1000 + k, "\n".join(r.choice(common) if r.random() < 0.4 else f"line {r.random()} of its own" for _ in range(r.randrange(9))) or None)
            for k in range(n)]


@pytest.mark.parametrize("rows", [odd_texts(), [], [(1, "one line is here\n" * 3)] * 3 + [(None, "one line is here"), (0, "One line is HERE ")]])
def test_odd_rows(spark, rows):
    rows = [*rows, *((50 + k, f"\x0ba line like another\nx\n\n{'very common line ' * 3} ") for k in range(9))] if rows else rows
    docs = odd_documents(spark, rows)
    index = op11_lines.LineIndex(spark, fresh_path(spark, "lines"), shards=3)
    index.insert(docs)
    assert found(index, docs) == expected(rows)


@pytest.mark.parametrize("bits", [0xFFFFFFFF, 0x7])
def test_insertions_and_deletions(spark, monkeypatch, bits):
    """Also with fingerprints so short that filters take many new keys for known ones."""
    monkeypatch.setattr(cuckoo, "PRINT", bits)
    path, rows = fresh_path(spark, "lines"), []
    index = op11_lines.LineIndex(spark, path, shards=2, buckets=16)  # many segments
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")

    def check():
        assert found(op11_lines.LineIndex(spark, path), frame(rows)) == expected(rows)

    for seed in (3, 1):  # smaller ids come later
        rows += texts(60, seed)
        index.insert(frame(rows))  # those already there are passed over
        check()
    gone = [i for i, _ in rows if i % 3 == 0] + [999_999]
    index.delete(frame([(i, "") for i in gone]))
    rows = [r for r in rows if r[0] not in gone]
    check()
    again = [(i, t) for i, t in texts(60, 1) if i % 3 == 0]
    index.insert(frame(again))
    rows += again
    check()
    index.delete(frame(rows))
    fingerprints = sum(np.count_nonzero(np.frombuffer(r["filter"], np.uint32)) for r in index._filters().collect())
    assert fingerprints == 0 and index.held().count() == 0


def test_an_operation_that_broke_off_is_not_read(spark):
    rows, frame = texts(20, 5), lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = op11_lines.LineIndex(spark, fresh_path(spark, "lines"), shards=2)
    index.insert(frame(rows))
    index._committed = lambda version: None
    index.insert(frame(texts(20, 4)))
    index.delete(frame(rows))
    del index._committed
    assert found(index, frame(rows)) == expected(rows)
    assert index.insert(frame(texts(20, 4))) == 4
    assert found(index, frame(rows + texts(20, 4))) == expected(rows + texts(20, 4))


@pytest.mark.parametrize("n", [0, 1, 500, 20000])
def test_cuckoo_filter(n):
    r = np.random.default_rng(n)
    keys, others = np.unique(r.integers(-(2**63), 2**63, n)), r.integers(-(2**63), 2**63, 5000)
    f = cuckoo.Cuckoo(256)
    for part in np.array_split(keys, 7):
        f.insert(part)
    f = cuckoo.Cuckoo(256, f.to_bytes())
    assert f.contains(keys).all() and f.contains(others).mean() < 0.001
    assert sum(np.count_nonzero(s) for s in f.segments) == len(keys)
    assert len(f.segments) <= len(keys) / (256 * cuckoo.SLOTS * 0.85) + 1
    f.delete(keys[::2])
    assert f.contains(keys[1::2]).all()
    assert sum(np.count_nonzero(s) for s in f.segments) == len(keys) // 2
    with pytest.raises(ValueError):
        f.delete(others)
