"""The Merkle manifest against a tree built node by node."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from quarterfold.llm import op13_merkle
from tests.llm.helpers import odd_texts

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, d string, tag long, g int, i int, proof string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*map(field, (row[0], row[2], row[3], row[4])), field(text))


def tree(nodes):
    """Root, and for every leaf what stands before and after it level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] // 3 * 3
            run = nodes[first : first + 3]
            path.append(("".join(run[: at[k] - first]), "".join(run[at[k] - first + 1 :])))
            at[k] //= 3
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[2] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in sources]
    trees = [tree([leaf(r, r[1]) for r in g]) for g in groups]
    if not trees:
        return []
    root, tops = tree([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops, strict=True):
        for r, path in zip(group, paths, strict=True):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            d = leaf(r, text)
            for before, after in path + top:
                d = h(before, d, after)
            out.append((r[0], leaf(r, r[1]), subroot, root, h(*[a + b for a, b in path + top]), d, d == root))
    return sorted(out, key=str)


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], SCHEMA)


def checked(spark, rows):
    docs = documents(spark, rows)
    got = op13_merkle.manifest(docs, op13_merkle.tampered(F.col("text"), F.col("doc_id"))).drop("proof")
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_odd_rows(spark):
    """Null ids, texts, sources, languages; repeated rows and ids; a long text."""
    texts = [*odd_texts(), (30, "a\nb"), (31, "\n"), (32, "line\nline\n")]
    checked(spark, [(i, t, None if k % 4 == 0 else f"sé{k % 3}", None if k % 5 == 0 else "en", k if k % 3 else None) for k, (i, t) in enumerate(texts)])


@pytest.mark.parametrize("n", [0, 1, 2, 4, 10])
def test_few_rows(spark, n):
    checked(spark, [(k, f"{k}\n", "s", "en", 1) for k in range(n)])


def test_more_storeys_than_one(spark, monkeypatch):
    """With blocks of nine rows, sources of every size up to a hundred, and thirty sources."""
    monkeypatch.setattr(op13_merkle, "LEVELS", 2)
    monkeypatch.setattr(op13_merkle, "BLOCK", 9)
    rows = [(k, f"t{k}\n", "hot", "en", k) for k in range(100)]
    rows += [(1000 + k, f"t{k}", f"s{(k * k) % 29}", "de", None) for k in range(200)]
    checked(spark, rows)


def test_a_changed_row_fails(spark):
    docs = documents(spark, [(k, f"t{k}", f"s{k % 3}", "en", 1) for k in range(20)])
    same = op13_merkle.manifest(docs)
    assert same.where("verified").count() == 20
    changed = op13_merkle.manifest(docs, F.when(F.col("doc_id") == 7, "other").otherwise(F.col("text")))
    assert [r.doc_id for r in changed.where("NOT verified").collect()] == [7]
