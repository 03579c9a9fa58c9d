"""Classifiers on held-out rows, mixing and sharding against brute force, the pipeline, and what is registered."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from checks.compare import difference, duck
from quarterfold.llm import op1_quality, op2_shard, op4_mix, op5_toxicity, queries
from tests.llm.helpers import odd_documents, odd_texts, rows_of

SMALL = "/root/testdata/sf0.001"


def judged(spark, name, column, sf_dir="/root/testdata/sf0.01"):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = queries.QUERIES[name](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    return got, np.array([r[column] for r in got]), np.array([r.predicted for r in got])


def test_quality_on_held_out_rows(spark):
    got, y, p = judged(spark, "op1_quality", "quality")
    assert (y == p).mean() > 0.95
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == r.predicted for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)


def test_toxicity_on_held_out_rows(spark):
    got, y, p = judged(spark, "op5_toxicity", "toxic", "/root/testdata/sf0.1")
    assert p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.05
    assert all((r.score >= 0.3) == r.predicted for r in got)


@pytest.mark.parametrize("labels", [[(i, i % 2, i % 2, "x") for i in range(30)], []])
@pytest.mark.parametrize("rows", [odd_texts(), []])
def test_classifiers_bear_odd_rows(spark, rows, labels):
    docs = odd_documents(spark, rows)
    table = spark.createDataFrame(labels + [(None, None, None, None)], "doc_id long, quality int, toxic int, text string")
    for run in (op1_quality.quality, op5_toxicity.toxicity):
        got = run(docs, table)
        assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r.score <= 1 for r in got.collect())
    assert op5_toxicity.clean_documents(docs, table).columns == docs.columns


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    assert rows_of(op1_quality.quality(docs, labels), "doc_id", "score") == rows_of(op1_quality.quality(docs, turned), "doc_id", "score")


def test_segments_are_the_best_ones():
    r = random.Random(4)
    for _ in range(200):
        scores = [r.choice([2.0, 1.0, -0.5, -0.5, -0.5]) for _ in range(r.randrange(1, 25))]
        found = op5_toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0], -0.5)
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
        if max(scores) > 0:
            assert max(s for s, _, _ in found) == pytest.approx(best)
        assert all(sum(scores[a : b + 1]) == pytest.approx(s) for s, a, b in found)
        assert all(x[2] < y[1] for x, y in zip(found, found[1:]))


def brute_capacity(sizes, shards):
    """Over all contiguous partitions, by dynamic programming."""
    n, inf = len(sizes), float("inf")
    sums = [0, *np.cumsum(sizes).tolist()]
    best = [0] + [inf] * n
    for _ in range(shards):
        best = [0] + [min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(1, n + 1)]
    return best[n]


def test_smallest_capacity():
    r = random.Random(9)
    for _ in range(60):
        groups = sorted((r.choice([1, 2, 3, 5, 8, 40]) for _ in range(r.randrange(1, 30))), reverse=True)
        sizes = np.array(sorted(set(groups), reverse=True))
        counts = np.array([groups.count(s) for s in sizes])
        shards = r.randrange(1, 7)
        assert op2_shard.smallest_capacity(sizes, counts, shards) == brute_capacity(groups, shards)
        check_balance(groups, op2_shard.balanced_cuts(sizes, counts, shards), shards)


def check_balance(groups, cuts, shards):
    """From every shard on, the largest is as small as the order allows; none is empty while there are groups."""
    sizes = sorted(set(groups), reverse=True)
    at = [groups.index(sizes[i]) + k for i, k in cuts]
    parts = [groups[a:b] for a, b in zip([0, *at], [*at, len(groups)], strict=True)]
    assert sum(parts, []) == groups and all(parts) and len(parts) == min(shards, len(groups))
    for i in range(len(parts)):
        assert max(map(sum, parts[i:])) == brute_capacity(sum(parts[i:], []), shards - i)


@pytest.mark.parametrize("groups", [[1000] + [10] * 100, [7] * 20, [7] * 16, [7] * 5, [900] + [3] * 40 + [1] * 700, [5, 4, 3, 2, 1] * 30])
def test_shards_after_a_large_group_are_even(groups):
    groups = sorted(groups, reverse=True)
    sizes, counts = (np.array(x) for x in zip(*sorted(Counter(groups).items(), reverse=True), strict=True))
    check_balance(groups, op2_shard.balanced_cuts(sizes, counts, 16), 16)


@pytest.mark.parametrize("rows", [odd_texts(), [], [(i, "same") for i in range(40)], [(i, f"t{i}") for i in range(400)]])
def test_shards(spark, rows):
    got = op2_shard.shard(odd_documents(spark, rows)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, load, where = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        where[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values()) and all(0 <= s < 16 for s in slots)
    together = Counter()
    for _, t in rows:
        together[t or ""] += size(t)
    if rows:
        assert max(load.values()) == brute_capacity(sorted(together.values(), reverse=True), 16)
        assert len(load) == min(16, len(together))


def test_exponent_meets_its_target(spark):
    sources = spark.createDataFrame([(f"s{i}", t, t / 1000.0) for i, t in enumerate((700, 200, 90, 10))], "source string, tokens long, share double")
    j = op4_mix.exponent(sources, 2.0, None, None)
    ratio = lambda k: (700 / 10) ** (1 - k / op4_mix.LATTICE)
    assert ratio(j) <= 2.0 + 1e-9 < ratio(j - 1) + 1e-9

    def entropy(k):
        w = np.array([0.7, 0.2, 0.09, 0.01]) ** (k / op4_mix.LATTICE)
        w /= w.sum()
        return -(w * np.log(w)).sum()

    j = op4_mix.exponent(sources, None, 1.0, None)
    assert entropy(j) <= 1.0 < entropy(j - 1)


@pytest.mark.parametrize("budget", [None, 20000])
def test_mix_bears_odd_rows(spark, budget):
    rows = odd_texts()
    docs = odd_documents(spark, rows)
    got = op4_mix.mix(docs, budget=budget).collect()
    tokens, used = Counter(), Counter()
    for r in docs.collect():
        tokens[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    for r in got:
        used[r.source] += r.n_tokens
    if budget is None:
        assert {r.doc_id for r in got} == {i for i, _ in rows}
        assert all(tokens[s] <= used[s] <= 2 * tokens[s] for s in tokens)
    else:
        assert sum(used.values()) <= budget
    again = op4_mix.mixed_documents(docs, budget=budget)
    assert again.columns == docs.columns
    if budget is None:
        assert {r.doc_id for r in again.collect()} == {i for i, _ in rows}
    assert op4_mix.mix(odd_documents(spark, [])).count() == 0
    assert op4_mix.mixed_documents(odd_documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.SQL[name]) is None


def test_registered():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_pipeline(spark):
    """Every stage against what its operator says of its own input."""
    from quarterfold.llm import op7_jaccard, op9_decontaminate

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        ids = {r.doc_id for r in after.collect()}
        if name == "toxicity":
            assert ids == {r.doc_id for r in op5_toxicity.toxicity(docs, labels).where("predicted = 0").collect()}
        if name == "near_duplicates":
            assert ids == {r.component_id for r in op7_jaccard.jaccard_components(docs, 5, 80).collect()}
        if name == "decontamination":
            assert ids == {r.doc_id for r in op9_decontaminate.contamination(docs, items).where("NOT contaminated").collect()}
        if name == "mixing":
            assert ids == {r.doc_id for r in docs.collect()}
        if name == "sharding":
            assert after.count() == docs.count() and after.select("shard").distinct().count() == 16
        else:
            assert after.columns == docs.columns
        docs = after
    assert rows_of(corpus_pipeline.run(spark, SMALL), "doc_id", "shard", "slot") == rows_of(docs, "doc_id", "shard", "slot")


def test_stages_with_clashing_columns(spark):
    """Nulls, repeated rows, and columns named like the helpers': the same rows, all columns as they were."""
    from quarterfold.llm import op7_jaccard, op9_decontaminate

    names = ["_s", "_id", "_src", "_whole", "_time", "_n", "_gone", "_key", "_second", "key", "second", "source_", "n", "passes"]
    plain = odd_documents(spark).select("doc_id", "text", "source")
    clashing = plain.select("*", *[F.lit(f"z{i}").alias(n) for i, n in enumerate(names)])
    items = spark.createDataFrame([(1, odd_texts()[14][1]), (2, None)], "item_id long, text string")
    for stage in (op4_mix.mixed_documents, op7_jaccard.one_of_each, lambda d: op9_decontaminate.uncontaminated(d, items)):
        got = stage(clashing)
        assert got.columns == clashing.columns
        assert rows_of(got, "doc_id", "text", "source") == rows_of(stage(plain), "doc_id", "text", "source")
        assert all(r[n] == f"z{i}" for r in got.collect() for i, n in enumerate(names))
        assert stage(clashing.limit(0)).count() == 0


def test_chances_of_passages_in_clean_words_are_about_right():
    """Words at random as a clean text has them: few texts have a passage that is rare by K and L."""
    rng, shares, other = np.random.default_rng(5), {2.0: 0.01, 3.0: 0.005, 4.0: 0.002}, -0.3
    low, high = 0.0, 5.0
    for _ in range(60):
        rate = (low + high) / 2
        mean = sum(p * np.exp(rate * s) for s, p in shares.items()) + (1 - sum(shares.values())) * np.exp(rate * other)
        low, high = (rate, high) if mean < 1 else (low, rate)

    def best(n):
        drawn = rng.choice([*shares, other], n, p=[*shares.values(), 1 - sum(shares.values())])
        hits = [(i, float(s)) for i, s in enumerate(drawn) if s > 0]
        return max((s for s, _, _ in op5_toxicity.segments(hits, other)), default=0.0) if hits else 0.0

    lengths = rng.integers(100, 600, 1500).astype(float)
    fitted, judged = (np.array([best(int(n)) for n in lengths]) for _ in range(2))
    k = op5_toxicity.extreme_value_k(rate, lengths, fitted, 1.0)
    chance = 1 - np.exp(-k * lengths * np.exp(-rate * judged))
    for level in (0.5, 0.2, 0.1, 0.05):
        assert 0.4 * level < (chance <= level).mean() < 1.8 * level
    assert op5_toxicity.extreme_value_k(rate, np.zeros(0), np.zeros(0), 0.25) == 0.25
