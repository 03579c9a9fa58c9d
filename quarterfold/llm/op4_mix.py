"""Mixing sources to target weights by temperature.

The token share p of a source becomes a weight proportional to p**t. The exponent is bisected on a
lattice of steps of 2**-20 until the mix meets a repetition limit or a target entropy. The weights
times a budget of tokens say how often each source is passed over; a pass is a permutation of the
source's rows by hash, the last one is cut where the budget ends, and every block of the mix holds
an equal slice of each source's budget. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm.common import WORD, free_names, table, text_of, written

LATTICE = 2**20
HALVINGS = 4  # of the interval in one job
BUCKETS = 4096  # of a pass, for running sums of tokens
MOST_PASSES = 2.0
BLOCKS = 64


def _mixes(sources: DataFrame, exponents: list[int], budget: int | None) -> list[tuple[float, float]]:
    """For each exponent on the lattice: the largest number of passes and the entropy of the weights."""
    t = [j / LATTICE for j in exponents]
    share = F.col("share")
    sums = [F.sum(F.pow(share, F.lit(x))).alias(f"z{i}") for i, x in enumerate(t)]
    logs = [F.sum(F.pow(share, F.lit(x)) * F.log(share)).alias(f"l{i}") for i, x in enumerate(t)]
    odds = [g(F.pow(share, F.lit(x - 1))).alias(f"{n}{i}") for i, x in enumerate(t) for n, g in (("a", F.min), ("b", F.max))]
    r = sources.agg(F.sum("tokens").alias("tokens"), *sums, *logs, *odds).first()
    return [(
        r[f"b{i}"] / r[f"a{i}"] if budget is None else r[f"b{i}"] / r[f"z{i}"] * budget / r["tokens"],
        math.log(r[f"z{i}"]) - x * r[f"l{i}"] / r[f"z{i}"],
    ) for i, x in enumerate(t)]


def exponent(sources: DataFrame, most_passes: float | None, entropy: float | None, budget: int | None) -> int:
    """The smallest exponent, in steps of the lattice, that keeps within ``most_passes``, or whose entropy is at most
    ``entropy``; both fall as it grows. 1 (plain shares) if none does."""
    low, high, parts = 0, LATTICE, 2**HALVINGS
    while low < high:
        tried = sorted({low + (high - low) * i // parts for i in range(parts)})
        for j, (passes, h) in zip(tried, _mixes(sources, tried, budget), strict=True):
            if (passes <= most_passes) if entropy is None else (h <= entropy):
                high = j
                break
            low = j + 1
    return low


def plan(rows: DataFrame, most_passes: float | None = MOST_PASSES, entropy: float | None = None,
         budget: int | None = None) -> DataFrame:
    """source, tokens, weight, passes, budget of every source. rows: source, n_tokens.

    ``budget`` is in tokens; without it, it is the least with which every source is passed over once.
    Sources without a token get weight 0 and one pass, as their rows cost nothing.
    """
    totals = written(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    all_tokens = totals.agg(F.sum("tokens")).first()[0] or 0
    filled = totals.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(all_tokens or 1)))
    t = exponent(filled, most_passes, entropy, budget) / LATTICE if all_tokens else 1.0
    z = filled.agg(F.sum(F.pow("share", F.lit(t))).alias("z"), F.min(F.pow("share", F.lit(t - 1))).alias("least")).first()
    weight = F.pow("share", F.lit(t)) / F.lit(z["z"] or 1.0)
    odds = F.pow("share", F.lit(t - 1))
    passes = odds / F.lit(z["least"] or 1.0) if budget is None else odds / F.lit(z["z"] or 1.0) * F.lit(budget / (all_tokens or 1))
    share = F.col("tokens") / F.lit(float(all_tokens or 1))
    return totals.withColumn("share", share).select(
        "source", "tokens", F.when(F.col("tokens") > 0, weight).otherwise(F.lit(0.0)).alias("weight"),
        F.when(F.col("tokens") > 0, F.round(passes, 9)).otherwise(F.lit(1.0)).alias("passes"),
    ).withColumn("budget", F.round(F.col("passes") * F.col("tokens")).cast("long"))


def _hash(*columns) -> F.Column:
    """A number below 2**32 that depends on the columns."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def with_tokens(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_tokens", F.regexp_count(text_of("text"), F.lit(WORD)).cast("long"))


def _passed(rows: DataFrame, mix: DataFrame) -> DataFrame:
    """A row for each pass that its source begins, with its place in the pass."""
    asked = mix.select(F.col("source").alias("_source"), "tokens", "passes", F.col("budget").alias("_budget"))
    return (
        rows.join(asked, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("passes") - 1, F.lit(0)).cast("int"))))
        .withColumn("left", F.col("_budget") - F.col("pass") * F.col("tokens"))
        .withColumn("place", _hash("doc_id", "pass"))
        .withColumn("bucket", F.floor(F.col("place") / (2**32 // BUCKETS)))
    )


def occurrences(rows: DataFrame, mix: DataFrame) -> DataFrame:
    """``rows`` with pass, place and block (0 to BLOCKS - 1), as often as the mix asks for. rows: doc_id, source, n_tokens and
    whatever else. A row is in the last pass if the tokens up to and with it fit the budget; repeated rows count one by one."""
    passed = _passed(rows, mix)
    sums = passed.groupBy("source", "pass", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    running = F.sum("in_bucket").over(W.partitionBy("source", "pass").orderBy("bucket"))
    sums = sums.withColumn("before", running - F.col("in_bucket")).withColumnsRenamed({"source": "_s", "pass": "_p", "bucket": "_b"})
    at = passed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("pass") == F.col("_p")) & (F.col("bucket") == F.col("_b")))
    whole = at.where("before + in_bucket <= left")
    edge = at.where("before < left AND before + in_bucket > left")  # one bucket of a pass at most
    upto = F.sum("n_tokens").over(W.partitionBy("source", "pass").orderBy("place", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    edge = edge.withColumn("_upto", upto).where("before + _upto <= left").drop("_upto")
    block = F.least(F.lit(BLOCKS - 1), F.floor(BLOCKS * (F.col("pass") * F.col("tokens") + F.col("before")) / F.greatest("_budget", F.lit(1))))
    return whole.unionByName(edge).withColumn("block", block.cast("int")).drop(
        "_s", "_p", "_b", "tokens", "passes", "_budget", "left", "bucket", "before", "in_bucket")


def mix(docs: DataFrame, most_passes: float | None = MOST_PASSES, entropy: float | None = None,
        budget: int | None = None) -> DataFrame:
    """doc_id, source, n_tokens, pass, block, place for each time a row of ``docs`` is in the mix.

    Tokens are words between ASCII white space. A null source is a source of its own, null and empty
    texts have no tokens and are in every whole pass. No rows: no rows.
    """
    rows = written(with_tokens(docs.select("doc_id", "source", "text")).drop("text"), "tokens")
    return occurrences(rows, written(plan(rows, most_passes, entropy, budget), "mix")).select(
        "doc_id", "source", "n_tokens", "pass", "block", "place")


def mixed_documents(docs: DataFrame, most_passes: float | None = MOST_PASSES, entropy: float | None = None,
                    budget: int | None = None) -> DataFrame:
    """``docs`` itself, each row as often as the mix has it. Texts are not shuffled: for whole passes the plan decides, for
    the last pass a table of the rows that it takes."""
    rows = written(with_tokens(docs.select("doc_id", "source", "text")).drop("text"), "tokens")
    mix = written(plan(rows, most_passes, entropy, budget), "mix")
    last = occurrences(rows, mix).groupBy("doc_id", "source").agg(F.max("pass").alias("_last"))
    whole = F.floor("passes").cast("int")
    of, id_, of_id, full, time, n = free_names(docs, "_s", "_id", "_src", "_whole", "_time", "_n")
    part = written(
        last.join(mix.select(F.col("source").alias("_s"), "passes"), F.col("source").eqNullSafe(F.col("_s")))
        .where(F.col("_last") >= whole).select(F.col("doc_id").alias(id_), F.col("source").alias(of_id), F.lit(1).alias(n)), "part")
    asked = mix.select(F.col("source").alias(of), whole.alias(full))
    taken = docs.join(asked, F.col("source").eqNullSafe(F.col(of))).join(
        part, F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(of_id)), "left")
    times = F.col(full) + F.coalesce(F.col(n), F.lit(0))  # a null source is a source too
    return taken.withColumn(time, F.explode(F.when(times > 0, F.sequence(F.lit(1), times)))).select(*docs.columns)


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
e AS (SELECT ceil((1 - ln({MOST_PASSES}) / ln(max(tokens) / min(tokens))) * {LATTICE}) / {LATTICE} - 1 AS p, max(tokens) AS top FROM s WHERE tokens > 0),
m AS (SELECT source, tokens, CASE WHEN tokens = 0 THEN 1.0::DOUBLE ELSE round(pow(tokens / top, CASE WHEN p < -1 OR p IS NULL THEN -1 ELSE p END), 9) END AS passes FROM s, e),
b AS (SELECT *, round(passes * tokens)::BIGINT AS budget FROM m),
o AS (SELECT d.*, tokens, budget, pass, ('0x' || substr(md5(doc_id || ':' || pass), 1, 8))::BIGINT AS place
      FROM d JOIN b USING (source), LATERAL (SELECT unnest(range(greatest(ceil(passes)::BIGINT, 1))) AS pass)),
k AS (SELECT *, place // {2**32 // BUCKETS} AS bucket FROM o),
c AS (SELECT source, pass, bucket, sum(sum(n_tokens)) OVER (PARTITION BY source, pass ORDER BY bucket) - sum(n_tokens) AS before
      FROM k GROUP BY source, pass, bucket),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, source, n_tokens, pass::INTEGER AS pass, place,
       least({BLOCKS - 1}, floor({BLOCKS} * (pass * tokens + before) / greatest(budget, 1)))::INTEGER AS block
FROM r JOIN c USING (source, pass, bucket) WHERE upto <= budget - pass * tokens
"""
