"""Benchmark decontamination by winnowing.

Of every WIDTH - GRAM + 1 consecutive GRAM-word hashes the smallest is kept, in documents and in
benchmark items alike. A span of WIDTH words has exactly that many, so any shared span of WIDTH words
or more shares a kept hash. Documents' hashes are joined with the items'; hits are extended to the
windows around them, which are compared as text. Items shorter than WIDTH are one window, looked
for by the hash of all their words. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm.common import ascii_lower, free_names, table, text_of, written

#: Runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F]. Said by what belongs to them: Java's matcher takes 6 to 10 times as long for the
#: class that is negated, and finding words is most of the work here.
WORD = r"[a-z0-9\x80-\x{10FFFF}]+"
#: The same words before A-Z are in lower case.
RAW_WORD = r"[a-zA-Z0-9\x80-\x{10FFFF}]+"
WIDTH = 10
GRAM = 5
SPAN = WIDTH - GRAM + 1  # hashes of which one is kept


def _with_words(df: DataFrame) -> DataFrame:
    return df.withColumn("words", F.regexp_extract_all(ascii_lower(text_of("text")), F.lit(WORD), F.lit(0)))


def word_count(text: Column) -> Column:
    """Number of words. Case doesn't matter to it, so texts aren't lowered, which costs more than the count."""
    return F.regexp_count(text, F.lit(RAW_WORD)).cast("long")


def _grams(words: str, n: int, seed: int) -> Column:
    """Hashes of all runs of n of the hashed words."""
    at = F.col(words)
    every = F.transform(at, lambda x, i: F.xxhash64(F.lit(seed), x, *[F.get(at, i + j) for j in range(1, n)]))
    return F.slice(every, 1, F.greatest(F.size(at) - (n - 1), F.lit(0)))


def _prints(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds ``prints``: (h, pos, n) of kept hashes, n = 0, and of all runs of n words for each n in ``short``."""
    df = df.withColumn("_hashed", F.transform("words", lambda x: F.xxhash64(x)))
    df = df.withColumn("_g", _grams("_hashed", GRAM, 0))
    g = F.col("_g")
    least = F.transform(g, lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, SPAN)]))
    df = df.withColumn("_least", F.slice(least, 1, F.greatest(F.size(g) - (SPAN - 1), F.lit(0))))
    m = F.col("_least")

    def place(n: int):
        return lambda x, i: F.struct(x.alias("h"), i.alias("pos"), F.lit(n).alias("n"))

    # A hash is the least of a span around it if and only if it is the greatest of those spans' least.
    kept = F.filter(F.transform(g, place(0)), lambda s: s.h == F.greatest(*[F.get(m, s.pos - j) for j in range(SPAN)]))
    parts = [kept] + [F.transform(_grams("_hashed", n, n), place(n)) for n in short]
    return df.withColumn("prints", F.concat(*parts) if short else kept)


# Arrays are taken apart by explode_outer: for explode, Spark adds a filter on the array's size, which evaluates
# the nested lambdas inside one another.


def _windows(starts: Column, words: Column) -> Column:
    return F.transform(starts, lambda s: F.struct(
        s.a.alias("a"), s.n.alias("n"), F.array_join(F.slice(words, s.a + 1, s.n), " ").alias("window")))


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """key, second, n_hit, n_items, items_sha256 of each text that holds a window of an item."""
    n_words = F.size("words")
    known = written(
        _with_words(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"))
        .where(n_words > 0).select("item_id", "words"), "items")
    short = sorted(r["n"] for r in known.select(n_words.alias("n")).where(F.col("n") < WIDTH).distinct().collect())

    longs, shorts = known.where(n_words >= WIDTH), known.where(n_words < WIDTH)
    looked = _prints(longs, []).select(F.explode_outer("prints.h").alias("h"), F.lit(0).alias("n"))
    if short:
        looked = looked.unionByName(
            _prints(shorts, short).select(n_words.alias("w"), F.explode_outer("prints").alias("p")).where("p.n = w").selectExpr("p.h AS h", "p.n AS n"))
    looked = written(looked.distinct(), "prints")
    starts = F.when(n_words >= WIDTH, F.transform(
        F.sequence(F.lit(0), n_words - WIDTH), lambda a: F.struct(a.alias("a"), F.lit(WIDTH).alias("n")))
    ).otherwise(F.array(F.struct(F.lit(0).alias("a"), n_words.alias("n"))))
    windows = written(
        known.select("item_id", F.explode_outer(_windows(starts, F.col("words"))).alias("w"))
        .groupBy(F.col("w.window").alias("window")).agg(F.collect_set("item_id").alias("ids")), "windows")

    texts = docs.select("text", F.xxhash64(text_of("text")).alias("key"))
    # With a table of prints small enough Spark broadcasts it; otherwise prints are shuffled.
    seen = _prints(_with_words(texts), short).select("key", F.explode_outer("prints").alias("p")).select("key", "p.h", "p.pos", "p.n")
    near = written(
        seen.join(looked, ["h", "n"], "left_semi").groupBy("key").agg(F.collect_set(F.struct("pos", "n")).alias("at")), "near")

    found = _with_words(texts.join(near, "key").dropDuplicates(["key", "text"]).select("key", "text", "at"))
    around = F.array_distinct(F.flatten(F.transform("at", lambda p: F.when(p.n > 0, F.array(F.struct(p.pos.alias("a"), p.n.alias("n"))))
        .when(n_words >= WIDTH, F.transform(
            F.sequence(F.greatest(p.pos - (SPAN - 1), F.lit(0)), F.greatest(F.least(p.pos, n_words - WIDTH), F.lit(0), p.pos - (SPAN - 1))),
            lambda a: F.struct(a.alias("a"), F.lit(WIDTH).alias("n"))))
        .otherwise(F.expr("CAST(array() AS array<struct<a:int,n:int>>)")))))
    asked = found.withColumn("starts", around).select(
        "key", F.xxhash64(text_of("text"), F.lit(1)).alias("second"), F.explode_outer(_windows(F.col("starts"), F.col("words"))).alias("w"))
    hit = asked.select("key", "second", "w.a", "w.n", "w.window").join(windows, "window")
    union = F.aggregate(
        F.array_sort("spans"), F.expr("named_struct('end', 0, 'n', 0L)"),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s.a + s.n).alias("end"),
            (acc["n"] + F.greatest(s.a + s.n - F.greatest(acc["end"], s.a), F.lit(0))).cast("long").alias("n")),
        lambda acc: acc["n"])
    per_text = hit.groupBy("key", "second").agg(
        F.collect_set(F.struct("a", "n")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"))
    return written(per_text.select(
        "key", "second", union.alias("n_hit"), F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")), "hits")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``. items: item_id, text.

    Words are runs of letters and digits, A-Z in lower case, with every character beyond ASCII a
    letter. Hit is each word inside any occurrence of a window of 10 consecutive words of an item;
    an item of fewer, but not none, is one window. Null and empty texts have no words; an item without an id counts
    under the empty id. Equal texts are looked at once and get equal results; other columns are not looked at.
    """
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of("text")).alias("key"), F.xxhash64(text_of("text"), F.lit(1)).alias("second"),
        word_count(text_of("text")).alias("n_words"))
    none = F.lit(0).cast("long")
    return counted.join(_hits(docs, items), ["key", "second"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of an item. Null and empty texts stay, as do repeated rows."""
    key, second = free_names(docs, "_key", "_second")
    hits = _hits(docs, items).select(F.col("key").alias(key), F.col("second").alias(second))
    same = (F.xxhash64(text_of("text")) == F.col(key)) & (F.xxhash64(text_of("text"), F.lit(1)) == F.col(second))
    return docs.join(hits, same, "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH i AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, len(w) < {WIDTH} AS short, least(len(w), {WIDTH}) AS n, array_to_string(w[a:a + least(len(w), {WIDTH}) - 1], ' ') AS win
       FROM i, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WIDTH} + 1, 1) + 1)) AS a) WHERE len(w) > 0),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, a, n, array_to_string(w[a:a + n - 1], ' ') AS win
       FROM d, ns, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS a) WHERE len(w) >= n),
h AS (SELECT doc_id, a, n, item_id FROM dw JOIN iw USING (n, win)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(a, a + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
