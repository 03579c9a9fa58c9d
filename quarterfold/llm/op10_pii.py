"""Personal data by candidates and boosted trees.

Generators propose spans: every match of the four base patterns, whether it passes its check or not, and
two forms no base pattern knows (addresses with "at" and "dot" spelled in brackets, phone numbers without a
plus). Spans that pass the check are redacted in any case. The others are scored by boosted trees over
format and context, trained on all candidates of the base patterns with the check's outcome as label and
without its inputs as features; so they learn in which form and company such a span is nearly always
real. Trees train on counts by feature values, of which there are boundedly many, and are applied as a SQL
expression. The threshold is the lowest at which PRECISION of the labelled candidates are real.
Built-in functions only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm import boost
from quarterfold.llm.common import table, text_of, written

KINDS = ("email", "ip", "card", "phone")
# Possessive repeats and looks behind change no match; they keep long runs linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SPELLED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]++)++"
LOCAL = r"(?<![0-9+().-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
CUES = r"(?i)(?:mail|contact|tel|phone|call|fax|mobil|card|visa|iban|konto|host|server|addr|\bip\b)"
CONTEXT = 24  # characters before a span
PRECISION = 0.98
#: Bins of the features: digits, letters, separators, cue before, character before, character after.
TOPS = (20, 12, 9, 1, 2, 2)
CANDIDATE = "struct<kind:int,start:bigint,end:bigint,real:boolean,trained:boolean,f:array<int>>"


def _side(char: Column) -> Column:
    return F.when(char.rlike(r"^\s*$"), 0).when(char.rlike(r"[A-Za-z0-9]"), 2).otherwise(1)


def _features(match: Column, before: Column, after: Column) -> Column:
    digits = F.length(F.regexp_replace(match, r"[^0-9]", ""))
    letters = F.length(F.regexp_replace(match, r"[^A-Za-z]", ""))
    values = (
        digits, F.floor(letters / 4), F.length(match) - digits - letters, before.rlike(CUES).cast("int"),
        _side(F.right(before, F.lit(1))), _side(F.left(after, F.lit(1))),
    )
    return F.array(*[F.least(v, F.lit(top)).cast("int") for v, top in zip(values, TOPS, strict=True)])


def _candidates(text: str, has: str, pattern: str, kind: int, real, trained: bool) -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns in two steps: matches and the pieces between them, then candidates with their places."""
    name = f"{KINDS[kind]}{'' if trained else '_more'}"
    asked = F.col(text).rlike(has) if len(has) > 1 else F.contains(F.col(text), F.lit(has))
    none = F.array().cast("array<string>")
    first = {
        f"_m_{name}": F.when(asked, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        f"_p_{name}": F.when(asked, F.split(text, pattern, -1)).otherwise(none),
    }
    found, pieces = F.col(f"_m_{name}"), F.col(f"_p_{name}")

    def add(acc: Column, m: Column) -> Column:
        i = F.size(acc["spans"])
        start = acc["at"] + F.length(F.get(pieces, i))
        end = start + F.length(m)
        span = F.struct(
            F.lit(kind).alias("kind"), start.cast("long").alias("start"), end.cast("long").alias("end"), real(m).alias("real"),
            F.lit(trained).alias("trained"),
            _features(m, F.right(F.get(pieces, i), F.lit(CONTEXT)), F.get(pieces, i + 1)).alias("f"))
        return F.struct(end.cast("long").alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{CANDIDATE}>").alias("spans"))
    return first, {f"_c_{name}": F.aggregate(found, zero, add, lambda acc: acc["spans"])}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _real(kind: int):
    if kind == 0:
        return lambda m: F.lit(True)
    if kind == 1:
        return lambda m: m.rlike(OCTETS)
    if kind == 2:
        return lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    return lambda m: F.length(_digits(m)).between(9, 15)


GENERATORS = (
    ("@", EMAIL, 0, _real(0), True), (r"[0-9]\.[0-9]", IP, 1, _real(1), True), (r"[0-9][\x20-]?[0-9]", CARD, 2, _real(2), True),
    (r"\+[0-9]", PHONE, 3, _real(3), True), (r"[(\[{]at[)\]}]", SPELLED, 0, lambda m: F.lit(False), False),
    (r"[0-9]\)?[\x20.-][0-9]", LOCAL, 3, lambda m: F.lit(False), False),
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and its candidates. One pass over the texts."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    steps = [_candidates("text", *g) for g in GENERATORS]
    df = df.withColumns({k: v for first, _ in steps for k, v in first.items()})
    df = df.withColumns({k: v for _, second in steps for k, v in second.items()})
    return df.select("doc_id", F.concat(*[c for _, second in steps for c in second]).alias("spans"))


def train(found: DataFrame) -> tuple[boost.Trees, float]:
    """Trees and the log-odds from which a candidate is taken. At most the product of TOPS + 1 rows come to the driver."""
    counts = (
        found.select(F.explode_outer("spans").alias("s")).where("s.trained").groupBy(F.col("s.f").alias("f"))
        .agg(F.count("*").alias("n"), F.sum(F.col("s.real").cast("long")).alias("good")).orderBy("f").collect()
    )
    if not counts:
        return boost.fit(np.zeros((0, len(TOPS)), np.uint8), np.zeros(0)), float("inf")
    x = np.array([r["f"] for r in counts], np.uint8)
    n, good = (np.array([r[k] for r in counts], float) for k in ("n", "good"))
    trees = boost.fit(np.concatenate([x, x]), np.repeat([1.0, 0.0], len(x)), np.concatenate([good, n - good]), trees=30, depth=3, bins=max(TOPS) + 1)
    margin = np.round(trees.margin(x), 9)
    order = np.argsort(-margin, kind="stable")
    precise = np.cumsum(good[order]) >= PRECISION * np.cumsum(n[order])
    last = np.append(margin[order][1:] != margin[order][:-1], True)  # whole steps only
    fit_for = np.flatnonzero(precise & last)
    return trees, float(margin[order][fit_for[-1]]) if len(fit_for) else float("inf")


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every row of ``docs``.

    Counts and digest are of the base patterns alone; ``spans`` also has what the trees add: candidates that overlap neither
    a base span nor an added one before them. Places count code points, the end is exclusive. A null text counts as empty;
    empty texts and no rows give no spans; repeated rows are rows like others.
    """
    found = written(candidates(docs), "candidates")
    trees, least = train(found)
    base = F.filter("spans", lambda s: s.real)
    plain = F.transform(base, lambda s: F.struct(s.start, s.kind, s.end))
    score = lambda s: F.round(trees.sql([F.get(s.f, i) for i in range(len(TOPS))]), 9)
    taken = F.transform(F.filter("spans", lambda s: ~s.real & (score(s) >= F.lit(least))), lambda s: F.struct(s.start, s.kind, s.end))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    free = lambda a, s: ~F.exists(a, lambda t: (t.start < s.end) & (s.start < t.end))
    split = found.select("doc_id", plain.alias("base"), (taken if np.isfinite(least) else empty).alias("taken"))
    split = split.withColumn("free", F.filter("taken", lambda s: free(F.col("base"), s)))
    split = split.withColumn("added", F.aggregate(
        F.array_sort("free"), empty, lambda a, s: F.when(free(a, s), F.concat(a, F.array(s))).otherwise(a)))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    return split.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
        _text_of(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
