"""N-gram Jaccard join by token-combination prefixes.

Tokens are 64-bit hashes of shingles, in order of the hash. Texts with one set are one class, which is
searched once. With similarity t, a set of size s may miss s - ceil(t s) tokens of a partner's.

1. Extended prefixes. The first ``reach`` tokens of two linked sets share ``common`` or more. These tokens are
   counted; within them, rarest first, the first reach - common + 1 of either set must again share one. A class
   with that many tokens of its own has no partner, which settles most of them.
2. Single tokens for rare ones. Where the shared token is in at most RARE classes, its list gives the pairs.
3. Combinations for frequent ones. Classes whose prefix runs into frequent tokens index combinations of their
   tokens instead: the hash space is cut into one part more than two linked sets can differ in, so at least one part
   holds the same tokens in both, and all tokens of a part are one key. Lists of up to RARE classes give their
   pairs; in longer ones everyone is compared with one member first, and later only across components.
4. Verification. A pair is first held against the bound that 1024-bit parity sketches give, then against
   the whole sets. Pairs that a component already connects are left out; that loses no class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm import wordhash
from quarterfold.llm.common import ascii_lower, free_names, table, text_of, written
from quarterfold.llm.components import components

RARE = 8
HELD = 6_000_000  # tokens that a task holds to find frequent ones by itself; beyond it begins anew
OUT = 1 << 16
SKETCH = 1024  # bits
HALVED = 16  # cells whose halves are indexed for sets with empty cells


@dataclass(frozen=True)
class Rule:
    """Shingles of n words; linked if 100 * intersection >= percent * union."""

    n: int
    percent: int

    def needed(self, s):
        """Tokens that a set of size s shares with a linked one at least."""
        return -((-self.percent * s) // 100)

    def reach(self, s: int) -> int:
        spare = s - self.needed(s)
        return min(s, spare + spare // 2 + 4)

    def level(self, s: int) -> int:
        """Linked sets are of one level or of two that follow."""
        i, top = 0, 1.0
        while top * 100 / self.percent <= s:
            top, i = top * 100 / self.percent, i + 1
        return i

    def parts(self, level: int) -> int:
        largest = int((100 / self.percent) ** (level + 1)) + 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent) + 2


def sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of fewer than n words the whole sequence is one."""
    w = wordhash.words(texts)
    h = w.hashes()
    runs = wordhash.runs(h, n)
    found = []
    for first, count in zip(w.first, w.counts, strict=True):
        if count >= n:
            found.append(np.unique(runs[first : first + count - n + 1]))
        elif count:
            found.append(wordhash.mixed(wordhash.runs(h[first : first + count], int(count)) + np.uint64(count)))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    return found


def class_of(tokens: np.ndarray) -> tuple[int, int]:
    c = np.frombuffer(hashlib.sha256(tokens.tobytes()).digest()[:16], dtype=np.int64)
    return int(c[0]), int(c[1])


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for begin, rows in wordhash.pieces(batch, "text"):
            part = batch.slice(begin, rows)
            yield part, sets(part.column("text"), n)


def _described(rule: Rule):
    def run(batches):
        for part, found in _rows(batches, rule.n):
            c = np.array([class_of(s) for s in found], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), pa.array(c[:, 0]), pa.array(c[:, 1])],
                names=["doc_id", "size", "c", "c2"])
    return run


def _sent(tokens: list[np.ndarray], classes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(token, c, n): n is 1 where other tasks must be asked; a token that this task alone finds frequent is known to be so
    and marked with n = 0, but for one row that tells the other tasks."""
    t, c = np.concatenate(tokens), np.concatenate(classes)
    order = np.argsort(t, kind="stable")
    t, c = t[order], c[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = t[1:] != t[:-1]
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(t)))
    frequent = np.repeat(counts > RARE, counts)
    n = np.where(frequent & ~new, 0, np.where(frequent, RARE + 1, 1)).astype(np.int32)
    for i in range(0, len(t), OUT):
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[i : i + OUT]) for x in (t.view(np.int64), c, n)], names=["token", "c", "n"])


def _regions(rule: Rule):
    def run(batches):
        tokens, classes, held, seen = [], [], 0, set()
        for _, found in _rows(batches, rule.n):
            for s in found:
                if not len(s) or (c := class_of(s)) in seen:  # copies within the task count once
                    continue
                seen.add(c)
                first = s[: rule.reach(len(s))]
                tokens.append(first)
                classes.append(np.full(len(first), c[0]))
                held += len(first)
            if held > HELD:
                yield from _sent(tokens, classes)
                tokens, classes, held, seen = [], [], 0, set()
        if tokens:
            yield from _sent(tokens, classes)
    return run


def _keys(tokens: np.ndarray, at: np.ndarray, cells: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell the key of all its tokens, and whether it has any. at: the cell of each token."""
    sums = np.zeros(cells, dtype=np.uint64)
    np.add.at(sums, at, wordhash.mixed(tokens + np.uint64(1)))
    keys = wordhash.mixed(sums + wordhash.mixed(np.arange(cells, dtype=np.uint64) * np.uint64(977) + np.uint64(seed)))
    return keys, np.bincount(at, minlength=cells) > 0


def combinations(rule: Rule, s: np.ndarray) -> np.ndarray:
    """Keys of which two linked sets share one or more.

    Of ``parts`` cells two linked sets differ in all but one at most. A cell that is empty in both is a key of no use, as
    very many sets share it. If all they agree in is empty, every other cell differs in a token, most of them in just one,
    so that one half of such a cell agrees. Sets with an empty cell therefore index the halves of the first HALVED cells;
    only if so many halves are empty that all those agreeing might be, which few tokens bring about, the empty cells too.
    """
    found = []
    for level in (rule.level(len(s)), rule.level(len(s)) + 1):
        p = rule.parts(level)
        at = ((s >> np.uint64(32)) % np.uint64(p)).astype(np.int64)
        keys, filled = _keys(s, at, p, level)
        found.append(keys[filled])
        if filled.all():
            continue
        m = min(p, HALVED)
        some = at < m
        halves, half_filled = _keys(s[some], at[some] * 2 + (s[some] & np.uint64(1)).astype(np.int64), 2 * m, level + 500)
        found.append(halves[half_filled])
        # Cells before m that differ have m + 1 - (empty cells after m) agreeing halves at least, beyond one for each cell
        # that is empty in both; 2 * m - filled halves are empty.
        if m + 1 - int((~filled[m:]).sum()) <= 2 * m - int(half_filled.sum()):
            found.append(keys[~filled])
    return np.concatenate(found)


def _measured(rule: Rule):
    """Whole sets and their sketches; combinations for classes that need them."""
    def run(batches):
        for part, found in _rows(batches, rule.n):
            rows = {k: [] for k in ("id", "c", "size", "sketch", "tokens", "keys")}
            for i, s in enumerate(found):
                if (c := class_of(s)) != (part.column("c")[i].as_py(), part.column("c2")[i].as_py()):
                    continue
                bits = np.bincount((s % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
                keys = combinations(rule, s) if part.column("frequent")[i].as_py() else np.zeros(0, np.uint64)
                rows["id"].append(part.column("doc_id")[i].as_py())
                rows["c"].append(c[0])
                rows["size"].append(len(s))
                rows["sketch"].append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                rows["tokens"].append(s.view(np.int64))
                rows["keys"].append(keys.view(np.int64))
            long = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["id"], pa.int64()), pa.array(rows["c"], pa.int64()), pa.array(rows["size"], pa.int64()),
                 *(pa.array(rows[k], long) for k in ("sketch", "tokens", "keys"))], names=list(rows))
    return run


def _near(rule: Rule, x: str, y: str) -> Column:
    """Whether sizes and sketches allow a link. Sketches differ in no more bits than the sets in tokens."""
    sizes = F.col(f"{x}.size") + F.col(f"{y}.size")
    least = F.ceil(sizes * rule.percent / (100 + rule.percent) - F.lit(1e-9))
    differ = F.aggregate(F.zip_with(f"{x}.sketch", f"{y}.sketch", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, d: s + d)
    return (F.least(f"{x}.size", f"{y}.size") * 100 >= F.greatest(f"{x}.size", f"{y}.size") * rule.percent) & (
        differ <= sizes - 2 * least)


def _pairs_of(lists: DataFrame) -> DataFrame:
    """All pairs of short lists (key, ids)."""
    first = lists.select("ids", F.posexplode(F.array_sort("ids")).alias("i", "a"))
    return first.select("a", F.explode(F.slice(F.array_sort("ids"), F.col("i") + 2, F.lit(RARE))).alias("b"))


def links(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(doc_id, size, c, c2) of every row, and (id, label): component of each class representative that has a link."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(text_of("text")).alias("text"))
    described = written(rows.mapInArrow(_described(rule), "doc_id long, size long, c long, c2 long"), "sets")
    classes = written(
        described.where("size > 0 AND doc_id IS NOT NULL").groupBy("c", "c2").agg(F.min("doc_id").alias("id"), F.first("size").alias("size")),
        "classes")

    region = written(rows.where("doc_id IS NOT NULL").mapInArrow(_regions(rule), "token long, c long, n int"), "region")
    asked = region.where("n > 0").repartition("token").groupBy("token", "c").agg(F.max("n").alias("n"))
    total = F.sum("n").over(W.partitionBy("token"))
    counted = asked.withColumn("total", total).where("total > 1").select("token", "c", (F.col("total") > RARE).alias("often"))
    known = region.where("n = 0").select("token", "c", F.lit(True).alias("often"))
    shared = counted.unionByName(known).groupBy("c").agg(F.array_sort(F.collect_set(F.struct("often", "token"))).alias("shared"))
    # reach and prefix depend on the size alone, of which there are few
    sizes = classes.select("size").distinct()
    need = lambda s: f"(({rule.percent} * ({s}) + 99) div 100)"
    reach = lambda s: f"least({s}, (({s}) - {need(s)}) + (({s}) - {need(s)}) div 2 + 4)"
    sizes = sizes.selectExpr("size", f"{need('size')} AS least").selectExpr(
        "size", f"{reach('size')} AS reach", f"{reach('least')} - (least - {need('least')}) AS common")
    live = (
        shared.join(classes, "c").join(sizes, "size")
        .withColumn("left", F.col("reach") - F.col("common") + 1 - (F.col("reach") - F.size("shared"))).where("left > 0")
        .withColumn("prefix", F.slice("shared", 1, F.col("left").cast("int")))
        .select("id", "c", "c2", F.transform(F.filter("prefix", lambda p: ~p.often), lambda p: p.token).alias("rare"),
                F.exists("prefix", lambda p: p.often).alias("frequent"))
    )
    live = written(live, "live")
    wanted = live.select(F.col("id").alias("doc_id"), "c", "c2", "frequent")
    measured = written(
        rows.join(wanted, "doc_id").mapInArrow(
            _measured(rule), "id long, c long, size long, sketch array<long>, tokens array<long>, keys array<long>")
        .dropDuplicates(["id"]), "measured")

    rare = live.select(F.explode("rare").alias("key"), "id").groupBy("key").agg(F.collect_set("id").alias("ids")).where(F.size("ids") > 1)
    keyed = written(measured.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "id"), "keys")
    lists = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    short = keyed.join(lists.where(F.col("n") <= RARE), "key").groupBy("key").agg(F.collect_set("id").alias("ids")).where(F.size("ids") > 1)
    long = written(keyed.join(lists.where(F.col("n") > RARE), "key").select("key", "id", "first"), "lists")
    star = long.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    pairs = _pairs_of(rare.select("ids")).unionByName(_pairs_of(short.select("ids"))).unionByName(star)
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("times"))

    light = measured.select("id", "size", "sketch")

    def fits(p: DataFrame) -> DataFrame:
        p = p.join(light.select(F.col("id").alias("a"), F.struct("size", "sketch").alias("x")), "a")
        p = p.join(light.select(F.col("id").alias("b"), F.struct("size", "sketch").alias("y")), "b")
        return p.where(_near(rule, "x", "y")).drop("x", "y")

    def verified(p: DataFrame) -> DataFrame:
        p = p.select("a", "b").join(measured.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
        p = p.join(measured.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
        # in the JVM: a row at a time, however long the sets are
        both = F.size(F.array_intersect("x", "y"))
        linked = both * 100 >= (F.size("x") + F.size("y") - both) * rule.percent
        return written(p.where(linked).select("a", "b"), "linked")

    def apart(p: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs that no component connects."""
        for side in ("a", "b"):
            p = p.join(found.select(F.col("node").alias(side), F.col("label").alias(f"l{side}")), side, "left")
        return p.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")

    pairs = written(fits(pairs), "pairs")
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a"))
    edges = verified(best)
    found = components(edges)
    rest = apart(pairs.join(best, ["a", "b"], "left_anti"), found)
    edges = edges.unionByName(verified(rest))
    found = written(components(edges), "found")

    # long lists: whoever is in another component than the first is held against all other components of the list
    at = long.join(found.select(F.col("node").alias("id"), "label"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    mixed = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    at = written(at.join(mixed, "key").join(light, "id"), "mixed")
    more = at.alias("x").join(at.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & _near(rule, "x", "y"))
    # a pair meets in many lists: written, so that it is one row before it is looked for among the pairs
    more = written(more.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "more")
    edges = edges.unionByName(verified(more.join(pairs, ["a", "b"], "left_anti")))
    return described, written(components(edges).withColumnRenamed("node", "id"), "components")


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    The set of a text: its distinct shingles of n words, with A-Z in lower case and words between ASCII white space;
    fewer words are one shingle; without words (or with a null text) the set is empty and linked with nothing. Two rows link when 100 *
    intersection >= percent * union; component_id is the smallest doc_id reachable. Rows without an id link with nothing
    and get no component; rows that share an id count as one document. Other columns are not looked at.
    """
    described, labels = links(docs, Rule(n, percent))
    ids = described.where("size > 0 AND doc_id IS NOT NULL").groupBy("c", "c2").agg(F.min("doc_id").alias("id"))
    ids = ids.join(labels, "id", "left").select("c", "c2", F.coalesce("label", "id").alias("component"))
    return described.join(ids, ["c", "c2"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
        .otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component has a smaller doc_id; of repeated rows all stay."""
    (name,) = free_names(docs, "_gone")
    gone = jaccard_components(docs, n, percent).where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(written(gone, "gone"), F.col("doc_id").cast("long") == F.col(name), "left_anti").select(*docs.columns)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


# All pairs that share a shingle, counted, and what links reach.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, sha256(array_to_string(w[i:i + 2], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0) GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * shared >= 90 * (na.n + nb.n - shared)),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reached r WHERE r.a = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id"""
