"""Merkle manifest of a data set by lag and lead windows.

A row is a leaf. Every FAN_IN consecutive nodes of a source become their parent until one, the subroot, is left; subroots
become the root in the same way.

* Leaves get their place in the source by range counts, not by a window over a source, and lie in blocks of
  FAN_IN**LEVELS consecutive places. A block holds whole subtrees, so no run crosses its border, and a
  hot source is as many groups as it has blocks.
* A node of level l stands on the row of its first leaf. Its siblings stand FAN_IN**l and twice as many rows away: lag
  and lead by these fixed offsets, masked by the node's slot in its run; beyond the run's length there is no row. First
  children hash their parents. All levels of a block share one shuffle and one sort.
* What a leaf needs of the nodes above it is the nearest row before it that holds one: a running last value.
* The top nodes of blocks are the leaves of the next storey, a FAN_IN**LEVELS-th of the rows; storeys end when every source
  has one node. Proofs of upper storeys go down by joins on (source, block).

A proof is a list of (left, right), the concatenated digests before and after the node, from the leaf up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm.common import table, written
from quarterfold.operators.numbering import with_position, with_position_in

FAN_IN, LEVELS = 3, 7
BLOCK = FAN_IN**LEVELS  # rows that a window sees
TAMPERED = 2  # rows whose id's checksum this divides are tampered with
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """``-`` for null, else UTF-8 bytes, colon, value."""
    s = value.cast("string")
    return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(_field, values)), 256)


def storey(nodes: DataFrame) -> DataFrame:
    """Adds ``top`` and ``proof`` to nodes (g, i, n, d): place i of the n nodes of tree g, digest d.

    ``top`` on the first row of a block is the block's node LEVELS up, or the root if n <= BLOCK; ``proof`` leads from every
    row to its block's top.
    """
    block = W.partitionBy("g", F.floor(F.col("i") / BLOCK)).orderBy("i")
    so_far = block.rowsBetween(W.unboundedPreceding, 0)
    rows, none = nodes.withColumn("d0", F.col("d")), F.lit("")
    for level in range(LEVELS):
        step, d = FAN_IN**level, F.col(f"d{level}")
        slot = F.floor(F.col("i") / step) % FAN_IN
        here = (F.col("i") % step == 0) & (F.col("n") > step)  # a node of this level that has a parent
        left = F.when(slot == 0, none).when(slot == 1, F.lag(d, step).over(block)).otherwise(
            F.concat(F.lag(d, 2 * step).over(block), F.lag(d, step).over(block)))
        next_, after = (F.coalesce(F.lead(d, k * step).over(block), none) for k in (1, 2))
        right = F.when(slot == 0, F.concat(next_, after)).when(slot == 1, next_).otherwise(none)
        rows = rows.withColumn(f"s{level}", F.when(here, F.struct(left.alias("left"), right.alias("right"))))
        parent = F.sha2(F.concat(d, F.col(f"s{level}.right")), 256)
        # a tree with one node left keeps it as the top
        rows = rows.withColumn(f"d{level + 1}", F.when(F.col("i") % (step * FAN_IN) == 0, F.when(F.col("n") > step, parent).otherwise(d)))
    proof = F.array_compact(F.array(*[F.last(f"s{k}", ignorenulls=True).over(so_far) for k in range(LEVELS)]))
    return rows.select(*nodes.columns, F.col(f"d{LEVELS}").alias("top"), proof.alias("proof"))


def storeys(leaves: DataFrame) -> list[DataFrame]:
    """Storeys from the leaves (g, i, n, d and others) to the one in which every tree has its root. g must not be null."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    found = [written(storey(leaves), "storey")]
    while most > BLOCK:
        tops = found[-1].where(F.col("i") % BLOCK == 0).select(
            "g", F.floor(F.col("i") / BLOCK).alias("i"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("d"))
        found.append(written(storey(tops), "storey"))
        most = -(-most // BLOCK)
    return found


def subroots_of(found: list[DataFrame]) -> DataFrame:
    return found[-1].where("i = 0").select("g", F.col("top").alias("subroot"))


def _beyond(nodes: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """Proofs of nodes led on by those of ``above``, whose other columns come along."""
    up = above.withColumnRenamed("proof", "_up")
    return nodes.join(up, keys).withColumn("proof", F.concat("proof", "_up")).drop("_up", "top")


def whole_proofs(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with proofs through all storeys and on by those of ``above`` (g, proof and others).

    ``above`` meets the last storey, where a tree has BLOCK rows at most, so a hot source is no hot key.
    """
    nodes = _beyond(found[-1], above, ["g"])
    others = [c for c in above.columns if c not in ("g", "proof")]
    for below in found[-2::-1]:
        up = nodes.select("g", F.col("i").alias("_block"), "proof", *others)
        nodes = _beyond(below.withColumn("_block", F.floor(F.col("i") / BLOCK)), up, ["g", "_block"]).drop("_block")
    return nodes


def proof_text(proof: Column) -> Column:
    """All siblings, from the leaf up, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s.left, s.right)), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s.left, d, s.right), 256))


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, proof_sha256, folded_root, verified for every row of ``docs``.

    docs: doc_id, source, lang, n_chars, text; other columns are not looked at. ``changed`` is the text to verify in place of
    the one in the manifest, by default the same. Leaves ascend by doc_id, null first; rows with one id by digest, so
    repeated rows have equal subroots in any order. A null source is a source of its own, before all others. A row
    that is alone has its leaf as subroot and root, and a proof of nothing. No rows: no rows.
    """
    values = {c: F.col(c) for c in FIELDS}
    fields = [values[c] for c in FIELDS]
    now = fields if changed is None else [*fields[:-1], changed]
    # null before all others; strings order by their UTF-8 bytes
    tree = F.coalesce(F.concat(F.lit("1"), values["source"].cast("string")), F.lit("0"))
    rows = docs.select(
        values["doc_id"].cast("long").alias("doc_id"), tree.alias("g"), leaf_of(fields).alias("d"),
        (leaf_of(fields) if changed is None else leaf_of(now)).alias("now"), F.monotonically_increasing_id().alias("tag"))
    found = storeys(with_position_in(rows, "g", ["doc_id", "d", "tag"], "i", "n").drop("tag"))

    sources = written(subroots_of(found).withColumnRenamed("g", "source"), "subroots")
    ranked = with_position(sources, ["source"], "i").select(
        F.lit(0).alias("g"), "i", F.lit(sources.count()).cast("long").alias("n"), F.col("subroot").alias("d"), "source")
    over = storeys(ranked)
    one = subroots_of(over).first()
    root = F.lit(one["subroot"] if one else None).cast("string")
    end = over[-1].where("i = 0").select("g", F.array().cast(over[-1].schema["proof"].dataType).alias("proof"))
    tops = whole_proofs(over, end).select(F.col("source").alias("g"), F.col("d").alias("subroot"), "proof")
    return whole_proofs(found, tops).select(
        "doc_id", F.col("d").alias("leaf"), "subroot", root.alias("root"), "proof",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded(F.col("now"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(text: Column, doc_id: Column) -> Column:
    """The text without its line breaks where TAMPERED divides the id's checksum; rows without an id stay as they are."""
    hit = F.crc32(doc_id.cast("string")) % TAMPERED == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = manifest(docs, tampered(F.col("text"), F.col("doc_id")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_field(column: str) -> str:
    s = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({s}) || ':' || {s} END"


_HEAD = " || ".join(map(_sql_field, FIELDS[:-1]))
# CRC-32 a byte at a time: the start value, then the digits of the id; 3988292384 is the polynomial.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda s: CAST(ascii(s) AS BIGINT))), lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1],
  lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""
SQL = f"""
WITH RECURSIVE t AS (
  SELECT *, CASE WHEN {_CRC} % {TAMPERED} = 0 THEN replace(text, chr(10), '') ELSE text END AS now FROM documents
), leaves AS (
  SELECT doc_id, source, sha256({_HEAD} || {_sql_field("text")}) AS leaf, sha256({_HEAD} || {_sql_field("now")}) AS now,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM t
), nodes AS (
  SELECT source, 0 AS l, i, leaf AS d, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, l + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM nodes WHERE n > 1
  GROUP BY source, l, i // 3, n
), subroots AS (
  SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS l, place AS i, subroot AS d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT l + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY l, i // 3, n
), kin AS (
  SELECT source, l, i, n, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY source, l, i // 3 ORDER BY i)
), top_kin AS (
  SELECT l, i, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY l, i // 3 ORDER BY i)
), paths AS (
  SELECT doc_id, source, leaf, 0 AS l, i, now AS d, '' AS proof FROM leaves
  UNION ALL
  SELECT p.doc_id, p.source, p.leaf, p.l + 1, p.i // 3, sha256(k.before || p.d || k.after), p.proof || k.before || k.after
  FROM paths p JOIN kin k ON p.source IS NOT DISTINCT FROM k.source AND p.l = k.l AND p.i = k.i
), to_subroot AS (
  SELECT p.* FROM paths p JOIN nodes m ON p.source IS NOT DISTINCT FROM m.source AND p.l = m.l AND p.i = m.i AND m.n = 1
), on_top AS (
  SELECT p.doc_id, p.leaf, s.subroot, 0 AS l, s.place AS i, p.d, p.proof
  FROM to_subroot p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT p.doc_id, p.leaf, p.subroot, p.l + 1, p.i // 3, sha256(k.before || p.d || k.after), p.proof || k.before || k.after
  FROM on_top p JOIN top_kin k ON p.l = k.l AND p.i = k.i
)
SELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, p.d AS folded_root, p.d = t.d AS verified
FROM on_top p JOIN tops t ON t.n = 1 AND p.l = t.l
"""
