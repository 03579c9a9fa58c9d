"""Exact duplicates by a tree-merge of sorted digest runs.

Every input partition sorts the digests of its texts into a run, with one entry for each
distinct text. Runs then meet in rounds of ``FAN_IN``: before round r, entries lie in
(lane, range) cells, where a range is the first r hex digits of the digest; the round joins
``FAN_IN`` lanes into one and splits the range by one digit more, so there are as many cells
as before, each with as much as before or less. After the last round one lane is left and every
digest lies in one cell. A hot group leaves a partition as one entry, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm.common import ascii_lower, partitions, table, text_of, written

FAN_IN = 16  # one hex digit of the digest a round
ENTRY = "lane long, digest string, n_bytes long, best_id long, best_tag long, n long"
SAME = ("lane", "digest", "n_bytes")


def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry for each text from entries in order: the first is the one to keep. Holds one batch at a time.

    Entries are one text if digest and length agree.
    """
    held = None
    for batch in batches:
        run = pa.Table.from_batches([batch])
        run = pa.concat_tables([held, run.cast(held.schema)]).combine_chunks() if held is not None else run
        if not run.num_rows:
            continue
        new = np.zeros(run.num_rows, dtype=bool)
        new[0] = True
        for name in SAME:
            values = run[name].combine_chunks()
            new[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(run["n"].to_numpy(), starts)
        at = run.schema.get_field_index("n")
        merged = run.take(pa.array(starts)).set_column(at, run.schema.field(at), pa.array(totals))
        held = merged.slice(merged.num_rows - 1)
        yield from merged.slice(0, merged.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def _in_order(entries: DataFrame) -> DataFrame:
    return entries.sortWithinPartitions(*SAME, F.col("best_id").desc_nulls_last(), "best_tag").mapInArrow(merge_runs, ENTRY)


def merged_groups(rows: DataFrame) -> DataFrame:
    """(digest, n_bytes, best_id, best_tag, n) for each distinct text. rows: doc_id, tag, digest, n_bytes."""
    rounds = max(1, math.ceil(math.log(partitions(rows.sparkSession), FAN_IN)))
    cells = FAN_IN**rounds
    entries = _in_order(rows.select(
        F.pmod(F.spark_partition_id(), F.lit(cells)).cast("long").alias("lane"), "digest", "n_bytes",
        F.col("doc_id").alias("best_id"), F.col("tag").alias("best_tag"), F.lit(1).cast("long").alias("n"),
    ))
    for done in range(1, rounds + 1):
        entries = entries.withColumn("lane", F.floor(F.col("lane") / FAN_IN))
        within = F.conv(F.substring("digest", 1, done), 16, 10).cast("long")
        cell = (F.col("lane") * FAN_IN**done + within).cast("int")
        entries = _in_order(entries.withColumn("cell", cell).repartitionById(cells, F.col("cell")).drop("cell"))
    return entries.drop("lane")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The row
    with the largest id stays, rows without an id come last. Of repeated rows with the same id one
    stays; ``group_size`` counts rows. Other columns of ``docs`` are not looked at. No rows: no rows.
    """
    text = ascii_lower(text_of(F.col(text_col)))
    rows = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("tag"),
        F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
    ), "digests")
    groups = merged_groups(rows).where("n > 1")  # the rest stay as they are
    key = ["digest", "n_bytes"]
    alone = F.col("n").isNull()
    return rows.join(groups, key, "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("tag") == F.col("best_tag"))).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
), g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""
