"""Exact dedup by a tree of merges over runs of digests, in DataFrame operations only.

Each scan partition is reduced to a run: one row per digest with the number of its texts and its best identifier. Runs are then merged
``fan_in`` at a time, round by round, each round a shuffle of digests by (digest, merged run), until one run is left. So a digest that a
third of all rows share is one row per partition after the first, map-side combined step, and no round ever gathers its documents.
The way back goes from the last run to the first ones (at most one row per digest and partition) and from those to the documents of the
same partition, so that a hot digest is spread over as many keys as there are partitions.

A digest is SHA-256 with the length and a second, independent hash of the text; rows merge only when all three agree, and that is
checked again at every level, because all three are the key of every merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

SPACE = r"[\x20\x09-\x0D]+"
KEY = ["digest", "norm_bytes", "second"]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, stored: id, digest of the text without white space, code points, the run (scan partition) and a row number."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    plain = texts.select("id", F.char_length("text").cast("bigint").alias("chars"), F.regexp_replace("text", SPACE, "").alias("norm"))
    rows = plain.select(
        "id", "chars", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").cast("bigint").alias("norm_bytes"),
        F.xxhash64("norm").alias("second"), F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"),
    )
    return settle(rows, "digest-runs")


def _best():
    # Most code points first, then the smallest id, nulls last, then the first row.
    return F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))


def merge_runs(runs: DataFrame, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """The first runs and the one run that is left: KEY, best, n."""
    first = settle(runs.groupBy(*KEY, "run").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("n")), "run-0")
    left = (first.agg(F.max("run")).first()[0] or 0) + 1
    merged = first
    while left > 1:
        left = -(-left // fan_in)
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy(*KEY, "run")
            .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        )
    return first, merged.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16) -> DataFrame:
    """For each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters ``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code points stays, then the
    one with the smallest id. A null text is an empty one; empty texts are equal to each other. A null id comes after all others.
    Rows that repeat id and text are all returned, and only the first of them is kept. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    runs = digest_runs(docs, id_col, text_col)
    first, last = merge_runs(runs, fan_in)
    # Back to each run, then to the rows of that run: a hot digest has a key of its own in every run.
    per_run = first.select(*KEY, "run").join(last, KEY)
    rows = runs.join(per_run, [*KEY, "run"])
    return rows.select(
        F.col("id"), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
