"""Extracts that keep arriving, applied in order with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.loads import LoadOptions, apply_incremental
from tidemark.plans.target import Target
from tidemark.session import files_at, release, settle
from tidemark.sources.files import CSV_OPTIONS
from tidemark.sources.listing import scan_listing
from tidemark.sources.model import MANIFEST_FILE, MANIFEST_SCHEMA
from tidemark.streaming.clock import AT, DELETED, admit, advance, is_set, last_changes, of_admitted


#: Files that wait when a run begins are taken in about as many batches at most: each rewrites the buckets of its keys, so with more, a run's work would grow with the square of what waits.
MOST_BATCHES = 6


def _files_a_batch(spark: SparkSession, landing: str, wanted: int) -> int:
    """``wanted`` files, or as many more as keep the files that are there to ``MOST_BATCHES`` batches."""
    return max(wanted, -(-len(files_at(spark, landing)) // MOST_BATCHES))


def stream_table(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: Target,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    order: str,
    files_per_batch: int = 1000,
    deleted: str | None = None,
) -> StreamingQuery:
    """Upsert the Parquet files that land in a folder, each file once.

    Rows carry the stop time of their extract in column ``order``; of one key, the rows of the latest extract win, whether the others come in the same batch, earlier or later.
    A batch takes ``files_per_batch`` files, or more where many wait. Where the column ``deleted`` is true, the row deletes its key; an update of the same extract survives that. A batch that is repeated after a failure is recognised and gives the same table.
    """
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", _files_a_batch(spark, landing, files_per_batch)).parquet(landing)
    keys = list(keys)
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)

    def apply(batch: DataFrame, batch_id: int) -> None:
        token = f"{checkpoint}#{batch_id}"
        if is_set(target, table, token):
            return
        # The latest time of each key is found before the shuffle; a hot key's rows are never brought together.
        stored = settle(batch.distinct(), "stream")
        admitted = admit(target, table, keys, last_changes(stored, keys, F.col(order), gone))
        if target._must(table).applied != token:
            last = F.col(order).eqNullSafe(F.col(AT))
            rows = settle(of_admitted(stored, admitted, keys, last, gone == F.col(DELETED)), "stream")
            target.change(table, rows.where(~gone), rows.where(gone) if deleted else None, keys, applied=token)
            release(rows)
        advance(target, table, keys, admitted, token)
        release(stored, admitted)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stop_times(spark: SparkSession, listing: str, parquet: bool = False) -> dict[str, str]:
    """Stop time by extract name of a stored listing, which has a row per extract."""
    return {r["name"]: r["stop_time"] for r in scan_listing(spark, listing, parquet).select("name", "stop_time").collect()}


def stream_extracts(
    spark: SparkSession,
    landing: str,
    target: Target,
    checkpoint: str,
    options: LoadOptions = LoadOptions(),
    listing: str | None = None,
) -> StreamingQuery:
    """Apply whole incremental extracts as their folders land, in the order of their stop times.

    ``listing`` is the address of the stored listing (JSON lines), which is read anew for every batch and must name each folder; without it the folder names are the stop times. An extract
    that lands after a later one changes only the keys that the later ones have left alone. Changes of its dictionary are applied as they come.

    A folder counts as landed when its manifest is there, so the manifest is to be written last.
    """
    extension = "parquet" if options.parquet else "csv"
    reader = spark.readStream.schema(MANIFEST_SCHEMA)
    pattern = f"{landing.rstrip('/')}/*/{MANIFEST_FILE}.{extension}"
    rows = reader.parquet(pattern) if options.parquet else reader.options(header=True, **CSV_OPTIONS).csv(pattern)
    folder = F.regexp_extract("_metadata.file_path", rf"^(.*)/{MANIFEST_FILE}\.{extension}(/[^/]*)?$", 1)
    folders = rows.select(folder.alias("folder"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        # One name per extract that landed since the last batch.
        landed = [r["folder"] for r in batch.distinct().collect()]
        times = stop_times(spark, listing) if listing else {}
        at = {f: times[f.rsplit("/", 1)[-1]] if listing else f.rsplit("/", 1)[-1] for f in landed}
        for folder in sorted(landed, key=lambda f: (at[f], f)):
            apply_incremental(spark, folder, target, options, applied=folder, stop_time=at[folder])

    return (
        folders.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
