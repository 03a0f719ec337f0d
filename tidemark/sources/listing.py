"""Manifest, data dictionary and extract listing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import extract_table, parquet_file
from tidemark.operators.change import conform
from tidemark.session import release, settle
from tidemark.sources.files import scan_csv, scan_parquet
from tidemark.sources.model import (
    EXTRACT_KINDS,
    LISTING_SCHEMA,
    MANIFEST_FILE,
    MANIFEST_SCHEMA,
    METADATA_EXTRACT,
    METADATA_SCHEMA,
    METADATA_TABLE,
    metadata_path,
)


def scan_file(spark: SparkSession, path: str, parquet: bool = False) -> DataFrame:
    """One extract file: text columns from CSV, or the Parquet file of the same name."""
    return scan_parquet(spark, path) if parquet else scan_csv(spark, path)


def _fixed(df: DataFrame, schema: T.StructType) -> DataFrame:
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return conform(lowered, schema)


def scan_manifest(spark: SparkSession, extract_dir: str, parquet: bool = False) -> DataFrame:
    extension = ".parquet" if parquet else ".csv"
    return _fixed(scan_file(spark, f"{extract_dir}/{MANIFEST_FILE}{extension}", parquet), MANIFEST_SCHEMA)


def scan_metadata(spark: SparkSession, extract_dir: str, kind: str = "full", parquet: bool = False) -> DataFrame:
    extension = ".parquet" if parquet else ".csv"
    return _fixed(scan_file(spark, f"{extract_dir}/{metadata_path(kind)}{extension}", parquet), METADATA_SCHEMA)


def manifest_tables(manifest: DataFrame, change: str = "updates", kind: str = "full") -> DataFrame:
    """Manifest rows to load: of one change type, with records, and without the dictionary on incremental runs."""
    if kind not in EXTRACT_KINDS:
        raise ValueError(f"unknown extract kind {kind!r}")
    rows = manifest.where((F.col("type") == change) & (F.col("records") > 0)).withColumn(
        "table_name", extract_table("extract")
    )
    if kind == "incremental" and change == "updates":
        rows = rows.where(F.col("table_name") != METADATA_TABLE)
    return rows


def metadata_changes(manifest: DataFrame, change: str) -> DataFrame:
    """Manifest rows of dictionary changes of one type that hold records."""
    return manifest.where((F.col("extract") == METADATA_EXTRACT) & (F.col("type") == change) & (F.col("records") > 0))


def extract_paths(manifest: DataFrame, extract_dir: str, parquet: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Table name and object path of each manifest row."""
    file = parquet_file("file") if parquet else F.col("file")
    return manifest.select(
        extract_table("extract").alias("table_name"), F.concat_ws("/", F.lit(extract_dir), file).alias("path"), *keep
    )


def pick_latest(listing: DataFrame, kind: str, start: str | None = None, stop: str | None = None) -> DataFrame:
    """The last extract of a kind that lies in the time window; nothing when that extract holds no records."""
    rows = listing.where(F.lower("extract_type") == kind.lower())
    if start is not None:
        rows = rows.where(F.col("start_time") >= start)
    if stop is not None:
        rows = rows.where(F.col("stop_time") <= stop)
    return rows.orderBy(F.col("stop_time").desc(), F.col("name").desc()).limit(1).where("record_count > 0")


def extracts_in_order(listing: DataFrame, kind: str) -> DataFrame:
    """Extracts of a kind that hold records, oldest first."""
    rows = listing.where((F.lower("extract_type") == kind.lower()) & (F.col("record_count") > 0))
    return rows.orderBy("stop_time", "name")


def reassemble_parts(parts: DataFrame, name: str = "name", part: str = "filepart", data: str = "data") -> DataFrame:
    """Objects put together from their parts, numbered from 1; a missing or repeated part is an error.

    One object is one value; for archives larger than a value use the archive source, which streams the parts in order.
    """
    listed = parts.groupBy(name).agg(F.array_sort(F.collect_list(F.struct(part, data))).alias("__parts"))
    numbers = F.transform("__parts", lambda p: p[part].cast("bigint"))
    whole = numbers == F.sequence(F.lit(1).cast("bigint"), F.size("__parts").cast("bigint"))
    pieces = F.transform("__parts", lambda p: p[data])
    if isinstance(parts.schema[data].dataType, T.BinaryType):
        joined = F.unhex(F.array_join(F.transform(pieces, F.hex), ""))
    else:
        joined = F.array_join(pieces, "")
    missing = F.raise_error(F.concat(F.lit("parts are missing or repeated of "), F.col(f"`{name}`").cast("string")))
    return listed.select(name, F.when(whole, joined).otherwise(missing).alias(data))


PIECE_BYTES = 8 << 20


def stored_pieces(
    parts: DataFrame, name: str = "name", part: str = "filepart", data: str = "data", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """Objects of any size as rows ``(name, first_part, last_part, data)``: pieces of about ``piece_bytes``, which follow each other; stored.

    Parts are numbered from 1; a missing or repeated one is an error, a null one is empty. They are sorted by object and number, and an object with very many parts
    lies in several partitions. A task passes over its parts and hands on a piece at a time, so its memory does not depend on the size of an object. Equal parts meet in one task, which
    finds repeats; with none, an object is whole if it has as many parts as its last number says.
    """
    binary = isinstance(parts.schema[data].dataType, T.BinaryType)
    text = F.col(f"`{data}`")
    rows = parts.select(F.col(f"`{name}`").cast("string").alias("name"), F.col(f"`{part}`").cast("bigint").alias("part"), (text if binary else text.cast("binary")).alias("data"))
    ordered = rows.repartitionByRange("name", "part").sortWithinPartitions("name", "part")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: list = []  # name, first part, last part
        held: list[bytes] = []
        size = 0

        def made() -> pa.RecordBatch:
            values = [*begun, b"".join(held)]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["name", "first_part", "last_part", "data"])

        for batch in batches:
            for own, number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if begun and begun[0] == own and number != begun[2] + 1:
                    raise ValueError(f"parts are missing or repeated of {own}")
                if begun and (begun[0] != own or size >= piece_bytes):
                    yield made()
                    begun, size = [], 0
                    held.clear()
                begun = [own, begun[1] if begun else number, number]
                held.append(body.as_py() or b"")
                size += len(held[-1])
        if begun:
            yield made()

    stored = settle(ordered.mapInArrow(pieces, "name string, first_part bigint, last_part bigint, data binary"), "pieces")
    counted = stored.groupBy("name").agg(F.sum(F.col("last_part") - F.col("first_part") + 1).alias("n"), F.min("first_part").alias("first"), F.max("last_part").alias("last"))
    broken = counted.where("NOT (first <=> 1 AND n <=> last)").limit(1).collect()
    if broken:
        release(stored)
        raise ValueError(f"parts are missing or repeated of {broken[0]['name']}")
    return stored if binary else stored.withColumn("data", F.col("data").cast("string"))


def scan_listing(spark: SparkSession, path: str, parquet: bool = False) -> DataFrame:
    """The stored extract listing, one JSON object per line or Parquet."""
    return spark.read.schema(LISTING_SCHEMA).parquet(path) if parquet else spark.read.schema(LISTING_SCHEMA).json(path)
