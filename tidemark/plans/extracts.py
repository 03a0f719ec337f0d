"""From stored archives to clean extract files."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clean import clean
from tidemark.operators.dictionary import schema_from_metadata
from tidemark.session import delete_path, in_parallel, local_rows, scratch_path
from tidemark.sources.archive import land_records, member_headers, member_table, scan_archive_parts, scan_archives
from tidemark.sources.files import write_csv
from tidemark.sources.listing import pick_latest
from tidemark.sources.model import MANIFEST_FILE, MANIFEST_SCHEMA, METADATA_FILE, METADATA_SCHEMA


def latest_archive(
    listing: DataFrame, kind: str, folder: str, start: str | None = None, stop: str | None = None
) -> list[tuple[str, list[str]]]:
    """The last extract of a kind in the time window, as its archive with the addresses of its parts in order.

    Empty when that extract holds no records. A single row comes to the driver.
    """
    row = pick_latest(listing, kind, start, stop).select(
        "filename", F.array_sort(F.transform("filepart_details", lambda p: F.struct(p["filepart"].alias("part"), p["filename"].alias("file")))).alias("parts")
    ).first()
    if row is None:
        return []
    return [(row["filename"], [f"{folder.rstrip('/')}/{p['file']}" for p in row["parts"]])]


def unpack(
    spark: SparkSession, archives: str | list[tuple[str, list[str]]], out: str, parquet: bool = True, numeric: str = "infer", parallel: int = 8
) -> DataFrame:
    """Archives to one folder of files per member, typed by the archive's own dictionary when written as Parquet.

    ``archives`` is a path or what ``latest_archive`` gives. They are unpacked once; every later step
    reads that columnar copy. Returns ``(member, file, records)``.
    """
    source = scan_archives(spark, archives) if isinstance(archives, str) else scan_archive_parts(spark, archives)
    landed = scratch_path(spark, "unpacked")
    records = land_records(source, landed)
    heads = member_headers(records).collect()  # one row per member
    members = {r["member"]: next(csv.reader([r["header"]])) for r in heads if r["member"].endswith(".csv")}
    metadata_files = {f"{m}.csv" for m in METADATA_FILE.values()}
    dictionary_member = next((m for m in sorted(members) if m.rsplit("/", 1)[-1] in ("metadata.csv", "metadata_full.csv")), None)
    dictionary: dict[str, list[dict]] = {}
    if dictionary_member is not None:
        meta = member_table(records, dictionary_member, members[dictionary_member])
        for r in meta.select("extract", "column_name", "type").collect():
            dictionary.setdefault(r["extract"], []).append(r.asDict())

    def convert(member: str) -> tuple[str, str]:
        columns = members[member]
        rows = member_table(records, member, columns)
        if not parquet:
            write_csv(rows, f"{out}/{member}")
            return member, f"{out}/{member}"
        if member == f"{MANIFEST_FILE}.csv":
            schema = MANIFEST_SCHEMA
        elif member in metadata_files:
            schema = METADATA_SCHEMA
        else:
            extract = member[: -len(".csv")].replace("/", ".")
            schema = schema_from_metadata(dictionary.get(extract, []), columns, rows, numeric=numeric)
        path = f"{out}/{member[: -len('.csv')]}.parquet"
        clean(rows, schema).write.parquet(path)
        return member, path

    made = in_parallel(spark, convert, sorted(members), parallel)
    counts = records.where("record_no > 0").groupBy("member").agg(F.count(F.lit(1)).alias("records"))
    found = {r["member"]: r["records"] for r in counts.collect()}  # one row per member
    delete_path(spark, landed)
    return local_rows(spark, [(m, f, found.get(m, 0)) for m, f in made], "member string, file string, records bigint")

