"""Operators on document versions, their JSON records and export results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import disposition_filename, staging_path, version_part, version_path
from tidemark.operators.numbering import batch_rows, numbered_lists, page

VERSION_ORDER = ("doc_id", "major", "minor")


def select_versions(versions: DataFrame, keep: Sequence[str] = ("version_id", "name__v")) -> DataFrame:
    """Versions that have a file, with the numbers of their version id."""
    return versions.where(F.col("size__v").isNotNull()).select(
        *keep,
        version_part("version_id", 1).alias("doc_id"),
        version_part("version_id", 2).alias("major"),
        version_part("version_id", 3).alias("minor"),
    )


def latest_version(df: DataFrame, doc: str, order: Sequence[str]) -> DataFrame:
    """The last version of each document. The rank limit is applied before the shuffle too."""
    window = Window.partitionBy(doc).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def all_versions(df: DataFrame, doc: str, order: Sequence[str], fields: Sequence[str], size: int = 1000) -> DataFrame:
    """Every version of each document in order, as lists of at most ``size``."""
    return numbered_lists(df, [doc], order, fields, "versions", size)


def batch_to_json(versions: DataFrame, size: int = 10_000) -> DataFrame:
    """Request body of each batch of versions: a JSON array of objects with text values."""
    batched = batch_rows(versions.select(*VERSION_ORDER), VERSION_ORDER, size)
    # fixed values: field names of the request objects
    item = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("major").cast("string").alias("major_version_number__v"),
        F.col("minor").cast("string").alias("minor_version_number__v"),
    )
    place = F.struct(*VERSION_ORDER, item.alias("item"))
    listed = batched.groupBy("batch").agg(F.array_sort(F.collect_list(place)).alias("items"))
    return listed.select(
        "batch",
        F.size("items").cast("bigint").alias("n_versions"),
        F.to_json(F.transform("items", lambda x: x["item"])).alias("body"),
    )


def keyword_search(df: DataFrame, keyword: str, content: str, fields: Sequence[str] = ()) -> DataFrame:
    """Rows whose content, or one of the further fields, holds the keyword; case is ignored."""
    hit: Column = F.lit(False)
    for c in (content, *fields):
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(keyword.lower())), F.lit(False))
    return df.where(hit)


def document_page(
    df: DataFrame, sort: Sequence[str | Column], start: int, limit: int
) -> DataFrame:
    """Documents in ``sort`` order from ``start``, at most ``limit``."""
    return page(df, sort, limit, start)


def open_record(df: DataFrame, column: str, known: T.StructType, rest: str = "rest") -> DataFrame:
    """Known fields of a JSON object as typed columns, all others in a map of text."""
    everything = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    names = F.array(*[F.lit(n) for n in known.names]) if known.names else F.array().cast("array<string>")
    return df.select(
        *[c for c in df.columns],
        F.from_json(F.col(column), known).alias("__known"),
        F.map_filter(everything, lambda k, v: ~F.array_contains(names, k)).alias(rest),
    ).select(*df.columns, "__known.*", rest)


#: States of a record: an object, JSON of another kind, or text that is no JSON (cut off, or with a repeated name).
OPEN, OTHER, BROKEN = "object", "other", "broken"


def open_typed_record(df: DataFrame, column: str, known: T.StructType, rest: str = "rest", state: str = "state") -> DataFrame:
    """Known fields of a JSON object as typed columns, all others in a map of variants, which keep their types and their nesting.

    The text is parsed once. ``state`` tells an ``object`` from ``other`` JSON and from ``broken`` text; a NULL text has none. Values that do not convert are NULL, and so
    are ``rest`` and all known fields of what is no object.
    """
    parsed = df.withColumn("__json", F.try_parse_json(F.col(column)))
    opened = parsed.withColumn("__all", F.try_variant_get("__json", "$", "map<string,variant>"))
    names = F.array(*[F.lit(n) for n in known.names]) if known.names else F.array().cast("array<string>")
    fields = [F.try_variant_get(F.try_element_at("__all", F.lit(f.name)), "$", f.dataType.simpleString()).alias(f.name) for f in known.fields]
    found = F.when(F.col("__all").isNotNull(), OPEN).when(F.col("__json").isNotNull(), OTHER).when(F.col(column).isNotNull(), BROKEN)
    return opened.select(*df.columns, *fields, F.map_filter("__all", lambda k, v: ~F.array_contains(names, k)).alias(rest), found.alias(state))


def export_succeeded(results: DataFrame) -> DataFrame:
    """Export results with status SUCCESS, in any case."""
    return results.where(F.lower("responseStatus") == "success")


def export_failed(results: DataFrame) -> DataFrame:
    """The other results, those without a status included."""
    return results.where(F.coalesce(F.lower("responseStatus") != "success", F.lit(True)))


def text_objects(versions: DataFrame, texts: DataFrame, batch_size: int = 10_000) -> DataFrame:
    """``(batch, path, text)`` for every version that has a file and a text; versions whose text failed are left out.

    ``texts`` is ``(doc_id, major, minor, text)`` with an optional ``error``.
    """
    wanted = batch_rows(select_versions(versions), VERSION_ORDER, batch_size)
    good = texts.where(F.col("error").isNull()).drop("error") if "error" in texts.columns else texts
    name = F.concat(F.col("name__v"), F.lit(".txt"))
    return wanted.join(good, list(VERSION_ORDER)).select(
        "batch", version_path("doc_id", "major", "minor", name).alias("path"), "text"
    )


def content_objects(versions: DataFrame, results: DataFrame, batch_size: int = 10_000, sees_all: Column | None = None) -> DataFrame:
    """``(batch, path, staged_at, content)`` of every successfully exported version.

    ``results`` holds ``responseStatus, id, major_version_number__v, minor_version_number__v, file,
    user_id__v, content_disposition, content``.
    """
    wanted = batch_rows(select_versions(versions, ["version_id"]), VERSION_ORDER, batch_size)
    good = export_succeeded(results).select(
        F.col("id").cast("bigint").alias("doc_id"),
        F.col("major_version_number__v").cast("bigint").alias("major"),
        F.col("minor_version_number__v").cast("bigint").alias("minor"),
        disposition_filename("content_disposition").alias("filename"),
        staging_path("file", "user_id__v", F.lit(True) if sees_all is None else sees_all).alias("staged_at"),
        "content",
    )
    return wanted.join(good, list(VERSION_ORDER)).select(
        "batch", version_path("doc_id", "major", "minor", "filename").alias("path"), "staged_at", "content"
    )
