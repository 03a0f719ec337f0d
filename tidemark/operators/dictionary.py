"""Operators on the data dictionary: table and column lists, schemas, Number columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import blank_to_null
from tidemark.functions.names import extract_table
from tidemark.operators.numbering import numbered_lists
from tidemark.sources.model import DECIMAL_TYPE, DICTIONARY_TYPES, NUMBER_TYPES, NUMERIC_RULES, spark_type


def distinct_extracts(rows: DataFrame, order: str) -> DataFrame:
    """Each extract name once, with the first position it is seen at."""
    return rows.groupBy("extract").agg(F.min(order).alias("first_row"))


def columns_per_extract(rows: DataFrame, order: str, size: int = 1000) -> DataFrame:
    """Column names of each extract in order, as lists of at most ``size`` names per row."""
    return numbered_lists(rows, ["extract"], [order, "column_name"], ["column_name"], "columns", size).select(
        "extract", "page", F.col("columns.column_name").alias("columns")
    )


def dictionary_columns(metadata: DataFrame, with_length: bool = False) -> DataFrame:
    """Dictionary rows as ``(table_name, column_name, type)``, with names in lower case; ``with_length`` adds the declared length, NULL where there is none."""
    length = F.col("length").cast("string").try_cast("int") if "length" in metadata.columns else F.lit(None).cast("int")
    return metadata.select(
        extract_table("extract").alias("table_name"),
        F.lower("column_name").alias("column_name"),
        F.lower(F.trim("type")).alias("type"),
        *([F.when(length > 0, length).alias("length")] if with_length else []),
    )


#: Key of a column's metadata that holds its declared length in characters.
LENGTH = "length"


def declare_lengths(schema: T.StructType, lengths: Mapping[str, int | None]) -> T.StructType:
    """``schema`` whose text columns know the lengths declared for them, by lower-case name; other columns stay as they are."""
    fields = []
    for f in schema.fields:
        length = lengths.get(f.name.lower()) if isinstance(f.dataType, T.StringType) else None
        fields.append(T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, LENGTH: length} if length else f.metadata))
    return T.StructType(fields)


def declared_length(field: T.StructField) -> int | None:
    return (field.metadata or {}).get(LENGTH) if isinstance(field.dataType, T.StringType) else None


def spark_type_name(column: str = "column_name", kind: str = "type", number: str = "double") -> Column:
    """Type map as an expression: the Spark type name of a dictionary row; ``number`` is what a Number becomes."""
    kind_text = F.lower(F.trim(F.col(kind)))
    is_number = kind_text.isin(*sorted(NUMBER_TYPES))
    found = F.when(is_number & (F.lower(F.col(column)) == "id"), "bigint").when(is_number, number)
    for name, data_type in DICTIONARY_TYPES.items():
        found = found.when(kind_text == name, data_type.simpleString())
    return found.otherwise("string")


def file_column_types(file_columns: DataFrame, metadata: DataFrame) -> DataFrame:
    """Type of every file column ``(table_name, column_name)``: looked up in the dictionary, text when absent."""
    known = dictionary_columns(metadata).dropDuplicates(["table_name", "column_name"])
    return file_columns.join(known, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", spark_type_name().alias("spark_type"), F.col("type").isNotNull().alias("in_dictionary")
    )


def has_fraction(text: Column) -> Column:
    """Whether a text is a number that a long cannot hold; NULL for other texts."""
    # Below 2^52 a double tells a fraction; only longer numbers need the exact decimal.
    value, exact = text.try_cast("double"), text.try_cast("decimal(38,10)")
    wide = F.abs(value) >= F.lit(9223372036854775807.0)
    large = (F.coalesce(exact != F.floor(exact), value != F.floor(value)) | wide) & ~F.isnan(value)
    return F.when(F.abs(value) < F.lit(float(1 << 52)), value != F.floor(value)).otherwise(large)


def number_kinds(data: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per text column: ``long`` when every number in it is whole, otherwise ``double``.

    All columns are decided over all rows in one aggregation; partial results are two booleans per column.
    """
    columns = list(columns)
    flags = []
    for i, name in enumerate(columns):
        fractional = has_fraction(blank_to_null(F.col(f"`{name}`")))
        flags.append(F.coalesce(F.bool_or(fractional), F.lit(False)).alias(f"f{i}"))
    pairs = ", ".join(f"{i}, f{i}" for i in range(len(columns)))
    names = F.array(*[F.lit(name) for name in columns])
    return (
        data.agg(*flags)
        .select(F.expr(f"stack({len(columns)}, {pairs}) as (position, fractional)"))
        .select(
            F.element_at(names, F.col("position") + 1).alias("column_name"),
            F.when(F.col("fractional"), "double").otherwise("long").alias("inferred"),
        )
    )


def schema_from_metadata(
    rows: Iterable[Mapping],
    columns: Iterable[str],
    data: DataFrame | None = None,
    profile: str = "typed",
    numeric: str = "infer",
) -> T.StructType:
    """Schema of one table's file from its dictionary rows (``column_name``, ``type``), in file order.

    Columns the dictionary does not know are text. ``numeric`` says what a Number becomes: ``infer``
    looks at all of ``data``, ``double`` and ``decimal`` need no pass over it.
    """
    if numeric not in NUMERIC_RULES:
        raise ValueError(f"unknown numeric rule {numeric!r}")
    kinds: dict[str, str] = {}
    for row in rows:
        kinds.setdefault(row["column_name"].lower(), (row["type"] or "").strip().lower())
    columns = list(columns)
    numbers = [c for c in columns if kinds.get(c.lower()) in NUMBER_TYPES]
    number_types: dict[str, T.DataType] = {}
    if profile == "typed" and numbers:
        if numeric == "decimal":
            number_types = {c: DECIMAL_TYPE for c in numbers}
        elif numeric == "infer" and data is not None:
            to_type = {"long": T.LongType(), "double": T.DoubleType()}
            found = number_kinds(data, numbers).collect()  # one row per Number column
            number_types = {r["column_name"]: to_type[r["inferred"]] for r in found}
    return T.StructType(
        [T.StructField(c, spark_type(kinds.get(c.lower(), ""), c, profile, number_types.get(c))) for c in columns]
    )
