"""Rows of a table of documents, told apart even where they share an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The document key of a null id: after all others.
NO_ID = 2**63 - 1


def id_key(id_col: str) -> Column:
    return F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID))


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """doc, version, text and ``more``. ``version`` tells rows apart that share an id; a null text is an empty one."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(id_key(id_col).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"), *more)


def whole_row(docs: DataFrame, without: list[str]) -> Column:
    """All columns in one struct, in which their names clash with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row")
