"""Parent rows with their child rows nested, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import numbered_lists


def nest(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    name: str,
    order: Sequence[str],
    size: int = 1000,
) -> DataFrame:
    """Each parent with its children in ``order`` as an array of structs.

    Children come in pages of at most ``size``: a parent with more children takes several rows
    (``page`` 0, 1, ...), one without children takes one row with an empty array.
    """
    fields = [c for c in child.columns if c != child_key]
    pages = numbered_lists(child, [child_key], order, fields, name, size)
    # An inner join lets a parent with very many pages be split over tasks; an outer one would not.
    with_children = parent.join(pages, parent[parent_key] == pages[child_key]).select(
        *[parent[c] for c in parent.columns], "page", name
    )
    held = child.select(F.col(child_key).alias("__held")).distinct()
    childless = parent.join(held, F.col(parent_key) == F.col("__held"), "left_anti").select(
        *parent.columns, F.lit(0).cast("bigint").alias("page"), F.array().cast(pages.schema[name].dataType).alias(name)
    )
    return with_children.unionByName(childless)


def unnest(df: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """One row per nested child."""
    return df.select(*keep, F.explode(name).alias("__child")).select(*keep, "__child.*")


def rows_to_structs(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rows", size: int = 1000
) -> DataFrame:
    """Rows of a group as arrays of objects, in pages of at most ``size``."""
    fields = [c for c in df.columns if c not in group]
    return numbered_lists(df, group, order, fields, name, size)
