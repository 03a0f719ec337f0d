"""Row changes by key: delete, delete-and-insert upsert, merge. All are equi-joins left to the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import convert_value


#: Rows of a large merge that one task sorts.
ROWS_A_TASK = 250_000


def typed_keys(changes: DataFrame, target_schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """``changes`` with its key columns in the target's types; a key that does not convert matches nothing."""
    wanted = {f.name.lower(): f.dataType for f in target_schema.fields}
    have = {f.name.lower(): f.dataType for f in changes.schema.fields}
    for key in keys:
        if key.lower() in wanted and have[key.lower()] != wanted[key.lower()]:
            changes = changes.withColumn(key, F.col(key).try_cast(wanted[key.lower()]))
    return changes


def _distinct_keys(changes: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Combined before the shuffle: a key repeated many times reaches the join once.
    return typed_keys(changes.select(*keys), target.schema, keys).distinct()


def matched_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in ``changes``."""
    return target.join(_distinct_keys(changes, target, keys), list(keys), "left_semi")


def delete_by_key(
    target: DataFrame, deletes: DataFrame, keys: Sequence[str], key_match: str = "tuple", few_keys: bool = False
) -> DataFrame:
    """Target rows whose key does not occur in ``deletes``; a NULL key never matches.

    ``few_keys`` is for callers who have counted the keys: they are then sent to all tasks and the
    target is not shuffled. Otherwise the optimizer decides by the sizes it knows.

    ``key_match="concat"`` compares the key parts joined without a separator, so different keys may
    meet; it is kept for loads that depend on it.
    """
    if key_match == "tuple":
        gone = _distinct_keys(deletes, target, keys)
        return target.join(F.broadcast(gone) if few_keys else gone, list(keys), "left_anti")
    if key_match != "concat":
        raise ValueError(f"unknown key match {key_match!r}")
    joined = deletes.select(F.concat(*[F.col(k).cast("string") for k in keys]).alias("__key")).distinct()
    target_key = F.concat(*[F.col(k).cast("string") for k in keys])
    return target.join(joined, target_key == F.col("__key"), "left_anti")


def conform(
    df: DataFrame, schema: T.StructType, match: str = "name", strict: bool = False
) -> DataFrame:
    """``df`` in the columns, order and types of ``schema``.

    By name, ignoring case, columns absent from ``df`` become NULL and columns unknown to ``schema``
    are left out. By position, both sides need the same number of columns.
    """
    if match == "position":
        if len(df.columns) != len(schema.fields):
            raise ValueError(f"{len(df.columns)} columns do not fit {len(schema.fields)} by position")
        df = df.toDF(*schema.names)
    elif match != "name":
        raise ValueError(f"unknown match {match!r}")
    have = {f.name.lower(): f for f in df.schema.fields}
    if strict and set(have) - {n.lower() for n in schema.names}:
        raise ValueError("columns unknown to the target: " + ", ".join(sorted(set(have) - {n.lower() for n in schema.names})))
    columns: list[Column] = []
    for field in schema.fields:
        source = have.get(field.name.lower())
        if source is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            value = convert_value(F.col(f"`{source.name}`"), source.dataType, field.dataType)
            columns.append(value.alias(field.name))
    return df.select(*columns)


def append(target: DataFrame, rows: DataFrame, match: str = "name") -> DataFrame:
    """All rows of both."""
    return target.unionByName(conform(rows, target.schema, match))


def _dealt_by_key(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a large merge in as many partitions as their rows need, so that what a task sorts does not grow with the tables; otherwise as they are."""
    partitions = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    changed = rows.count()
    if changed <= ROWS_A_TASK:
        return target, rows  # may be sent to every task
    wanted = -(-(target.count() + changed) // ROWS_A_TASK)
    if wanted <= partitions:
        return target, rows
    by_key = [F.col(f"`{k}`") for k in keys]
    return target.repartition(wanted, *by_key), rows.repartition(wanted, *by_key)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str = "delete_insert", distinct: bool = True
) -> DataFrame:
    """Target after ``updates``; whole rows are replaced, columns absent from the updates become NULL.

    ``delete_insert`` removes every target row whose key is updated and adds the update rows (each
    different row of a key is kept; equal rows once when ``distinct``). ``merge`` replaces each
    matched target row and adds unmatched update rows; it fails when one key of the updates hits a
    target row twice.
    """
    keys = list(keys)
    rows = conform(updates, target.schema)
    if mode == "delete_insert":
        kept = target.join(rows.select(*keys).distinct(), keys, "left_anti")
        return kept.select(*target.columns).unionByName(rows.distinct() if distinct else rows)
    if mode != "merge":
        raise ValueError(f"unknown upsert mode {mode!r}")

    target, rows = _dealt_by_key(target, rows, keys)
    # One candidate per key with its count, so the target side stays the streamed (and splittable) side.
    candidate = (
        rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*target.columns)).alias("__row"))
    )
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    twice = F.raise_error(F.lit("a key of the updates matches a target row more than once"))
    hit = F.when(F.col("__n") > 1, twice.cast("boolean")).otherwise(F.col("__n").isNotNull())
    updated = (
        target.join(candidate, condition, "left")
        .withColumn("__hit", hit)
        .select(*[F.when(F.col("__hit"), F.col(f"__row.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])
    )
    # Keys already there: only these few are compared with the updates again.
    present = target.select(*keys).join(rows.select(*keys).distinct(), keys, "left_semi").distinct()
    return updated.unionByName(rows.join(present, keys, "left_anti").select(*target.columns))


def merge_delete(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge whose matched rows are deleted."""
    return delete_by_key(target, deletes, keys)


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
