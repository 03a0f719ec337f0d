"""The last writer wins, also when it came first: when each key was last changed, kept for as long as its table.

Extracts can arrive out of order, hours apart. A clock table beside each table holds one row per key that a stream has changed: the stop time of the extract that did, and
whether it deleted the key (a tombstone, since a deleted row itself can't tell). A batch of changes is held against the clocks of its own keys; what a
later extract has overtaken is left out. Clock tables are bucketed by key like the tables, so a batch reads and rewrites the buckets of its keys only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.target import Target
from tidemark.session import settle

AT, DELETED = "__at", "__deleted"


def clocks_of(target: Target) -> Target:
    """Clock tables, named as the tables they belong to; ``target`` does not list them."""
    return Target(target.spark, f"{target.root}/_clocks", target.buckets)


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"__k_{k}") for k in keys]


def last_changes(changes: DataFrame, keys: Sequence[str], at: Column, deleted: Column) -> DataFrame:
    """One row per key: its last stop time, and whether it is deleted by then; in one extract an update survives a delete. Combined before the shuffle."""
    last = F.max(F.struct(at.alias("at"), (~deleted).alias("alive")))
    return changes.groupBy(*keys).agg(last.alias("__last")).select(*keys, F.col("__last.at").alias(AT), (~F.col("__last.alive")).alias(DELETED))


def admit(target: Target, table: str, keys: Sequence[str], last: DataFrame) -> DataFrame:
    """Those rows of ``last`` (see ``last_changes``) that no earlier batch has overtaken; stored.

    Of one stop time, a later batch wins, but its deletes spare what an earlier one has updated: they are parts of one extract.
    """
    last = settle(last, "last-changes")
    clocks = clocks_of(target)
    clocks.create(table, T.StructType([last.schema[k] for k in keys] + [last.schema[AT], last.schema[DELETED]]), list(keys), target._must(table).buckets)
    snap = clocks._must(table)
    if not snap.files:
        return last
    touched, _ = clocks._touched(snap, last, None)
    seen = clocks._scan(table, snap, touched).select(*_renamed(keys), F.col(AT).alias("__seen_at"), F.col(DELETED).alias("__seen_deleted"))
    late = (F.col(AT) < F.col("__seen_at")) | ((F.col(AT) == F.col("__seen_at")) & F.col(DELETED) & ~F.col("__seen_deleted"))
    overtaken = last.join(seen, _same(keys)).where(late).select(*_renamed(keys))
    return settle(last.join(overtaken, _same(keys), "left_anti"), "admitted")


def of_admitted(rows: DataFrame, admitted: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Rows whose key is admitted; ``more`` conditions may compare them with AT and DELETED."""
    wanted = admitted.select(*_renamed(keys), AT, DELETED)
    return rows.join(wanted, reduce(and_, [_same(keys), *more]), "left_semi")


def advance(target: Target, table: str, keys: Sequence[str], admitted: DataFrame, applied: str | None) -> None:
    """Set the clocks, after the table itself; done again with the same rows after a failure in between, it changes nothing."""
    clocks_of(target).change(table, admitted, None, list(keys), applied=applied)


def is_set(target: Target, table: str, applied: str | None) -> bool:
    """Whether the clocks of a change are set already."""
    snap = clocks_of(target).snapshot(table)
    return applied is not None and snap is not None and snap.applied == applied
