"""Exact global positions, batches, pages and bounded lists, without a single-task window."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import local_rows, observed, release, settle

SHALLOW_PAGE = 100_000
HOT_GROUP = 1_000_000
_SEQUENCE = "__seq"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in ``order``.

    A range sort spreads the rows, hot order values included as long as ``order`` has a second
    column. Each row then knows its partition and its place in it; only one count per partition is
    summed up and sent to all tasks, so its size is the number of partitions, not of rows.
    """
    placed = settle(df.orderBy(*order).withColumn(_SEQUENCE, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(_SEQUENCE), _POSITION_BITS)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for row in counts:
        starts.append((row["part"], total))
        total += row["n"]
    offsets = local_rows(df.sparkSession, starts, "__part bigint, __start bigint")
    place = F.col(_SEQUENCE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__start") + place)
        .drop("__part", "__start", _SEQUENCE)
    )


def batch_rows(df: DataFrame, order: Sequence[str | Column], size: int = 10_000, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows: every batch but the last is full."""
    if isinstance(size, bool) or not isinstance(size, int) or size <= 0:
        raise ValueError("batch size must be a positive whole number")
    return number_rows(df, order, "__row").withColumn(name, F.expr(f"__row div {size}")).drop("__row")


def numbered_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place", hot_rows: int = HOT_GROUP
) -> DataFrame:
    """0-based place of each row within its group, in ``order``.

    Groups of up to ``hot_rows`` rows are numbered by a window. A larger group would put all its rows
    into one task; those groups, found by a count that is combined before its shuffle, are placed
    globally instead: the place is then the distance to the group's first row.
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > hot_rows).select(*[F.col(g).alias(f"__{g}") for g in group])
    in_hot = _same_group(group)
    window = Window.partitionBy(*group).orderBy(*order)
    if hot.isEmpty():
        return df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
    cold_rows = df.join(hot, in_hot, "left_anti")
    hot_placed = number_rows(df.join(hot, in_hot, "left_semi"), [*group, *order], "__row")
    first = hot_placed.groupBy(*[F.col(g).alias(f"__{g}") for g in group]).agg(F.min("__row").alias("__first"))
    numbered = hot_placed.join(first, in_hot).select(*df.columns, (F.col("__row") - F.col("__first")).alias(name))
    return cold_rows.withColumn(name, F.row_number().over(window).cast("bigint") - 1).unionByName(numbered)


def _same_group(group: Sequence[str]) -> Column:
    condition = F.lit(True)
    for g in group:
        condition = condition & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return condition


def numbered_lists(
    df: DataFrame, group: Sequence[str], order: Sequence[str], fields: Sequence[str], name: str, size: int = 1000,
    hot_rows: int = HOT_GROUP,
) -> DataFrame:
    """Rows of each group as arrays of structs, at most ``size`` per row, with a 0-based ``page``.

    A group of any size becomes as many rows as it needs: no array ever holds more than ``size``
    members of it.
    """
    paged = numbered_in_group(df, group, order, "__place", hot_rows)
    item = F.struct(F.col("__place"), F.struct(*fields).alias("item"))
    lists = (
        paged.withColumn("page", F.expr(f"__place div {size}"))
        .groupBy(*group, "page")
        .agg(F.array_sort(F.collect_list(item)).alias("__items"))
    )
    return lists.select(*group, "page", F.transform("__items", lambda x: x["item"]).alias(name))


def max_rows(df: DataFrame, order: Sequence[str | Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in ``order``."""
    return page(df, order, limit, 0)


def page(df: DataFrame, order: Sequence[str | Column], size: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` in ``order``.

    Rows that ``order`` does not tell apart follow in the order of their other columns, so every page is certain.
    Near the start this is a top-k per task. A deep page is cut out of the globally numbered rows
    instead, because a top-k would carry all skipped rows to one task.
    """
    if size < 0 or offset < 0:
        raise ValueError("page size and offset must not be negative")
    order = [*order, *[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]]
    if size + offset <= SHALLOW_PAGE:
        return df.orderBy(*order).offset(offset).limit(size) if offset else df.orderBy(*order).limit(size)
    placed = number_rows(df, order, "__row")
    wanted = placed.where((F.col("__row") >= offset) & (F.col("__row") < offset + size))
    return wanted.drop("__row").orderBy(*order)


@dataclass(frozen=True)
class KeysetPage:
    """Rows of a page, stored, in ``order``, and the tokens of the pages around it; None where there is none."""

    rows: DataFrame
    order: list[str]
    next: str | None
    previous: str | None

    def in_order(self) -> DataFrame:
        return self.rows.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in self.order])


_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def keyset_page(df: DataFrame, order: Sequence[str], size: int, token: str | None = None) -> KeysetPage:
    """The page of ``size`` rows that a token leads to, the first one without a token; nulls come first.

    A token holds the boundary row's values, its direction and how many equal rows are behind it already, so that a page costs the same at any depth: a filter on the order, which
    reaches the scan, and the least rows of each task. Rows that ``order`` does not tell apart follow in the order of their other columns, equal rows one by one.
    """
    if size <= 0:
        raise ValueError("page size must be positive")
    named = list(order) + [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    schema = T.StructType([df.schema[c] for c in named])
    at = json.loads(token) if token else {"back": False, "seen": 0, "row": None}
    back, seen = at["back"], at["seen"]
    rows = df
    if at["row"] is not None:
        rows = df.where(_from_boundary(named, F.from_json(F.lit(at["row"]), schema, _TIMES), back))
    direction = [F.col(f"`{c}`").desc_nulls_last() if back else F.col(f"`{c}`").asc_nulls_first() for c in named]
    taken, more = _cut(rows, direction, seen, size)
    key = F.struct(*[F.col(f"`{c}`") for c in named])
    # The two rows at the ends and how often they come; not the page itself, which may be large.
    ends = taken.agg(F.min(key).alias("low"), F.max(key).alias("high"))
    counts = taken.crossJoin(F.broadcast(ends)).groupBy("low", "high").agg(
        F.count_if(key.eqNullSafe(F.col("low"))).alias("n_low"), F.count_if(key.eqNullSafe(F.col("high"))).alias("n_high"))
    found = counts.select(F.to_json("low", _TIMES).alias("low"), F.to_json("high", _TIMES).alias("high"), "n_low", "n_high", F.col("low").eqNullSafe(F.col("high")).alias("one")).first()

    def boundary(end: str, backwards: bool) -> str | None:
        if found is None:
            return None
        # A page of one repeated row goes on where the one before it has ended.
        earlier = seen if found["one"] and at["row"] == found[end] and backwards == back else 0
        return json.dumps({"back": backwards, "seen": found[f"n_{end}"] + earlier, "row": found[end]})

    last, first = ("low", "high") if back else ("high", "low")
    onward, behind = boundary(last, back) if more else None, boundary(first, not back) if token else None
    return KeysetPage(taken, named, *((behind, onward) if back else (onward, behind)))


def _cut(df: DataFrame, order: Sequence[Column], skip: int, size: int) -> tuple[DataFrame, bool]:
    """``size`` rows in ``order`` behind the first ``skip``, stored, and whether there are more.

    Near the start this is a top-k per task, as in ``page``; many rows would meet in one task that way, so they are cut out of the globally numbered rows.
    """
    if skip + size < SHALLOW_PAGE:
        taken = settle(df.orderBy(*order).offset(skip).limit(size + 1), "page")
        if taken.count() <= size:
            return taken, False
        page = settle(taken.orderBy(*order).limit(size), "page")
        release(taken)
        return page, True
    placed = number_rows(df, order, "__row")
    rows = placed.where((F.col("__row") >= skip) & (F.col("__row") <= skip + size))
    page, seen = observed(rows.where(F.col("__row") < skip + size).drop("__row"), F.count(F.lit(1)).alias("rows"))
    page = settle(page, "page")
    more = seen.get["rows"] == size and not rows.where(F.col("__row") == skip + size).isEmpty()
    release(placed)
    return page, more


def _from_boundary(named: Sequence[str], row: Column, back: bool) -> Column:
    """Rows at or behind the boundary row, in the order of the columns."""
    out = F.lit(True)
    for c in reversed(named):
        value, bound = F.col(f"`{c}`"), row.getField(c)
        if back:
            beyond = F.coalesce(value < bound, value.isNull() & bound.isNotNull())
        else:
            beyond = F.coalesce(value > bound, value.isNotNull() & bound.isNull())
        out = beyond | (value.eqNullSafe(bound) & out)
    first, bound = F.col(f"`{named[0]}`"), row.getField(named[0])
    # Said once more for the scan, which understands a comparison with one value.
    return out & (bound.isNull() | (first >= bound)) if not back else out


def page_envelope(df: DataFrame, size: int, offset: int = 0) -> DataFrame:
    """One row describing a page: its rows, the total and whether there are pages around it."""
    total = F.col("total")
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(size).cast("bigint").alias("pagesize"),
        F.greatest(F.least(F.lit(size), total - offset), F.lit(0)).cast("bigint").alias("size"),
        total,
        F.lit(offset).cast("bigint").alias("pageoffset"),
        (total > size + offset).alias("has_next"),
        F.lit(offset > 0).alias("has_previous"),
    )
