"""Schema evolution: compare dictionaries, plan the changes, apply them to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import convert_value
from tidemark.operators.dictionary import declared_length, spark_type_name

# Order of the steps of a change plan: deletes come before updates.
STEP_DELETES, STEP_UPDATES = 1, 2


def describe(df: DataFrame) -> list[tuple[int, str, str]]:
    """``(ordinal, column name in lower case, type)`` of a table, in column order."""
    return [(i, f.name.lower(), f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]


def describe_table(df: DataFrame) -> DataFrame:
    """The description as rows, with the number of values each column holds and its longest text in characters.

    One aggregation over the table; no text is moved.
    """
    stats = []
    for i, f in enumerate(df.schema.fields):
        column = F.col(f"`{f.name}`")
        length = F.max(F.length(column)) if isinstance(f.dataType, T.StringType) else F.lit(None)
        stats += [F.count(column).alias(f"n{i}"), length.cast("bigint").alias(f"l{i}")]
    rows = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(name).alias("column_name"), F.lit(kind).alias("type"),
            F.col(f"n{i - 1}").alias("n_values"), F.col(f"l{i - 1}").alias("length"),
        )
        for i, name, kind in describe(df)
    ]
    return df.agg(*stats).select(F.explode(F.array(*rows)).alias("r")).select("r.*").orderBy("ordinal")


def schema_diff(existing: DataFrame, incoming: DataFrame, allow_to_string: bool = False, number: str = "double") -> DataFrame:
    """Compare ``(table_name, column_name, type)`` of a catalogue (Spark types) and a dictionary (its own type names).

    ``add``: only in the dictionary. ``modify``: in both with another type; a change to text is left
    alone unless ``allow_to_string``. ``keep``: everything else.
    """
    old = existing.select(
        "table_name", F.lower("column_name").alias("column_name"), F.lower("type").alias("old_type")
    )
    new = incoming.select(
        "table_name", F.lower("column_name").alias("column_name"), spark_type_name(number=number).alias("new_type")
    )
    both = old.join(new, ["table_name", "column_name"], "full")
    action = (
        F.when(F.col("old_type").isNull(), "add")
        .when(F.col("new_type").isNull(), "keep")
        .when(_retyped(allow_to_string, number), "modify")
        .otherwise("keep")
    )
    return both.select("table_name", "column_name", "old_type", "new_type", action.alias("action"))


def _retyped(allow_to_string: bool, number: str) -> Column:
    """Whether a column's ``old_type`` gives way to its ``new_type``."""
    retyped = F.col("new_type") != F.col("old_type")
    if not allow_to_string:
        retyped = retyped & (F.col("new_type") != "string")
    # A Number is planned as ``number``; a column already loaded as long, double or decimal stays.
    numeric = (F.col("new_type") == number) & (F.col("old_type").isin("bigint", "double") | F.col("old_type").startswith("decimal"))
    return retyped & ~numeric


def change_plan(
    updates: DataFrame, deletes: DataFrame, existing: DataFrame, allow_to_string: bool = False, number: str = "double"
) -> DataFrame:
    """Ordered changes ``(step, table_name, action, column_name, type)`` from dictionary updates and deletes.

    Deleting a table's ``id`` drops the table, other columns are dropped one by one. Updates then
    create tables that do not exist and add or retype columns of the others. ``number`` is the type of new Number columns.
    """
    none = F.lit(None).cast("string")

    def listed(rows: DataFrame, old: Column, new: Column, gone: bool) -> DataFrame:
        return rows.select("table_name", F.lower("column_name").alias("column_name"), old.alias("old_type"), new.alias("new_type"), F.lit(gone).alias("gone"))

    # Each list is read once: one row per column says what it is, what it is to be and whether it goes; one window, over the columns of a table, what becomes of the table.
    lists = listed(existing, F.lower("type"), none, False).unionByName(listed(updates, none, spark_type_name(number=number), False)).unionByName(listed(deletes, none, none, True))
    columns = lists.groupBy("table_name", "column_name").agg(F.max("old_type").alias("had"), F.max("new_type").alias("new_type"), F.max("gone").alias("gone"))
    table = Window.partitionBy("table_name")
    dropped = F.max(F.col("gone") & (F.col("column_name") == "id")).over(table)
    rows = columns.withColumn("dropped", dropped).withColumn("exists", F.max(F.col("had").isNotNull()).over(table) & ~F.col("dropped"))
    rows = rows.withColumn("old_type", F.when(~F.col("gone"), F.col("had")))

    def step(number_: int, when: Column, action: str, column: Column = F.col("column_name"), kind: Column = none) -> Column:
        return F.when(when, F.struct(F.lit(number_).alias("step"), F.lit(action).alias("action"), column.alias("column_name"), kind.alias("type")))

    wanted, new = F.col("new_type").isNotNull(), F.col("new_type")
    steps = F.array(
        step(STEP_DELETES, F.col("gone") & (F.col("column_name") == "id"), "drop_table", none),
        step(STEP_DELETES, F.col("gone") & ~F.col("dropped"), "drop_column"),
        step(STEP_UPDATES, wanted & ~F.col("exists"), "create_table", kind=new),
        step(STEP_UPDATES, wanted & F.col("exists") & F.col("old_type").isNull(), "add_column", kind=new),
        step(STEP_UPDATES, wanted & F.col("exists") & _retyped(allow_to_string, number), "change_type", kind=new),
    )
    return rows.select("table_name", F.explode(F.array_compact(steps)).alias("s")).select("s.step", "table_name", "s.action", "s.column_name", "s.type")


def evolve(
    df: DataFrame,
    add: Mapping[str, T.DataType | str] | None = None,
    retype: Mapping[str, T.DataType | str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Rows in the changed schema: one narrow projection. New columns are NULL, values that do not convert too."""
    add = {k.lower(): _type(v) for k, v in (add or {}).items()}
    retype = {k.lower(): _type(v) for k, v in (retype or {}).items()}
    if set(add) & set(retype):
        raise ValueError("a column cannot be added and changed at once: " + ", ".join(sorted(set(add) & set(retype))))
    gone = {c.lower() for c in drop}
    columns = []
    for f in df.schema.fields:
        if f.name.lower() in gone:
            continue
        target = retype.get(f.name.lower(), f.dataType)
        columns.append(convert_value(F.col(f"`{f.name}`"), f.dataType, target).alias(f.name))
    kept = {f.name.lower() for f in df.schema.fields} - gone
    columns += [F.lit(None).cast(t).alias(c) for c, t in add.items() if c not in kept]
    return df.select(*columns)


def _type(t: T.DataType | str) -> T.DataType:
    return T.StructType.fromDDL(f"c {t}").fields[0].dataType if isinstance(t, str) else t


def create_catalog_tables(spark: SparkSession, schemas: Mapping[str, T.StructType], database: str, location: str | None = None) -> list[str]:
    """Create the database, in the warehouse or at ``location``, and each table in the session catalog when absent; returns the tables made."""
    from tidemark.functions.names import quote_name

    place = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(database)}{place}")
    made = []
    for table, schema in schemas.items():
        # A text of declared length becomes varchar, which Spark checks on every write.
        kinds = [f"varchar({declared_length(f)})" if declared_length(f) else f.dataType.simpleString() for f in schema.fields]
        name = f"{quote_name(database)}.{quote_name(table)}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"{quote_name(f.name)} {kind}" for f, kind in zip(schema.fields, kinds))
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
            made.append(table)
    return made


def catalog_types(spark: SparkSession, table: str, database: str) -> dict[str, str]:
    """Declared type of each column of a catalogue table; the schema of a read says ``string`` for every text."""
    from tidemark.functions.names import quote_name

    rows = spark.sql(f"DESCRIBE TABLE {quote_name(database)}.{quote_name(table)}").collect()  # one per column
    return {r["col_name"]: r["data_type"] for r in rows}


def drop_catalog_tables(spark: SparkSession, tables: Sequence[str], database: str) -> None:
    from tidemark.functions.names import quote_name

    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {quote_name(database)}.{quote_name(table)}")
