"""Whole loads: full, incremental, log and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.changes import ROLES_SQL, UPSERTED_SQL, deletes, target, updates
from querybook.registry import DICTIONARY_DDL, MANIFEST_DDL, plain_times, query, read, stored_input, write_extract
from tidemark.plans.loads import apply_incremental, load_full, load_log
from tidemark.plans.target import Target
from tidemark.session import scratch_path
from tidemark.sources.files import write_csv
from tidemark.streaming.incremental import stream_extracts, stream_table


@query("full_load", """
SELECT 'customer' AS table_name, c_custkey AS id, c_name AS name, c_acctbal AS amount, c_nationkey AS other, c_mktsegment AS label, NULL::VARCHAR AS status, NULL::TIMESTAMP AS at FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, s_nationkey, NULL, NULL, NULL FROM supplier
UNION ALL SELECT 'orders', o_orderkey, NULL, o_totalprice, o_custkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders""")
def _full(spark, sf):
    """Every column of three tables after a full load."""
    tables = {
        "customer": read(spark, sf, "customer").withColumnRenamed("c_custkey", "id"),
        "supplier": read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "id"),
        "orders": read(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"),
    }
    folder = write_extract(spark, sf, "full", "full", {f"Object.{n}": df for n, df in tables.items()})
    store = Target(spark, scratch_path(spark, "full"))
    load_full(spark, folder, store)

    def shown(table, **columns):
        wanted = {"name": "string", "amount": "double", "other": "bigint", "label": "string", "status": "string", "at": "timestamp"}
        return store.read(table).select(F.lit(table).alias("table_name"), "id", *[
            (F.col(columns[c]) if c in columns else F.lit(None)).cast(kind).alias(c) for c, kind in wanted.items()])

    rows = shown("customer", name="c_name", amount="c_acctbal", other="c_nationkey", label="c_mktsegment").unionByName(
        shown("supplier", name="s_name", amount="s_acctbal", other="s_nationkey"))
    return plain_times(rows.unionByName(shown("orders", amount="o_totalprice", other="o_custkey", label="o_orderpriority", status="o_orderstatus", at="o_orderdate")))


@query("incremental_load", f"""WITH {ROLES_SQL}
SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, NULL::VARCHAR AS note FROM t
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey) AND NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, lower(o_orderpriority) FROM u""")
def _incremental(spark, sf):
    store = Target(spark, scratch_path(spark, "incremental"))
    load_full(spark, write_extract(spark, sf, "base", "full", {"Object.orders": target(spark, sf).withColumnRenamed("o_orderkey", "id")}), store)
    changed = updates(spark, sf).withColumnRenamed("o_orderkey", "id").withColumn("note", F.lower("o_orderpriority"))
    gone = deletes(spark, sf).select(F.col("o_orderkey").alias("id"), F.lit("2025-01-02T00:00Z").alias("deleted_date"))
    new_column = [("2025-01-02T00:00:00.000Z", "Object.orders", "orders", "note", "Note", "String", 100, None)]
    apply_incremental(spark, write_extract(spark, sf, "incremental", "incremental", {"Object.orders": changed}, {"Object.orders_deletes": gone}, new_column), store)
    return plain_times(store.read("orders"))


@query("log_load", "SELECT event_id AS id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props FROM events")
def _log(spark, sf):
    events = read(spark, sf, "events").withColumnRenamed("event_id", "id")
    store = Target(spark, scratch_path(spark, "log"))
    for half in ("event_type in ('click', 'view')", "event_type not in ('click', 'view')"):
        load_log(spark, write_extract(spark, sf, f"log-{half}", "log", {"Log.events": events.where(half)}), store)
    return plain_times(store.read("events"))


@query("stream_incremental_apply", UPSERTED_SQL)
def _stream(spark, sf):
    rows = target(spark, sf)
    store = Target(spark, scratch_path(spark, "stream"))
    store.create("orders", rows.schema, ["o_orderkey"])
    store.append("orders", rows)
    # Extracts by priority land one after the other; a first, outdated one is overtaken by them.
    def land() -> str:
        path = scratch_path(spark, "landing")
        changed = updates(spark, sf)
        changed.withColumn("o_orderstatus", F.lit("?")).withColumn("stop_time", F.lit("0")).write.mode("append").parquet(path)
        changed.withColumn("stop_time", F.col("o_orderpriority")).write.mode("append").parquet(path)
        return path

    landing = stored_input(spark, sf, "landing", land)
    schema = T.StructType(rows.schema.fields + [T.StructField("stop_time", T.StringType())])
    job = stream_table(spark, landing, schema, store, "orders", ["o_orderkey"], scratch_path(spark, "checkpoint"), "stop_time", files_per_batch=1)
    job.awaitTermination()
    return store.read("orders")


@query("number_widened_incremental", f"""WITH {ROLES_SQL}
SELECT o_orderkey AS id, floor(o_totalprice)::DOUBLE AS amount FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey)
UNION ALL SELECT o_orderkey, o_totalprice FROM u""")
def _number_incremental(spark, sf):
    """Whole amounts in the first extract, fractions in the next one: the column is widened, nothing becomes NULL."""
    store = Target(spark, scratch_path(spark, "widened"))
    whole = target(spark, sf).select(F.col("o_orderkey").alias("id"), F.floor("o_totalprice").cast("bigint").alias("amount"))
    load_full(spark, write_extract(spark, sf, "widened-1", "full", {"Object.orders": whole}), store)
    changed = updates(spark, sf).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    report = apply_incremental(spark, write_extract(spark, sf, "widened-2", "incremental", {"Object.orders": changed}), store)
    if report.where("status <> 'ok'").count():
        raise AssertionError("a value was lost")
    return store.read("orders")


@query("number_widened_log", """
SELECT event_id AS id, CASE WHEN event_type IN ('click', 'view') THEN floor(value) ELSE value END AS value FROM events""")
def _number_log(spark, sf):
    events = read(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "value")
    store = Target(spark, scratch_path(spark, "widened-log"))
    first = F.col("event_type").isin("click", "view")
    load_log(spark, write_extract(spark, sf, "widened-log-1", "log", {"Log.events": events.where(first).select("id", F.floor("value").cast("bigint").alias("value"))}), store)
    load_log(spark, write_extract(spark, sf, "widened-log-2", "log", {"Log.events": events.where(~first).select("id", "value")}), store)
    return store.read("events")


@query("dictionary_files_applied", """
SELECT 'customer' AS table_name, 'id' AS column_name, 'bigint' AS type, count(c_custkey) AS n_values FROM customer
UNION ALL SELECT 'customer', 'c_name', 'string', count(c_name) FROM customer
UNION ALL SELECT 'customer', 'c_acctbal', 'double', count(c_acctbal) FROM customer
UNION ALL SELECT 'customer', 'c_mktsegment', 'string', count(c_mktsegment) FROM customer
UNION ALL SELECT 'customer', 'note', 'string', 0
UNION ALL SELECT 'customer', 'since', 'date', 0
UNION ALL SELECT 'part', 'id', 'bigint', count(*) FROM part
UNION ALL SELECT 'part', 'p_size', 'double', count(TRY_CAST(p_name AS DOUBLE)) FROM part
UNION ALL SELECT 'made', 'id', 'string', 0
UNION ALL SELECT 'made', 'flag', 'boolean', 0""")
def _dictionary_files(spark, sf):
    """Two files of dictionary updates and two of deletes: create, add, change a type, drop columns and a table."""
    store = Target(spark, scratch_path(spark, "dictionary"))
    tables = {
        "customer": read(spark, sf, "customer").withColumnRenamed("c_custkey", "id"), "supplier": read(spark, sf, "supplier").withColumnRenamed("s_suppkey", "id"),
        "part": read(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("p_size"), "p_brand"),
    }
    load_full(spark, write_extract(spark, sf, "dictionary-base", "full", {f"Object.{n}": df for n, df in tables.items()}), store)

    def store_changes() -> str:
        folder = scratch_path(spark, "dictionary-changes")
        row = lambda table, column, kind: ("2025-01-02T00:00:00.000Z", f"Object.{table}", table, column, column, kind, None, None)
        changes = {
            "Metadata/one.csv": ("updates", [row("customer", "note", "String"), row("made", "id", "String")]),
            "Metadata/two.csv": ("updates", [row("customer", "since", "Date"), row("made", "flag", "Boolean"), row("part", "p_size", "Number")]),
            "Metadata/three.csv": ("deletes", [row("customer", "c_nationkey", None)]),
            "Metadata/four.csv": ("deletes", [row("supplier", "id", None), row("part", "p_brand", None)]),
        }
        for file, (_, rows) in changes.items():
            write_csv(spark.createDataFrame(rows, DICTIONARY_DDL).coalesce(1), f"{folder}/{file}")
        manifest = [("Metadata.metadata", "Metadata", change, len(rows), file) for file, (change, rows) in changes.items()]
        write_csv(spark.createDataFrame(manifest, MANIFEST_DDL).coalesce(1), f"{folder}/manifest.csv")
        return folder

    apply_incremental(spark, stored_input(spark, sf, "dictionary-changes", store_changes), store)
    shown = []
    for table in [t for t in store.tables() if t != "metadata"]:
        rows = store.read(table)
        columns = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"n{i}").alias("n_values")) for i, f in enumerate(rows.schema.fields)])
        counted = rows.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(rows.columns)])
        shown.append(counted.select(F.lit(table).alias("table_name"), F.inline(columns)))
    return reduce(DataFrame.unionByName, shown)


@query("composite_key_deletes", """
SELECT l_orderkey::VARCHAR AS object, l_linenumber::VARCHAR AS object_field, l_returnflag AS picklist_value_name, l_quantity AS quantity FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem d WHERE d.l_linestatus = 'F' AND d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber AND d.l_returnflag = l.l_returnflag)""")
def _composite_deletes(spark, sf):
    """Row deletes of the table that is keyed by three columns, as part of an incremental load."""
    lines = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("object"), F.col("l_linenumber").cast("string").alias("object_field"), F.col("l_returnflag").alias("picklist_value_name"),
        F.col("l_quantity").alias("quantity"), "l_linestatus")
    store = Target(spark, scratch_path(spark, "composite"))
    load_full(spark, write_extract(spark, sf, "composite-1", "full", {"Picklist.picklist__sys": lines.drop("l_linestatus")}), store)
    gone = lines.where("l_linestatus = 'F'").select("object", "object_field", "picklist_value_name").withColumn("deleted_date", F.lit("2025-01-02T00:00Z"))
    apply_incremental(spark, write_extract(spark, sf, "composite-2", "incremental", {}, {"Picklist.picklist__sys_deletes": gone}), store)
    return store.read("picklist__sys").select("object", "object_field", "picklist_value_name", F.col("quantity").cast("double").alias("quantity"))


@query("stream_extracts_deletes", f"""WITH {ROLES_SQL}
SELECT o_orderkey AS id, o_totalprice FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey) AND NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey)
UNION ALL SELECT o_orderkey, o_totalprice FROM u WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = u.o_orderkey)""")
def _stream_extracts(spark, sf):
    """Two whole extracts land: one with updates, one with deletes."""
    shown = lambda df: df.select(F.col("o_orderkey").alias("id"), "o_totalprice")
    store = Target(spark, scratch_path(spark, "stream-extracts"))
    rows = shown(target(spark, sf))
    store.create("orders", rows.schema, ["id"])
    store.append("orders", rows)
    landing = stored_input(spark, sf, "stream-landing", lambda: scratch_path(spark, "landing"))
    write_extract(spark, sf, "stream-1", "incremental", {"Object.orders": shown(updates(spark, sf))}, landing=landing)
    gone = deletes(spark, sf).select(F.col("o_orderkey").alias("id"), F.lit("2025-01-02T00:00Z").alias("deleted_date"))
    write_extract(spark, sf, "stream-2", "incremental", {}, {"Object.orders_deletes": gone}, landing=landing)
    stream_extracts(spark, landing, store, scratch_path(spark, "checkpoint")).awaitTermination()
    return store.read("orders")


# Applied in the order of their stop times: an older extract of amounts and deletes, then a newer one.
IN_ORDER_SQL = f"""WITH {ROLES_SQL},
older AS (SELECT o_orderkey, -o_totalprice AS o_totalprice FROM t UNION ALL SELECT o_orderkey, -o_totalprice FROM u WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = u.o_orderkey)),
one AS (SELECT * FROM older WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = older.o_orderkey))
SELECT o_orderkey AS id, o_totalprice FROM one WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = one.o_orderkey) AND o_orderkey % 5 <> 0
UNION ALL SELECT o_orderkey, o_totalprice FROM u"""


def _in_order_rows(spark, sf):
    """Rows of the older extract (updates of all orders, deletes), and of the newer one (updates of the changed orders, deletes of every fifth key)."""
    shown = lambda df, amount: df.select(F.col("o_orderkey").alias("id"), amount.alias("o_totalprice"))
    price = F.col("o_totalprice")
    everything = shown(target(spark, sf), -price).unionByName(shown(updates(spark, sf), -price)).dropDuplicates(["id"])
    gone = deletes(spark, sf).select(F.col("o_orderkey").alias("id")).distinct()
    later = shown(updates(spark, sf), price)
    fifth = everything.select("id").where("id % 5 = 0")
    return everything, gone, later, fifth


@query("stream_late_rows", IN_ORDER_SQL)
def _stream_late_rows(spark, sf):
    """Rows of a newer extract land and are applied; those of an older one land in a later run, with updates and deletes of the same keys."""
    everything, gone, later, fifth = _in_order_rows(spark, sf)
    store = Target(spark, scratch_path(spark, "late-rows"))
    store.create("orders", later.schema, ["id"])
    landing, checkpoint = scratch_path(spark, "late-landing"), scratch_path(spark, "checkpoint")
    schema = T.StructType([*later.schema.fields, T.StructField("gone", T.BooleanType()), T.StructField("stop_time", T.StringType())])
    older = everything.join(gone, "id", "left_anti")  # an update survives a delete of its own extract
    for stop, new, old in (("2025-01-02", later, fifth), ("2025-01-01", older, gone)):
        rows = new.withColumn("gone", F.lit(False)).unionByName(old.withColumns({"o_totalprice": F.lit(None).cast("double"), "gone": F.lit(True)}))
        rows.withColumn("stop_time", F.lit(stop)).write.mode("append").parquet(landing)
        stream_table(spark, landing, schema, store, "orders", ["id"], checkpoint, "stop_time", deleted="gone").awaitTermination()
    return store.read("orders")


@query("stream_late_extracts", IN_ORDER_SQL)
def _stream_late_extracts(spark, sf):
    """Whole extracts: the newer one lands first, and the folder names sort against the stop times, which the stored listing states."""
    everything, gone, later, fifth = _in_order_rows(spark, sf)
    store = Target(spark, scratch_path(spark, "late-extracts"))
    store.create("orders", later.schema, ["id"])
    deleted = lambda df: {"Object.orders_deletes": df.withColumn("deleted_date", F.lit("2025-01-02T00:00Z"))}
    older = everything.join(gone, "id", "left_anti")
    landings = [stored_input(spark, sf, f"late-landing-{i}", lambda: scratch_path(spark, "landing")) for i in range(2)]
    listing = stored_input(spark, sf, "late-listing", lambda: _late_listing(spark))
    write_extract(spark, sf, "a-newer", "incremental", {"Object.orders": later}, deleted(fifth), landing=landings[0])
    write_extract(spark, sf, "b-older", "incremental", {"Object.orders": older}, deleted(gone), landing=landings[1])
    for landing in landings:
        stream_extracts(spark, landing, store, scratch_path(spark, "checkpoint"), listing=listing).awaitTermination()
    return store.read("orders")


def _late_listing(spark) -> str:
    path = scratch_path(spark, "listing")
    rows = [("a-newer", "2025-01-02T00:00Z"), ("b-older", "2025-01-01T00:00Z")]
    spark.createDataFrame(rows, "name string, stop_time string").write.json(path)
    return path
