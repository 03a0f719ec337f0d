"""Scans, sinks, cleaning and loads by name or position."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.registry import DICTIONARY_DDL, as_csv, dictionary_rows, plain_times, query, read, stored_input
from tidemark.functions import clean as c
from tidemark.operators.change import append, conform
from tidemark.functions.clean import clean
from tidemark.operators.dictionary import number_kinds, schema_from_metadata
from tidemark.plans.extracts import latest_archive, unpack
from tidemark.plans.target import Target
from tidemark.session import scratch_path, settle
from tidemark.sources import archive, files, listing
from tidemark.sources.model import LISTING_SCHEMA


def typed_scan(spark, df, path, numeric="infer", landed=False):
    """CSV back to the types its dictionary gives; text that is landed first is parsed once."""
    raw = files.scan_csv(spark, path)
    raw = settle(raw, "landed") if landed else raw
    rows = [{"column_name": r[3], "type": r[5]} for r in dictionary_rows(df, "Object.table")]
    return clean(raw, schema_from_metadata(rows, raw.columns, raw, numeric=numeric))


@query("scan_csv_extract", "SELECT * FROM orders")
def _scan_csv(spark, sf):
    orders = read(spark, sf, "orders")
    return plain_times(typed_scan(spark, orders, as_csv(orders, sf, "orders")))


@query("scan_csv_in_splits", "SELECT * FROM documents")
def _scan_split(spark, sf):
    """About eight splits or more, so that values with line breaks cross them also where the table is small."""
    documents = read(spark, sf, "documents")
    path = as_csv(documents, sf, "documents")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    size = files.total_bytes(spark, path) // 8
    try:
        if size < files.split_bytes(spark):
            for n in names:
                spark.conf.set(n, max(size, 1 << 16))
        return typed_scan(spark, documents, path, landed=True)
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


@query("csv_odd_lines", r"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '5" ' || regexp_replace(text, '[,"\n\r]', ' ', 'g') || '" x' ELSE text END AS text FROM documents)
SELECT 'whole' AS read, doc_id, text FROM d UNION ALL SELECT 'splits', doc_id, text FROM d""")
def _odd_lines(spark, sf):
    """Stray quotes in plain values, carriage returns in quoted ones and before each header a blank line: the same records from whole files and from small splits."""

    def build() -> str:
        path = scratch_path(spark, "odd-lines")
        plain = F.concat(F.lit('5" '), F.regexp_replace("text", '[,"\n\r]', " "), F.lit('" x'))
        quoted = F.concat(F.lit('"'), F.replace(F.replace("text", F.lit('"'), F.lit('""')), F.lit("\n"), F.lit("\r\n")), F.lit('"'))
        value = F.when(F.col("doc_id") % 2 == 0, plain).otherwise(quoted)
        records = read(spark, sf, "documents").select(F.concat("doc_id", F.lit(","), value).alias("value"))

        def headed(batches):
            import pandas as pd

            yield pd.DataFrame({"value": ["", "doc_id,text"]})
            yield from batches

        records.mapInPandas(headed, "value string").write.option("lineSep", "\r\n").text(path)
        return path

    path = stored_input(spark, sf, "odd-lines", build)
    before, found = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for name, size in (("whole", "1g"), ("splits", "256k")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = files.scan_csv(spark, path).select(F.lit(name).alias("read"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            found.append(settle(rows, f"odd-{name}"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return found[0].unionByName(found[1])


@query("scan_parquet_extract", "SELECT * FROM part")
def _scan_parquet(spark, sf):
    return files.scan_parquet(spark, f"{sf}/part.parquet")


@query("header_discovery", """
SELECT 1 AS ordinal, 'o_orderkey' AS column_name, count(o_orderkey) AS n_values FROM orders
UNION ALL SELECT 2, 'o_custkey', count(o_custkey) FROM orders
UNION ALL SELECT 3, 'o_orderstatus', count(o_orderstatus) FROM orders
UNION ALL SELECT 4, 'o_totalprice', count(o_totalprice) FROM orders
UNION ALL SELECT 5, 'o_orderdate', count(o_orderdate) FROM orders
UNION ALL SELECT 6, 'o_orderpriority', count(o_orderpriority) FROM orders""")
def _headers(spark, sf):
    path = as_csv(read(spark, sf, "orders"), sf, "orders")
    names = files.headers(spark, path)
    counts = files.scan_csv(spark, path, names).agg(*[F.count(n).alias(n) for n in names])
    rows = [F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column_name"), F.col(n).alias("n_values"))
            for i, n in enumerate(names, 1)]
    return counts.select(F.inline(F.array(*rows)))


@query("infer_schema_load", "SELECT * FROM customer")
def _infer(spark, sf):
    customer = read(spark, sf, "customer")
    return conform(files.scan_inferred_csv(spark, as_csv(customer, sf, "customer")), customer.schema)


@query("infer_number_type", """
SELECT 'l_orderkey' AS column_name, CASE WHEN bool_or(l_orderkey <> floor(l_orderkey)) THEN 'double' ELSE 'long' END AS inferred FROM lineitem
UNION ALL SELECT 'l_linenumber', CASE WHEN bool_or(l_linenumber <> floor(l_linenumber)) THEN 'double' ELSE 'long' END FROM lineitem
UNION ALL SELECT 'l_quantity', CASE WHEN bool_or(l_quantity <> floor(l_quantity)) THEN 'double' ELSE 'long' END FROM lineitem
UNION ALL SELECT 'l_extendedprice', CASE WHEN bool_or(l_extendedprice <> floor(l_extendedprice)) THEN 'double' ELSE 'long' END FROM lineitem
UNION ALL SELECT 'l_discount', CASE WHEN bool_or(l_discount <> floor(l_discount)) THEN 'double' ELSE 'long' END FROM lineitem""")
def _number_type(spark, sf):
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
    text = read(spark, sf, "lineitem").select(*[F.col(n).cast("string").alias(n) for n in names])
    return number_kinds(text, names)


@query("archive_expand", "SELECT * FROM customer")
def _archive(spark, sf):
    customer = read(spark, sf, "customer")

    def pack() -> str:
        out = scratch_path(spark, "archives")
        # One archive per 64 MB of each task of the table's scan; the report has one row per archive.
        archive.pack_archives(customer, "Object/customer.csv", out).collect()
        return out

    path = stored_input(spark, sf, "archives", pack)
    records = archive.land_archives(spark, path, scratch_path(spark, "unpacked"))
    rows = archive.member_table(records, "Object/customer.csv", customer.columns)
    return clean(rows, customer.schema)


@query("csv_to_parquet", """
SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value, props FROM events""")
def _to_parquet(spark, sf):
    events = read(spark, sf, "events")
    out = scratch_path(spark, "converted")
    typed_scan(spark, events, as_csv(events, sf, "events")).write.parquet(out)
    return plain_times(files.scan_parquet(spark, out))


@query("csv_rewrite", "SELECT * FROM part")
def _rewrite(spark, sf):
    part = read(spark, sf, "part")
    out = f"{scratch_path(spark, 'rewritten')}.csv"
    files.write_csv(files.scan_csv(spark, as_csv(part, sf, "part")), out)
    return conform(files.scan_csv(spark, out), part.schema)


@query("append_load", "SELECT * FROM lineitem")
def _append(spark, sf):
    lines = read(spark, sf, "lineitem")
    target = Target(spark, scratch_path(spark, "append"))
    target.create("lineitem", lines.schema, ["l_orderkey", "l_linenumber"])
    target.append("lineitem", lines.where("l_linestatus = 'F'"))
    target.append("lineitem", lines.where("l_linestatus <> 'F'"))
    return target.read("lineitem")


@query("staging_clone", """
SELECT * FROM orders WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'""")
def _clone(spark, sf):
    orders = read(spark, sf, "orders")
    changed = orders.where("o_orderstatus = 'P' or o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    return append(orders.limit(0), changed)


@query("load_by_name", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS o_orderpriority FROM orders""")
def _by_name(spark, sf):
    orders = read(spark, sf, "orders")
    shuffled = orders.select(*[F.col(n).alias(n.upper()) for n in reversed(orders.columns) if n != "o_orderpriority"])
    return conform(shuffled, orders.schema)


@query("load_by_position", "SELECT * FROM customer")
def _by_position(spark, sf):
    customer = read(spark, sf, "customer")
    renamed = customer.toDF(*[f"c{i}" for i in range(len(customer.columns))])
    return conform(renamed, customer.schema, match="position")


@query("tolerant_load", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE left(c_mktsegment, 6) END AS c_mktsegment
FROM customer""")
def _tolerant(spark, sf):
    """Lines of customers in debt lack their last field; segments are cut to six bytes where they are longer."""
    customer = read(spark, sf, "customer")
    line = F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))

    def store() -> str:
        path = f"{scratch_path(spark, 'short')}.csv"
        lines = customer.select(line.alias(",".join(customer.columns)))
        lines.write.options(header=True, sep="\u0001", quote="").csv(path)
        return path

    typed = files.scan_tolerant(spark, stored_input(spark, sf, "short-lines", store), customer.schema, 65_535)
    return typed.withColumn("c_mktsegment", c.truncate_bytes("c_mktsegment", 6))


@query("typed_cast_select", """
SELECT event_id, CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type FROM events""")
def _typed_cast(spark, sf):
    events = read(spark, sf, "events")
    kind = F.col("event_type")
    raw = events.select(
        F.concat(F.lit(" "), F.col("event_id").cast("string")).alias("event_id"),
        F.when(kind == "signup", "").when(kind == "error", "x").otherwise(F.concat(F.lit("  "), F.col("value").cast("string"), F.lit(" "))).alias("value"),
        F.when(kind == "view", F.concat(F.col("user_id").cast("string"), F.lit(".5"))).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".0"))).alias("user_id"),
        F.when(kind == "error", "").otherwise(kind).alias("event_type"),
    )
    schema = T.StructType.fromDDL("event_id bigint, value double, user_id bigint, event_type string")
    return clean(raw, schema)


@query("boolean_parse", """
SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false WHEN 'signup' THEN true ELSE NULL END AS flag FROM events""")
def _boolean(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "click", "TRUE").when(kind == "view", " false ").when(kind == "signup", "1").when(kind == "error", "yes").otherwise("")
    return read(spark, sf, "events").select("event_id", c.parse_boolean(text).alias("flag"))


@query("timestamp_parse", """
SELECT event_id,
       CASE event_type WHEN 'click' THEN date_trunc('minute', ts) WHEN 'view' THEN date_trunc('millisecond', ts)
            WHEN 'signup' THEN date_trunc('second', ts) WHEN 'purchase' THEN date_trunc('day', ts) END AS at,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts::DATE END AS day
FROM events""")
def _timestamp(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "HH:mm"))
    )
    rows = read(spark, sf, "events").select("event_id", text.alias("text"))
    return plain_times(rows.select("event_id", c.parse_timestamp("text").alias("at"), c.parse_date("text").alias("day")))


@query("binary_parse", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE strlen(c_name) END AS n_bytes FROM customer""")
def _binary(spark, sf):
    customer = read(spark, sf, "customer")
    text = F.when(F.col("c_acctbal") < 0, F.hex("c_name")).otherwise(F.concat(F.lit("0x"), F.hex("c_name")))
    raw = c.parse_hex_binary(text)
    return customer.select("c_custkey", raw.cast("string").alias("name"), F.length(raw).cast("bigint").alias("n_bytes"))


@query("truncate_bytes", """
SELECT doc_id, left(text, list_max(list_filter(range(0, least(length(text), 64) + 1), lambda n: strlen(left(text, n)) <= 64))) AS head FROM documents""")
def _truncate(spark, sf):
    return read(spark, sf, "documents").select("doc_id", c.truncate_bytes("text", 64).alias("head"))


@query("file_part_reassemble", "SELECT doc_id, text FROM documents")
def _parts(spark, sf):
    documents = read(spark, sf, "documents")
    # Every document as numbered parts of at most 1000 characters, as an object store would hold them.
    numbers = F.sequence(F.lit(0), F.ceil(F.length("text") / 1000).cast("int") - 1)
    parts = documents.select("doc_id", F.explode(F.transform(numbers, lambda i: F.struct(
        (i + 1).alias("filepart"), F.substring(F.col("text"), i * 1000 + 1, F.lit(1000)).alias("data")))).alias("p"))
    return listing.reassemble_parts(parts.select("doc_id", "p.*"), "doc_id").withColumnRenamed("data", "text")


@query("file_parts_streamed", "SELECT doc_id, text FROM documents")
def _parts_streamed(spark, sf):
    """Every document as parts of at most 100 characters, in no order, to pieces of about 2 kB and back to whole texts."""
    documents = read(spark, sf, "documents")
    numbers = F.sequence(F.lit(0), F.ceil(F.length("text") / 100).cast("int") - 1)
    parts = documents.select("doc_id", F.posexplode(F.transform(numbers, lambda i: F.substring(F.col("text"), i * 100 + 1, F.lit(100)))).alias("at", "data"))
    pieces = listing.stored_pieces(parts.select("doc_id", (F.col("at") + 1).alias("filepart"), "data"), "doc_id", piece_bytes=2000)
    whole = pieces.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("first_part", "data"))).alias("pieces"))
    return whole.select(F.col("name").cast("bigint").alias("doc_id"), F.array_join(F.transform("pieces", lambda p: p["data"]), "").alias("text"))


@query("archives_unpacked", "SELECT * FROM customer")
def _unpack(spark, sf):
    """Several archives of one member and one of the dictionary, picked from a listing with their parts, to typed files."""
    customer = read(spark, sf, "customer")

    def pack() -> str:
        out = scratch_path(spark, "archive-set")
        # More archives as the table grows; within each task, one per 64 MB of text.
        several = 2 + files.total_bytes(spark, f"{sf.rstrip('/')}/customer.parquet") // archive.ARCHIVE_BYTES
        archive.pack_archives(customer.repartition(several, "c_custkey"), "Object/customer.csv", f"{out}/rows").collect()
        words = spark.createDataFrame(dictionary_rows(customer, "Object.customer"), DICTIONARY_DDL).coalesce(1)
        archive.pack_archives(words, "Metadata/metadata.csv", f"{out}/words").collect()
        return out

    path = stored_input(spark, sf, "archive-set", pack)
    packed = archive.archive_parts(spark, f"{path}/rows") + archive.archive_parts(spark, f"{path}/words")
    picked = []
    for name, parts in packed:
        details = [(name, part.rsplit("/", 1)[1], number, None, None) for number, part in enumerate(parts, 1)]
        listed = spark.createDataFrame([(name, name, "full_directdata", "2025-01-01", "2025-01-02", 1, 1, len(parts), details)], LISTING_SCHEMA)
        picked += latest_archive(listed, "full_directdata", parts[0].rsplit("/", 1)[0])
    made = unpack(spark, picked, scratch_path(spark, "clean")).where("member = 'Object/customer.csv'").first()
    if made["records"] != customer.count():
        raise AssertionError("records were lost")
    return conform(files.scan_parquet(spark, made["file"]), customer.schema)


@query("invalid_bytes", "SELECT doc_id, text || chr(65533) || 'x' AS text FROM documents")
def _invalid(spark, sf):
    """A byte that is no UTF-8 behind every text."""
    broken = F.concat(F.encode("text", "UTF-8"), F.lit(bytearray(b"\xffx")))
    return read(spark, sf, "documents").select("doc_id", c.replace_invalid(broken).alias("text"))
