"""Names, manifests, dictionaries and schema evolution.

Large manifests and dictionaries are derived from the given tables: every conversation is taken as an
extract whose turns are its columns, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.registry import query, read, scratch_path
from tidemark.functions import names
from tidemark.operators import dictionary as d
from tidemark.operators.evolve import change_plan, describe_table, schema_diff
from tidemark.operators.nest import rows_to_structs
from tidemark.plans.loads import reconcile
from tidemark.plans.target import Target
from tidemark.sources import listing

DICT_SQL = """
dict AS (SELECT 'Object.conv' || conv_id AS extract, 'conv' || conv_id AS table_name,
                CASE WHEN turn = 0 THEN 'id' ELSE 'turn_' || turn END AS column_name,
                CASE WHEN turn = 0 THEN 'String' WHEN role = 'user' THEN 'Number' WHEN length(text) > 1000 THEN 'DateTime'
                     WHEN length(text) > 500 THEN 'LongText' ELSE 'Boolean' END AS type,
                conv_id, turn, role, length(text) AS size
         FROM conversations)
"""
# Spark type of a dictionary type, as in the type map
KIND_SQL = """CASE WHEN {t} = 'Number' THEN 'double' WHEN {t} = 'Boolean' THEN 'boolean'
                   WHEN {t} = 'DateTime' THEN 'timestamp' ELSE 'string' END"""


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    size = F.length("text")
    kind = (
        F.when(F.col("turn") == 0, "String").when(F.col("role") == "user", "Number").when(size > 1000, "DateTime")
        .when(size > 500, "LongText").otherwise("Boolean")
    )
    return read(spark, sf, "conversations").select(
        F.concat(F.lit("Object.conv"), F.col("conv_id").cast("string")).alias("extract"),
        F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("table_name"),
        F.when(F.col("turn") == 0, "id").otherwise(F.concat(F.lit("turn_"), F.col("turn").cast("string"))).alias("column_name"),
        kind.alias("type"), "conv_id", "turn", "role", size.alias("size"),
    )


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """What is in place before: all columns with a longer text, loaded as text or long."""
    rows = dictionary(spark, sf).where("size > 150")
    return rows.select("table_name", "column_name", F.when(F.col("role") == "user", "string").otherwise("bigint").alias("type"))


OLD_SQL = """old AS (SELECT table_name, column_name, CASE WHEN role = 'user' THEN 'string' ELSE 'bigint' END AS old_type FROM dict WHERE size > 150)"""


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary(spark, sf).where("size < 1200").select("table_name", "column_name", "type")


NEW_SQL = f"""new AS (SELECT table_name, column_name, {KIND_SQL.format(t='type')} AS new_type FROM dict WHERE size < 1200)"""


@query("schema_from_metadata", f"""WITH {DICT_SQL}
SELECT table_name, column_name, CASE WHEN role = 'system' OR size > 1200 THEN 'string' ELSE {KIND_SQL.format(t='type')} END AS spark_type,
       NOT (role = 'system' OR size > 1200) AS in_dictionary FROM dict""")
def _schema(spark, sf):
    rows = dictionary(spark, sf)
    known = rows.where("not (role = 'system' or size > 1200)")
    return d.file_column_types(rows.select("table_name", "column_name"), known.select("extract", "column_name", "type"))


MANIFEST_SQL = """
manifest AS (SELECT CASE WHEN event_type = 'view' THEN 'Metadata.metadata' ELSE 'Log.' || event_type END AS extract,
                    strftime(ts, '%Y-%m-%d') AS day,
                    CASE WHEN event_type = 'error' THEN 'deletes' ELSE 'updates' END AS type,
                    count(*) FILTER (WHERE value > 30) AS records
             FROM events GROUP BY ALL)
"""


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    grouped = read(spark, sf, "events").groupBy(
        F.when(kind == "view", "Metadata.metadata").otherwise(F.concat(F.lit("Log."), kind)).alias("extract"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(kind == "error", "deletes").otherwise("updates").alias("type"),
    )
    counted = grouped.agg(F.count(F.when(F.col("value") > 30, 1)).alias("records"))
    return counted.withColumn("file", F.concat(F.replace("extract", F.lit("."), F.lit("/")), F.lit("/"), F.col("day"), F.lit(".csv")))


@query("manifest_select", f"""WITH {MANIFEST_SQL}
SELECT 'load' AS use, extract, day, split_part(extract, '.', 2) AS table_name, records FROM manifest
WHERE type = 'updates' AND records > 0 AND extract <> 'Metadata.metadata'
UNION ALL SELECT 'delete', extract, day, split_part(extract, '.', 2), records FROM manifest WHERE type = 'deletes' AND records > 0
UNION ALL SELECT 'dictionary', extract, day, 'metadata', records FROM manifest
WHERE type = 'updates' AND records > 0 AND extract = 'Metadata.metadata'""")
def _manifest(spark, sf):
    rows = manifest(spark, sf)

    def shown(part, use):
        return part.select(F.lit(use).alias("use"), "extract", "day", "table_name", "records")

    loads = listing.manifest_tables(rows, "updates", "incremental")
    gone = listing.manifest_tables(rows, "deletes", "incremental")
    meta = listing.metadata_changes(rows, "updates").withColumn("table_name", names.extract_table("extract"))
    return shown(loads, "load").unionByName(shown(gone, "delete")).unionByName(shown(meta, "dictionary"))


@query("extract_paths", """
SELECT 'n_' || doc_id AS table_name, 'store/run/' || source || '/' || doc_id || '.parquet' AS path FROM documents""")
def _paths(spark, sf):
    doc = F.col("doc_id").cast("string")
    rows = read(spark, sf, "documents").select(
        F.concat_ws(".", "source", doc).alias("extract"), F.concat(F.concat_ws("/", "source", doc), F.lit(".csv")).alias("file")
    )
    return listing.extract_paths(rows, "store/run", parquet=True)


@query("latest_extract_pick", """
WITH l AS (SELECT 'day-' || strftime(ts, '%Y-%m-%d') AS name, strftime(ts, '%Y-%m-%dT00:00Z') AS start_time,
                  strftime(ts, '%Y-%m-%dT23:59Z') AS stop_time, count(*) AS record_count FROM events GROUP BY ALL)
SELECT name, start_time, stop_time, record_count FROM l
WHERE start_time >= '2024-01-05T00:00Z' AND stop_time <= '2024-01-20T23:59Z' ORDER BY stop_time DESC, name DESC LIMIT 1""")
def _latest(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = read(spark, sf, "events").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("record_count"))
    extracts = rows.select(
        F.concat(F.lit("day-"), "day").alias("name"), F.lit("incremental").alias("extract_type"),
        F.concat("day", F.lit("T00:00Z")).alias("start_time"), F.concat("day", F.lit("T23:59Z")).alias("stop_time"), "record_count",
    )
    return listing.pick_latest(extracts, "incremental", "2024-01-05T00:00Z", "2024-01-20T23:59Z").drop("extract_type")


@query("normalize_names", """
SELECT p_partkey, CASE WHEN regexp_full_match(k, '[0-9]+') THEN 'n_' || k ELSE k END AS table_name, lower(p_brand) AS column_name
FROM (SELECT *, CASE WHEN p_size > 25 THEN p_partkey::VARCHAR ELSE p_name END AS k FROM part)""")
def _names(spark, sf):
    part = read(spark, sf, "part")
    key = F.when(F.col("p_size") > 25, F.col("p_partkey").cast("string")).otherwise(F.col("p_name"))
    return part.select("p_partkey", names.safe_table_name(key).alias("table_name"), F.lower("p_brand").alias("column_name"))


@query("extract_name_parse", """
SELECT p_partkey, 'Object.' || lower(p_type) || '__c' || CASE WHEN p_size > 25 THEN '_deletes' ELSE '' END AS extract,
       'Object' AS domain, lower(p_type) || '__c' AS table_name, p_size > 25 AS is_delete,
       'Object/' || lower(p_type) || '__c' || CASE WHEN p_size > 25 THEN '_deletes' ELSE '' END || '.parquet' AS parquet_path FROM part""")
def _extract_names(spark, sf):
    file = F.concat(F.lit("Object/"), F.lower("p_type"), F.lit("__c"), F.when(F.col("p_size") > 25, "_deletes").otherwise(""), F.lit(".csv"))
    rows = read(spark, sf, "part").select("p_partkey", file.alias("file")).withColumn("extract", names.extract_of_file("file"))
    return rows.select(
        "p_partkey", "extract", names.extract_domain("extract").alias("domain"), names.extract_table("extract").alias("table_name"),
        F.endswith(F.col("extract"), F.lit("_deletes")).alias("is_delete"), names.parquet_file("file").alias("parquet_path"),
    )


@query("distinct_extracts", f"WITH {DICT_SQL} SELECT extract, min(conv_id * 1000 + turn) AS first_row FROM dict GROUP BY extract")
def _extracts(spark, sf):
    rows = dictionary(spark, sf).withColumn("row_no", F.col("conv_id") * 1000 + F.col("turn"))
    return d.distinct_extracts(rows, "row_no")


@query("columns_per_extract", f"""WITH {DICT_SQL}, p AS (
SELECT extract, column_name, turn, (row_number() OVER (PARTITION BY extract ORDER BY turn) - 1) // 4 AS page FROM dict)
SELECT extract, page, string_agg(column_name, ',' ORDER BY turn) AS columns FROM p GROUP BY extract, page""")
def _columns(spark, sf):
    lists = d.columns_per_extract(dictionary(spark, sf), "turn", size=4)
    return lists.select("extract", "page", F.array_join("columns", ",").alias("columns"))


@query("rows_to_structs", """
WITH p AS (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 50 AS page FROM customer)
SELECT c_nationkey, page, count(*) AS n_rows, string_agg(c_custkey || ':' || c_mktsegment, ',' ORDER BY c_custkey) AS objects
FROM p GROUP BY c_nationkey, page""")
def _structs(spark, sf):
    pages = rows_to_structs(read(spark, sf, "customer"), ["c_nationkey"], ["c_custkey"], "objects", 50)
    text = F.transform("objects", lambda x: F.concat_ws(":", x["c_custkey"].cast("string"), x["c_mktsegment"]))
    return pages.select("c_nationkey", "page", F.size("objects").cast("bigint").alias("n_rows"), F.array_join(text, ",").alias("objects"))


@query("load_reconcile", """
WITH declared AS (SELECT o_orderpriority AS table_name, count(*) AS declared FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY ALL),
     loaded AS (SELECT o_orderpriority AS table_name, count(*) AS loaded FROM orders
                WHERE o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P') GROUP BY ALL)
SELECT coalesce(d.table_name, l.table_name) AS table_name, declared, loaded,
       CASE WHEN loaded IS NULL THEN 'not loaded' WHEN declared IS NULL THEN 'not declared'
            WHEN declared = loaded THEN 'ok' ELSE 'count differs' END AS status
FROM declared d FULL JOIN loaded l ON d.table_name = l.table_name""")
def _reconcile(spark, sf):
    orders = read(spark, sf, "orders").withColumnRenamed("o_orderpriority", "table_name")
    declared = orders.where("table_name <> '1-URGENT'").groupBy("table_name").agg(F.count(F.lit(1)).alias("records"))
    kept = orders.where("table_name <> '5-LOW' and not (table_name = '2-HIGH' and o_orderstatus = 'P')")
    return reconcile(declared, kept.groupBy("table_name").agg(F.count(F.lit(1)).alias("loaded")))


DIFF_SQL = """
diff AS (SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.column_name, n.column_name) AS column_name, old_type, new_type,
                CASE WHEN old_type IS NULL THEN 'add' WHEN new_type IS NULL THEN 'keep'
                     WHEN new_type <> old_type AND new_type <> 'string' AND NOT (new_type = 'double' AND old_type = 'bigint') THEN 'modify'
                     ELSE 'keep' END AS action
         FROM {old} o FULL JOIN {new} n ON o.table_name = n.table_name AND o.column_name = n.column_name)
"""


@query("schema_diff", f"WITH {DICT_SQL}, {OLD_SQL}, {NEW_SQL}, {DIFF_SQL.format(old='old', new='new')} SELECT * FROM diff")
def _diff(spark, sf):
    return schema_diff(catalogue(spark, sf), incoming(spark, sf))


@query("metadata_change_plan", f"""WITH {DICT_SQL}, {OLD_SQL}, {NEW_SQL},
gone AS (SELECT table_name, column_name FROM dict WHERE size BETWEEN 160 AND 260),
whole AS (SELECT table_name FROM gone WHERE column_name = 'id'),
columns AS (SELECT * FROM gone WHERE table_name NOT IN (SELECT table_name FROM whole)),
left_over AS (SELECT * FROM old WHERE table_name NOT IN (SELECT table_name FROM whole)
              AND NOT EXISTS (SELECT 1 FROM columns c WHERE c.table_name = old.table_name AND c.column_name = old.column_name)),
tables AS (SELECT DISTINCT table_name FROM old WHERE table_name NOT IN (SELECT table_name FROM whole)),
altered AS (SELECT * FROM new WHERE table_name IN (SELECT table_name FROM tables)),
{DIFF_SQL.format(old='left_over', new='altered')}
SELECT 1 AS step, table_name, 'drop_table' AS action, NULL::VARCHAR AS column_name, NULL::VARCHAR AS type FROM whole
UNION ALL SELECT 1, table_name, 'drop_column', column_name, NULL FROM columns
UNION ALL SELECT 2, table_name, 'create_table', column_name, new_type FROM new WHERE table_name NOT IN (SELECT table_name FROM tables)
UNION ALL SELECT 2, table_name, CASE action WHEN 'add' THEN 'add_column' ELSE 'change_type' END, column_name, new_type FROM diff WHERE action <> 'keep'""")
def _plan(spark, sf):
    gone = dictionary(spark, sf).where("size between 160 and 260").select("table_name", "column_name")
    return change_plan(incoming(spark, sf), gone, catalogue(spark, sf))


@query("describe_table", """
SELECT 1 AS ordinal, 'p_partkey' AS column_name, 'bigint' AS type, count(p_partkey) AS n_values, NULL::BIGINT AS length FROM part
UNION ALL SELECT 2, 'p_name', 'string', count(p_name), max(length(p_name)) FROM part
UNION ALL SELECT 3, 'p_brand', 'string', count(p_brand), max(length(p_brand)) FROM part
UNION ALL SELECT 4, 'p_type', 'string', count(p_type), max(length(p_type)) FROM part
UNION ALL SELECT 5, 'p_size', 'int', count(p_size), NULL FROM part
UNION ALL SELECT 6, 'p_retailprice', 'double', count(p_retailprice), NULL FROM part""")
def _describe(spark, sf):
    return describe_table(read(spark, sf, "part"))


def _declared(spark, sf, table, key, factor):
    """Dictionary rows of a table whose texts are declared ``factor`` times as long as their longest value."""
    from querybook.registry import dictionary_rows

    df = read(spark, sf, table).withColumnRenamed(key, "id")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.max(F.length(c)).alias(c) for c in texts]).first().asDict()
    return df, [(*r[:6], factor * longest[r[3]] if r[3] in longest else None, r[7]) for r in dictionary_rows(df, f"Object.{table}")]


@query("declared_lengths", """
SELECT 'customer' AS table_name, ordinal, column_name, type, length FROM (
  SELECT 1 AS ordinal, 'id' AS column_name, 'bigint' AS type, NULL::BIGINT AS length
  UNION ALL SELECT 2, 'c_name', 'string', 2 * max(length(c_name)) FROM customer
  UNION ALL SELECT 3, 'c_nationkey', 'double', NULL
  UNION ALL SELECT 4, 'c_mktsegment', 'string', 2 * max(length(c_mktsegment)) FROM customer
  UNION ALL SELECT 5, 'p_type', 'string', 3 * max(length(p_type)) FROM part)""")
def _lengths(spark, sf):
    """Lengths follow a table from the dictionary through changes of its columns: one goes, one comes from another table's dictionary."""
    from querybook.registry import DICTIONARY_DDL
    from tidemark.plans.loads import apply_plan, create_tables

    _, rows = _declared(spark, sf, "customer", "c_custkey", 2)
    _, others = _declared(spark, sf, "part", "p_partkey", 3)
    target = Target(spark, scratch_path(spark, "lengths"))
    create_tables(spark, target, spark.createDataFrame(rows, DICTIONARY_DDL))
    added = next(r for r in others if r[3] == "p_type")
    steps = [{"step": 2, "table_name": "customer", "action": "add_column", "column_name": added[3], "type": "string"},
             {"step": 1, "table_name": "customer", "action": "drop_column", "column_name": "c_acctbal", "type": None}]
    apply_plan(target, steps, lengths={"customer": {added[3]: added[6]}})
    return target.describe(["customer"])


@query("catalog_tables_quoted", """
SELECT 'p name' AS column_name, 'varchar(' || max(length(p_name)) || ')' AS type, count(p_name) AS n_values, max(p_name) AS last FROM part
UNION ALL SELECT 'select', 'varchar(' || max(length(p_brand)) || ')', count(p_brand), max(p_brand) FROM part
UNION ALL SELECT 'p`type', 'varchar(' || max(length(p_type)) || ')', count(p_type), max(p_type) FROM part
UNION ALL SELECT '1st.size', 'int', count(p_size), max(p_size)::VARCHAR FROM part""")
def _quoted(spark, sf):
    """Rows through a catalogue table whose names need quotes: words of the language, digits first, blanks, dots, quotes themselves."""
    from tidemark.functions.names import quote_name
    from tidemark.operators.dictionary import declare_lengths
    from tidemark.operators.evolve import catalog_types, create_catalog_tables, drop_catalog_tables

    names = {"p name": "p_name", "select": "p_brand", "p`type": "p_type", "1st.size": "p_size"}
    _, rows = _declared(spark, sf, "part", "p_partkey", 1)
    lengths = {r[3]: r[6] for r in rows}
    part = read(spark, sf, "part").select(*[F.col(c).alias(n) for n, c in names.items()])
    database, table = "2nd_select", "order"
    drop_catalog_tables(spark, [table], database) if spark.catalog.databaseExists(database) else None
    schema = declare_lengths(part.schema, {n: lengths.get(c) for n, c in names.items()})
    create_catalog_tables(spark, {table: schema}, database, scratch_path(spark, "catalog"))
    full = f"{quote_name(database)}.{quote_name(table)}"
    part.write.insertInto(full, overwrite=True)
    found = spark.table(full)
    types = catalog_types(spark, table, database)
    values = [F.struct(F.lit(n).alias("column_name"), F.lit(types[n]).alias("type"), F.col(f"n{i}").alias("n_values"), F.col(f"m{i}").alias("last")) for i, n in enumerate(names)]
    measures = [m for i, n in enumerate(names) for m in (F.count(F.col(quote_name(n))).alias(f"n{i}"), F.max(F.col(quote_name(n))).cast("string").alias(f"m{i}"))]
    return found.agg(*measures).select(F.explode(F.array(*values)).alias("r")).select("r.*")


@query("create_all_tables", """
SELECT 'customer' AS table_name, ordinal, column_name, type, n_rows FROM
  (SELECT count(*) AS n_rows FROM customer),
  (VALUES (1, 'id', 'bigint'), (2, 'c_name', 'string'), (3, 'c_nationkey', 'double'), (4, 'c_acctbal', 'double'), (5, 'c_mktsegment', 'string')) v(ordinal, column_name, type)
UNION ALL
SELECT 'orders', ordinal, column_name, type, n_rows FROM
  (SELECT count(*) AS n_rows FROM orders),
  (VALUES (1, 'id', 'bigint'), (2, 'o_custkey', 'double'), (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp'),
          (6, 'o_orderpriority', 'string')) v(ordinal, column_name, type)""")
def _create(spark, sf):
    from querybook.registry import DICTIONARY_DDL, dictionary_rows
    from tidemark.plans.loads import create_tables

    tables = {
        "customer": read(spark, sf, "customer").withColumnRenamed("c_custkey", "id"),
        "orders": read(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"),
    }
    rows = [r for name, df in tables.items() for r in dictionary_rows(df, f"Object.{name}")]
    target = Target(spark, scratch_path(spark, "created"))
    create_tables(spark, target, spark.createDataFrame(rows, DICTIONARY_DDL))
    for name, df in tables.items():
        target.append(name, df)
    counts = [target.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name in tables]
    return target.columns(tables).join(counts[0].unionByName(counts[1]), "table_name")


def _evolved(spark, sf, table, keys, **changes):
    """Load a table, then change its columns."""
    df = read(spark, sf, table)
    target = Target(spark, scratch_path(spark, "evolved"))
    target.create(table, df.schema, keys)
    target.append(table, df)
    target.evolve(table, **changes)
    return target.read(table)


@query("evolve_add_columns", "SELECT *, NULL::VARCHAR AS c_comment, NULL::TIMESTAMP AS c_seen FROM customer")
def _add(spark, sf):
    return _evolved(spark, sf, "customer", ["c_custkey"], add={"c_comment": "string", "c_seen": "timestamp_ntz"})


@query("evolve_change_type", """
SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, NULL::BIGINT AS o_orderstatus, o_totalprice, o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders""")
def _retype(spark, sf):
    return _evolved(spark, sf, "orders", ["o_orderkey"], retype={"o_custkey": "string", "o_orderstatus": "bigint", "o_orderdate": "date"})


@query("evolve_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def _drop(spark, sf):
    return _evolved(spark, sf, "orders", ["o_orderkey"], drop=["o_orderpriority"])
