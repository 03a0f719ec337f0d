"""Document versions, paging, nesting and JSON records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.registry import plain_times, query, read
from tidemark.functions import names
from tidemark.operators import documents as docs
from tidemark.operators import numbering, nest
from tidemark.plans.documents import read_objects, write_contents, write_objects, write_texts
from tidemark.session import scratch_path


def versions(spark, sf):
    """Documents as versions 1.0; those in German have no file."""
    return read(spark, sf, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit("_1_0")).alias("version_id"), F.col("source").alias("name__v"),
        F.when(F.col("lang") != "de", F.col("n_chars")).alias("size__v"), "doc_id", "lang", "text",
    )


@query("doc_versions_select", """
SELECT doc_id || '_1_0' AS version_id, source AS name__v, doc_id, 1::BIGINT AS major, 0::BIGINT AS minor FROM documents WHERE lang <> 'de'""")
def _select(spark, sf):
    return docs.select_versions(versions(spark, sf))


@query("version_id_parse", "SELECT l_orderkey || '_' || l_linenumber || '_0' AS version_id, l_orderkey AS doc_id, l_linenumber::BIGINT AS major, 0::BIGINT AS minor FROM lineitem")
def _parse(spark, sf):
    rows = read(spark, sf, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.lit("0")).alias("version_id"))
    return rows.select("version_id", *[names.version_part("version_id", i).alias(n) for i, n in enumerate(("doc_id", "major", "minor"), 1)])


@query("batch_rows", """
WITH n AS (SELECT *, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 10000 AS batch FROM lineitem)
SELECT batch, count(*) AS n_rows, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key, sum(l_quantity)::BIGINT AS quantity FROM n GROUP BY batch""")
def _batches(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    batched = numbering.batch_rows(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return batched.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
    )


@query("batch_to_json", """
WITH n AS (SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS batch FROM conversations)
SELECT batch, count(*) AS n_versions,
       '[' || string_agg('{"id":"' || conv_id || '","major_version_number__v":"' || turn || '","minor_version_number__v":"0"}', ',' ORDER BY conv_id, turn) || ']' AS body
FROM n GROUP BY batch""")
def _json(spark, sf):
    rows = read(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("major"), F.lit(0).alias("minor"))
    return docs.batch_to_json(rows, 100)


@query("doc_latest_version", """
SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn = 1""")
def _latest(spark, sf):
    return docs.latest_version(read(spark, sf, "conversations"), "conv_id", ["turn"])


@query("doc_all_versions", """
WITH p AS (SELECT conv_id, turn, role, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 5 AS page FROM conversations)
SELECT conv_id, page, string_agg(turn || '-' || role, ',' ORDER BY turn) AS versions FROM p GROUP BY conv_id, page""")
def _all(spark, sf):
    pages = docs.all_versions(read(spark, sf, "conversations"), "conv_id", ["turn"], ["turn", "role"], 5)
    text = F.transform("versions", lambda v: F.concat_ws("-", v["turn"].cast("string"), v["role"]))
    return pages.select("conv_id", "page", F.array_join(text, ",").alias("versions"))


@query("doc_keyword_search", """
SELECT doc_id, 'content' AS scope FROM documents WHERE contains(lower(text), 'the')
UNION ALL SELECT doc_id, 'all' FROM documents WHERE contains(lower(text), 'src1') OR contains(lower(source), 'src1')""")
def _search(spark, sf):
    documents = read(spark, sf, "documents")
    inside = docs.keyword_search(documents, "The", "text").select("doc_id", F.lit("content").alias("scope"))
    everywhere = docs.keyword_search(documents, "SRC1", "text", ["source"]).select("doc_id", F.lit("all").alias("scope"))
    return inside.unionByName(everywhere)


@query("doc_page", "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10 OFFSET 20")
def _doc_page(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.document_page(rows, [F.col("n_chars").desc(), F.col("doc_id")], 20, 10)


@query("max_rows", "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3")
def _max(spark, sf):
    return numbering.max_rows(read(spark, sf, "customer"), [F.col("c_acctbal").desc(), F.col("c_custkey")], 3)


@query("page_rows", "SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100 OFFSET 200")
def _page(spark, sf):
    return numbering.page(read(spark, sf, "orders"), ["o_totalprice", "o_orderkey"], 100, 200)


@query("pages_by_token", """
WITH n AS (SELECT greatest(1, ceil(count(*) / 6.0)::BIGINT) AS size FROM orders),
p AS (SELECT (row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) - 1) // (SELECT size FROM n) AS page, * FROM orders)
SELECT 'next' AS way, page, o_orderkey, o_orderdate, o_orderpriority FROM p
UNION ALL SELECT 'previous', page, o_orderkey, o_orderdate, o_orderpriority FROM p WHERE page < (SELECT max(page) FROM p)""")
def _walk(spark, sf):
    """All of orders in six pages, from each to the next by its token, and all the way back."""
    orders = read(spark, sf, "orders")
    size = max(1, -(-orders.count() // 6))
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    walked, page = [], numbering.keyset_page(orders, order, size)
    for way, number in [("next", n) for n in range(6)] + [("previous", n) for n in range(4, -1, -1)]:
        if (way, number) != ("next", 0):
            token = page.next if way == "next" else page.previous
            if token is None:
                break
            page = numbering.keyset_page(orders, order, size, token)
        walked.append(page.rows.select(F.lit(way).alias("way"), F.lit(number).cast("bigint").alias("page"), "o_orderkey", "o_orderdate", "o_orderpriority"))
    return plain_times(reduce(DataFrame.unionByName, walked))


@query("page_envelope", """
SELECT 100::BIGINT AS pagesize, greatest(least(100, count(*) - 200), 0)::BIGINT AS size, count(*) AS total, 200::BIGINT AS pageoffset,
       count(*) > 300 AS has_next, true AS has_previous FROM orders""")
def _envelope(spark, sf):
    return numbering.page_envelope(read(spark, sf, "orders"), 100, 200)


NEST_SQL = """
c AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS page FROM orders),
l AS (SELECT o_custkey, page, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ks FROM c GROUP BY o_custkey, page)
"""


def _nested(spark, sf):
    customer = read(spark, sf, "customer").select("c_custkey", "c_name")
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return nest.nest(customer, orders, "c_custkey", "o_custkey", "orders__r", ["o_orderkey"], 5)


@query("nested_children", f"""WITH {NEST_SQL}
SELECT c_custkey, c_name, coalesce(page, 0) AS page, coalesce(n, 0) AS n_children, coalesce(ks, '') AS order_keys
FROM customer LEFT JOIN l ON o_custkey = c_custkey""")
def _nest(spark, sf):
    keys = F.transform("orders__r", lambda o: o["o_orderkey"].cast("string"))
    return _nested(spark, sf).select("c_custkey", "c_name", "page", F.size("orders__r").cast("bigint").alias("n_children"),
                                     F.array_join(keys, ",").alias("order_keys"))


@query("unnest_children", "SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer JOIN orders ON c_custkey = o_custkey")
def _unnest(spark, sf):
    return nest.unnest(_nested(spark, sf), "orders__r", ["c_custkey", "c_name"])


@query("json_open_record", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind, user_id::VARCHAR AS seen_by FROM events""")
def _open(spark, sf):
    events = read(spark, sf, "events")
    # Two more fields go into the object, which the record does not know.
    body = F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(', "kind": "'), F.col("event_type"), F.lit('", "seen_by": '),
                    F.col("user_id").cast("string"), F.lit("}"))
    rows = docs.open_record(events.select("event_id", body.alias("props")), "props", T.StructType.fromDDL("k bigint"))
    return rows.select("event_id", "k", F.col("rest")["kind"].alias("kind"), F.col("rest")["seen_by"].alias("seen_by"))


@query("json_open_typed", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'broken' WHEN 'signup' THEN 'other' ELSE 'object' END AS state,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END AS who_id,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS first_kind,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN 2 END AS n_rest
FROM events""")
def _open_typed(spark, sf):
    """Events as open records with nested fields that the record does not know; errors are cut off, signups are lists."""
    events = read(spark, sf, "events")
    user = F.col("user_id").cast("string")
    whole = F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(', "who": {"id": '), user, F.lit(', "seen": [1, {"x": null}]}, "kinds": ["'), F.col("event_type"), F.lit('"]}'))
    body = F.when(F.col("event_type") == "error", F.regexp_replace(whole, r"\]\}$", "")).when(F.col("event_type") == "signup", F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole)
    rows = docs.open_typed_record(events.select("event_id", body.alias("props")), "props", T.StructType.fromDDL("k bigint"))
    return rows.select("event_id", "state", "k", F.try_variant_get(F.col("rest")["who"], "$.id", "bigint").alias("who_id"),
                       F.try_variant_get(F.col("rest")["kinds"], "$[0]", "string").alias("first_kind"), F.when(F.col("rest").isNotNull(), F.size("rest")).alias("n_rest"))


@query("doc_text_sink", """
SELECT doc_id || '/1_0/' || source || '.txt' AS path, text FROM documents WHERE lang <> 'de' AND n_chars >= 40""")
def _texts(spark, sf):
    """Versions whose text is too short count as failed."""
    rows = versions(spark, sf)
    texts = read(spark, sf, "documents").select(
        "doc_id", F.lit(1).cast("bigint").alias("major"), F.lit(0).cast("bigint").alias("minor"), "text",
        F.when(F.col("n_chars") < 40, "too short").alias("error"))
    out = scratch_path(spark, "texts")
    write_texts(rows.drop("doc_id", "text"), texts, out, 500)
    return spark.read.parquet(out).select("path", "text")


@query("doc_content_sink", """
SELECT d.doc_id || '/1_0/' || d.source || ' ' || d.lang || '.txt' AS path, 'u7/out/' || d.source || '%20' || d.lang || '.txt' AS staged_at, strlen(d.text) AS n_bytes,
       d.text AS content FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE d.lang <> 'de' AND l.quality = 1""")
def _contents(spark, sf):
    """Labelled documents as exported files: a good label is a successful export."""
    documents = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id")
    name = F.concat("source", F.lit(" "), "lang", F.lit(".txt"))
    results = documents.select(
        F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILURE").alias("responseStatus"), F.col("doc_id").alias("id"),
        F.lit(1).alias("major_version_number__v"), F.lit(0).alias("minor_version_number__v"),
        F.concat(F.lit("/out//"), name).alias("file"), F.lit(7).alias("user_id__v"),
        F.concat(F.lit('attachment; filename="'), name, F.lit('"')).alias("content_disposition"), F.encode("text", "UTF-8").alias("content"),
    )
    out = scratch_path(spark, "contents")
    write_contents(versions(spark, sf).drop("doc_id", "text"), results, out, 500)
    return spark.read.parquet(out).select("path", "staged_at", F.octet_length("content").cast("bigint").alias("n_bytes"),
                                          F.decode("content", "UTF-8").alias("content"))


@query("export_result_filter", """
SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS outcome FROM labels""")
def _export(spark, sf):
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "success").when(F.col("quality") == 1, "SUCCESS").when(F.col("toxic") == 0, "FAILURE")
    rows = read(spark, sf, "labels").select("doc_id", status.alias("responseStatus"))
    good = docs.export_succeeded(rows).select("doc_id", F.lit("good").alias("outcome"))
    return good.unionByName(docs.export_failed(rows).select("doc_id", F.lit("bad").alias("outcome")))


@query("content_filename", """
SELECT page_id, CASE WHEN starts_with(url, 'https') THEN replace(replace(url, '?', 'é ?'), 'https', 'a+b') WHEN contains(url, '?') THEN replace(url, 'http', '"q"; x')
       ELSE url END AS filename FROM pages""")
def _filename(spark, sf):
    url = F.col("url")
    extended = F.replace(F.url_encode(F.replace(F.replace(url, F.lit("?"), F.lit("é ?")), F.lit("https"), F.lit("a+b"))), F.lit("+"), F.lit("%20"))
    header = (
        F.when(F.startswith(url, F.lit("https")), F.concat(F.lit("attachment; filename=\"plain.txt\"; filename*=UTF-8''"), extended))
        .when(F.contains(url, F.lit("?")), F.concat(F.lit('attachment; filename="'), F.replace(url, F.lit("http"), F.lit('\\"q\\"; x')), F.lit('"')))
        .otherwise(F.concat(F.lit("attachment;filename="), url))
    )
    return read(spark, sf, "pages").select("page_id", names.disposition_filename(header).alias("filename"))


@query("staging_path_encode", """
WITH p AS (SELECT page_id, regexp_replace(url, '^https?:/', '') || ' ~*' AS file, starts_with(url, 'https') AS sees_all FROM pages)
SELECT page_id, array_to_string(list_transform(string_split(regexp_replace(CASE WHEN sees_all THEN 'u' || page_id || file ELSE ltrim(file, '/') END, '/+', '/', 'g'), '/'),
       lambda x: url_encode(x)), '/') AS staged_at FROM p""")
def _staging(spark, sf):
    rows = read(spark, sf, "pages").select(
        "page_id", F.concat(F.regexp_replace("url", "^https?:/", ""), F.lit(" ~*")).alias("file"), F.startswith("url", F.lit("https")).alias("sees_all"))
    return rows.select("page_id", names.staging_path("file", "page_id", F.col("sees_all")).alias("staged_at"))


@query("doc_objects_written", "SELECT doc_id, text FROM documents")
def _objects(spark, sf):
    """Each document as one stored object, read back by its path."""
    out = scratch_path(spark, "objects")
    documents = read(spark, sf, "documents")
    path = F.concat(F.lit("d/"), "doc_id", F.lit(".txt")).alias("path")
    write_objects(documents.select(path, F.col("text").alias("content")), out)
    return read_objects(documents.select("doc_id", path), out).select("doc_id", F.col("content").cast("string").alias("text"))
