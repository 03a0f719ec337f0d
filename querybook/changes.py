"""Row changes by key.

Roles on ``orders``: the target holds the orders up to 1999; the updates are the orders placed later and
all pending ones, which they mark as finished; the deletes name the orders of the lowest priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook.registry import query, read
from tidemark.operators.change import delete_by_key, matched_rows, merge_delete, pk_violations, upsert

YEAR_2000 = "TIMESTAMP_NTZ '2000-01-01 00:00:00'"
KEY = ["o_orderkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]

ROLES_SQL = """
t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
u AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'),
d AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW')
"""


def target(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").where(f"o_orderdate < {YEAR_2000}")


def updates(spark: SparkSession, sf: str) -> DataFrame:
    changed = read(spark, sf, "orders").where(f"o_orderstatus = 'P' or o_orderdate >= {YEAR_2000}")
    return changed.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))


def deletes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").where("o_orderpriority = '5-LOW'").select("o_orderkey")


UPSERTED_SQL = f"""WITH {ROLES_SQL}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM u"""


@query("matched_rows", f"WITH {ROLES_SQL} SELECT * FROM t WHERE EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey)")
def _matched(spark, sf):
    return matched_rows(target(spark, sf), updates(spark, sf), KEY)


@query("delete_by_key", f"WITH {ROLES_SQL} SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)")
def _delete(spark, sf):
    return delete_by_key(target(spark, sf), deletes(spark, sf), KEY)


@query("merge_delete", f"WITH {ROLES_SQL} SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)")
def _merge_delete(spark, sf):
    """Keys that come as text, twice, and with NULL and texts that are no key among them."""
    keys = deletes(spark, sf).select(F.col("o_orderkey").cast("string").alias("o_orderkey"))
    odd = keys.select(F.when(F.col("o_orderkey").endswith("1"), F.concat(F.lit("x"), "o_orderkey")).alias("o_orderkey"))
    return merge_delete(target(spark, sf), keys.unionByName(keys).unionByName(odd), KEY)


@query("delete_by_composite_key", """
SELECT * FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)""")
def _delete_composite(spark, sf):
    lines = read(spark, sf, "lineitem")
    return delete_by_key(lines, lines.where("l_returnflag = 'R'").select(*LINE_KEY), LINE_KEY)


@query("delete_by_concat_key", """
SELECT * FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT l_partkey::VARCHAR || l_suppkey::VARCHAR AS k FROM lineitem WHERE l_returnflag = 'R') r
  WHERE r.k = l.l_partkey::VARCHAR || l.l_suppkey::VARCHAR)""")
def _delete_concat(spark, sf):
    lines = read(spark, sf, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    return delete_by_key(lines, lines.where("l_returnflag = 'R'").select(*keys), keys, key_match="concat")


@query("upsert_delete_insert", UPSERTED_SQL)
def _upsert(spark, sf):
    return upsert(target(spark, sf), updates(spark, sf), KEY)


@query("upsert_keep_duplicates", f"{UPSERTED_SQL} UNION ALL SELECT * FROM u")
def _upsert_duplicates(spark, sf):
    twice = updates(spark, sf).unionByName(updates(spark, sf))
    return upsert(target(spark, sf), twice, KEY, distinct=False)


@query("distinct_rows", f"""WITH {ROLES_SQL}, w AS (SELECT * FROM u UNION ALL SELECT * FROM u)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey) UNION ALL SELECT DISTINCT * FROM w""")
def _distinct(spark, sf):
    twice = updates(spark, sf).unionByName(updates(spark, sf))
    return upsert(target(spark, sf), twice, KEY, distinct=True)


@query("upsert_merge", f"""WITH {ROLES_SQL}
SELECT coalesce(u.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey""")
def _merge(spark, sf):
    return upsert(target(spark, sf), updates(spark, sf), KEY, mode="merge")


@query("upsert_composite", """
WITH t AS (SELECT * FROM lineitem WHERE l_linestatus = 'F'), u AS (SELECT * FROM lineitem WHERE l_linestatus <> 'F')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.l_orderkey = t.l_orderkey AND u.l_linenumber = t.l_linenumber)
UNION ALL SELECT DISTINCT * FROM u""")
def _upsert_composite(spark, sf):
    lines = read(spark, sf, "lineitem")
    return upsert(lines.where("l_linestatus = 'F'"), lines.where("l_linestatus <> 'F'"), LINE_KEY)


@query("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _pk(spark, sf):
    return pk_violations(read(spark, sf, "lineitem"), LINE_KEY)
