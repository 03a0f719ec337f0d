import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.change import append, conform, delete_by_key, matched_rows, merge_delete, pk_violations, typed_keys, upsert

DDL = "id bigint, a string"


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], DDL)


def test_delete_keeps_null_keys(spark, target, rows):
    gone = spark.createDataFrame([(1,), (1,), (None,), (9,)], "id bigint")
    assert rows(delete_by_key(target, gone, ["id"])) == [(2, "b"), (3, "c"), (None, "n")]
    assert rows(merge_delete(target, gone, ["id"])) == rows(delete_by_key(target, gone, ["id"]))
    assert rows(matched_rows(target, gone, ["id"])) == [(1, "a")]


def test_text_keys_match_numbers(spark, target, rows):
    gone = spark.createDataFrame([("1",), ("x",), ("003",)], "id string")
    assert rows(delete_by_key(target, gone, ["id"])) == [(2, "b"), (None, "n")]
    assert typed_keys(gone, target.schema, ["id"]).schema["id"].dataType.simpleString() == "bigint"


def test_concat_keys_may_collide(spark, rows):
    target = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), ("x", "y")], "k string, l string")
    gone = spark.createDataFrame([("ab", "c"), ("a", None)], "k string, l string")
    assert rows(delete_by_key(target, gone, ["k", "l"])) == [("a", "bc"), ("a", None), ("x", "y")]
    assert rows(delete_by_key(target, gone, ["k", "l"], key_match="concat")) == [("a", None), ("x", "y")]
    with pytest.raises(ValueError):
        delete_by_key(target, gone, ["k"], key_match="other")


def test_delete_insert(spark, target, rows):
    new = spark.createDataFrame([(2, "B"), (2, "B"), (2, "BB"), (7, "g"), (None, "m")], DDL)
    assert rows(upsert(target, new, ["id"])) == [(1, "a"), (2, "B"), (2, "BB"), (3, "c"), (7, "g"), (None, "m"), (None, "n")]
    assert len(rows(upsert(target, new, ["id"], distinct=False))) == 8


def test_missing_columns_become_null(spark, target, rows):
    new = spark.createDataFrame([(2,)], "ID bigint")
    assert rows(upsert(target, new, ["id"])) == [(1, "a"), (2, None), (3, "c"), (None, "n")]


def test_merge(spark, target, rows):
    new = spark.createDataFrame([(2, None), (7, "g"), (8, "h"), (8, "i"), (None, "m")], DDL)
    want = [(1, "a"), (2, None), (3, "c"), (7, "g"), (8, "h"), (8, "i"), (None, "m"), (None, "n")]
    assert rows(upsert(target, new, ["id"], mode="merge")) == sorted(want, key=repr)


def test_merge_updates_every_matching_row(spark, rows):
    target = spark.createDataFrame([(1, "a"), (1, "b")], DDL)
    assert rows(upsert(target, spark.createDataFrame([(1, "z")], DDL), ["id"], mode="merge")) == [(1, "z"), (1, "z")]


def test_merge_fails_on_ambiguous_source(spark, target):
    new = spark.createDataFrame([(2, "x"), (2, "y")], DDL)
    with pytest.raises(Exception, match="more than once"):
        upsert(target, new, ["id"], mode="merge").collect()


def test_large_merge_takes_more_tasks(spark, rows, monkeypatch):
    """As many as its rows need; null keys, repeated target rows and new rows that come twice among them."""
    from tidemark.operators import change

    target = spark.createDataFrame([(i % 90 if i % 10 else None, f"t{i}") for i in range(200)], "id int, v string")
    updates = spark.createDataFrame([(i, f"u{i}") for i in range(60, 120)] + [(200, "a"), (200, "b"), (None, "n")], "id int, v string")
    plain = rows(upsert(target, updates, ["id"], mode="merge"))
    monkeypatch.setattr(change, "ROWS_A_TASK", 20)
    dealt = upsert(target, updates, ["id"], mode="merge")
    assert rows(dealt) == plain
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString() and dealt.rdd.getNumPartitions() >= 14
    with pytest.raises(Exception, match="more than once"):
        upsert(target, updates.unionByName(updates), ["id"], mode="merge").collect()


def test_unknown_mode(target):
    with pytest.raises(ValueError):
        upsert(target, target, ["id"], mode="other")


def test_random_changes_against_brute_force(spark, rows):
    rnd = random.Random(5)
    for _ in range(5):
        # One key holds a third of the rows on either side.
        def key():
            return (0, 0) if rnd.random() < 0.33 else (rnd.randrange(8), rnd.choice([0, 1, None]))
        old = [(*key(), rnd.randrange(100)) for _ in range(60)]
        new = [(*key(), rnd.randrange(5)) for _ in range(30)]
        ddl = "k bigint, l bigint, v bigint"
        t, u = spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl)
        keys = {r[:2] for r in new if None not in r[:2]}
        kept = [r for r in old if r[:2] not in keys]
        assert rows(delete_by_key(t, u, ["k", "l"])) == sorted(kept, key=repr)
        assert rows(upsert(t, u, ["k", "l"])) == sorted(kept + list(set(new)), key=repr)


def test_same_change_twice_is_once(spark, target, rows):
    new = spark.createDataFrame([(2, "B"), (7, "g")], DDL)
    once = upsert(target, new, ["id"])
    assert rows(upsert(once, new, ["id"])) == rows(once)
    assert rows(upsert(target, new, ["id"], mode="merge")) == rows(once)


def test_conform(spark, target, rows):
    shuffled = spark.createDataFrame([("q", "5", 1)], "A string, Id string, extra int")
    assert rows(conform(shuffled, target.schema)) == [(5, "q")]
    with pytest.raises(ValueError):
        conform(shuffled, target.schema, strict=True)
    assert rows(conform(spark.createDataFrame([("4", "d")], "c0 string, c1 string"), target.schema, match="position")) == [(4, "d")]
    with pytest.raises(ValueError):
        conform(shuffled, target.schema, match="position")
    with pytest.raises(ValueError):
        conform(shuffled, target.schema, match="other")
    assert append(target, shuffled).count() == 5


def test_pk_violations(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], DDL)
    assert rows(pk_violations(df, ["id"])) == [(1, 2), (None, 2)]


def test_small_changes_do_not_shuffle_the_target(spark, sf):
    target = spark.read.parquet(f"{sf}/orders.parquet")
    gone = target.where("o_orderpriority = '5-LOW'").select("o_orderkey")
    df = delete_by_key(target, gone, ["o_orderkey"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan
    scan = df.where(F.col("o_custkey") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_custkey,5)" in scan  # pushed below the join into the scan
