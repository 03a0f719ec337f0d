import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.change import delete_by_key, upsert
from tidemark.plans.target import Target, bucket_count

DDL = "id bigint, a string"
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType())])


@pytest.fixture()
def store(spark, tmp_path):
    return Target(spark, str(tmp_path / "store"), buckets=4)


def fill(spark, store, n=100):
    df = spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("a"))
    assert store.create("t", SCHEMA, ["id"])
    assert store.append("t", df) == n
    return df


def test_create_append_overwrite_drop(spark, store, rows):
    df = fill(spark, store)
    assert not store.create("t", SCHEMA, ["id"])
    assert rows(store.read("t")) == rows(df)
    assert store.append("t", df.limit(5)) == 5
    assert store.read("t").count() == 105
    assert store.overwrite("t", df.limit(7)) == 7
    assert store.read("t").count() == 7
    assert store.tables() == ["t"]
    assert store.drop("t") and not store.drop("t")
    assert store.tables() == []
    with pytest.raises(LookupError):
        store.read("t")
    store.create("t", SCHEMA, ["id"])
    assert store.read("t").count() == 0


def test_change_equals_plain_upsert(spark, store, rows):
    df = fill(spark, store)
    new = spark.createDataFrame([(3, "n"), (3, "m"), (200, "x")], DDL)
    gone = spark.createDataFrame([("5",), ("3",)], "id string")
    want = rows(upsert(delete_by_key(df, gone, ["id"]), new, ["id"]))
    store.change("t", new, gone)
    assert rows(store.read("t")) == want
    store.change("t", new, gone)  # again: same
    assert rows(store.read("t")) == want


def test_change_rewrites_only_touched_buckets(spark, store):
    fill(spark, store)
    before = store.snapshot("t")
    store.change("t", spark.createDataFrame([(3, "n")], DDL))
    after = store.snapshot("t")
    changed = [b for b in after.files if after.files[b] != before.files.get(b)]
    assert len(changed) == 1 and after.files[changed[0]] == [after.version]
    store.change("t", None, spark.createDataFrame([], "id bigint"))
    assert store.snapshot("t").files == after.files


def test_merge_mode_and_concat_keys(spark, store, rows):
    fill(spark, store, 5)
    store.change("t", spark.createDataFrame([(1, "z"), (9, "y")], DDL), mode="merge")
    assert [r for r in rows(store.read("t")) if r[0] in (1, 9)] == [(1, "z"), (9, "y")]
    store.change("t", None, spark.createDataFrame([("1",)], "id string"), key_match="concat")
    assert 1 not in [r[0] for r in rows(store.read("t"))]


def test_reader_of_old_snapshot_is_not_broken(spark, store):
    fill(spark, store)
    old = store.read("t")
    store.change("t", spark.createDataFrame([(i, "new") for i in range(100)], DDL))
    assert {r["a"] for r in store.read("t").collect()} == {"new"}
    assert "new" not in {r["a"] for r in old.collect()}
    assert len(store.vacuum("t")) == 1
    assert store.read("t").count() == 100


def test_two_writers_cannot_both_commit(spark, store):
    fill(spark, store, 3)
    snap = store.snapshot("t")
    store._commit("t", type(snap)(snap.version + 1, snap.schema, snap.keys, snap.buckets, snap.files))
    with pytest.raises(Exception):
        store._commit("t", type(snap)(snap.version + 1, snap.schema, snap.keys, snap.buckets, snap.files))


def test_interrupted_write_is_ignored(spark, store, rows):
    df = fill(spark, store, 4)
    store._write("t", store.snapshot("t"), store.snapshot("t").version + 1, df.withColumn("a", F.lit("lost")))
    assert rows(store.read("t")) == rows(df)
    store.append("t", df)
    assert store.read("t").count() == 8


def test_evolve(spark, store, rows):
    fill(spark, store, 4)
    store.evolve("t", add={"b": "bigint", "a": "date"})
    assert store.read("t").columns == ["id", "a", "b"]
    store.append("t", spark.createDataFrame([(50, "x", 7)], "id bigint, a string, b bigint"))
    store.evolve("t", retype={"b": "string", "a": "string"})
    assert (50, "x", "7") in rows(store.read("t"))
    store.evolve("t", drop=["a", "nope"])
    store.evolve("t", add={"a": "string"})  # a dropped column that returns starts empty
    assert {r["a"] for r in store.read("t").collect()} == {None}
    assert store.read("t").count() == 5
    store.evolve("t", retype={"id": "string"})
    store.change("t", spark.createDataFrame([("50",)], "id string"))
    assert store.read("t").count() == 5
    store.evolve("t", drop=["id"])
    assert store.snapshot("t").keys == []
    with pytest.raises(ValueError):
        store.change("t", None, spark.createDataFrame([(1,)], "id bigint"))
    assert store.read("t").count() == 5


def test_table_without_key(spark, store):
    store.create("log", T.StructType.fromDDL("x string"), ["id"])
    store.append("log", spark.createDataFrame([("a",), ("b",)], "x string"))
    assert store.snapshot("log").buckets == 1
    assert store.read("log").count() == 2


def test_bucket_count():
    assert bucket_count(0) == 16
    assert bucket_count(100 << 40) == 100_000
    assert bucket_count(100 << 30) == 200


def test_columns(spark, store):
    fill(spark, store, 1)
    assert [tuple(r) for r in store.columns().collect()] == [("t", 1, "id", "bigint"), ("t", 2, "a", "string")]


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_few_and_many_keys_give_the_same(spark, store, rows, monkeypatch, few):
    from tidemark.plans import target as module

    monkeypatch.setattr(module, "FEW_KEYS", few)
    df = fill(spark, store)
    new = spark.createDataFrame([(i, "n") for i in range(0, 150, 2)] + [(4, "m"), (None, "z")], DDL)
    gone = spark.createDataFrame([(i,) for i in range(0, 100, 5)], "id bigint")
    store.change("t", new, gone)
    assert rows(store.read("t")) == rows(upsert(delete_by_key(df, gone, ["id"]), new, ["id"]))
    store.change("t", None, gone)
    assert {r["id"] for r in store.read("t").collect()}.isdisjoint(range(0, 100, 5))
    store.change("t")


def test_small_change_does_not_shuffle_the_target(spark, store, monkeypatch):
    fill(spark, store)
    seen = {}
    write = Target._write

    def spy(self, table, snap, version, moved=None, placed=None):
        seen["moved"], seen["placed"] = moved, placed
        return write(self, table, snap, version, moved, placed)

    monkeypatch.setattr(Target, "_write", spy)
    store.change("t", spark.createDataFrame([(3, "n")], DDL), spark.createDataFrame([(4,)], "id bigint"))
    plan = seen["placed"]._jdf.queryExecution().executedPlan().toString()
    target_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in target_side and "Exchange" not in target_side
    from tidemark.plans import target as module

    monkeypatch.setattr(module, "FEW_KEY_BYTES", 0)
    store.change("t", spark.createDataFrame([(3, "m")], DDL))
    assert seen["placed"] is None
