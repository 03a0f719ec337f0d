import pytest
from pyspark.sql import types as T

from tidemark.operators import dictionary as d
from tidemark.operators.evolve import (
    change_plan,
    create_catalog_tables,
    describe,
    describe_table,
    drop_catalog_tables,
    evolve,
    schema_diff,
)
from tidemark.sources.model import key_columns, spark_type

CAT = "table_name string, column_name string, type string"


def test_keys_and_types():
    assert key_columns("picklist__sys") == ["object", "object_field", "picklist_value_name"]
    assert key_columns("picklist") == ["id"]
    assert key_columns("metadata") == ["extract", "column_name"]
    names = {"String": "string", "LongText": "string", "Number": "double", "numeric": "double", "Boolean": "boolean", "Date": "date",
             "DateTime": "timestamp", "timestamp with time zone": "timestamp", "Relationship": "string", "MultiPicklist": "string", "id": "string", "?": "string"}
    assert {n: spark_type(n).simpleString() for n in names} == names
    assert spark_type("Number", "id").simpleString() == "bigint"
    assert spark_type("Date", profile="all_string").simpleString() == "string"
    with pytest.raises(ValueError):
        spark_type("Date", profile="other")


def test_number_kind_looks_at_all_rows(spark):
    # The only fraction is the very last value.
    df = spark.range(20_000).selectExpr("cast(id as string) a", "if(id = 19999, '0.5', cast(id as string)) b", "cast(null as string) c",
                                        "if(id = 3, 'x', '7.0') d", "'99999999999999999999' e")
    got = {r["column_name"]: r["inferred"] for r in d.number_kinds(df, df.columns).collect()}
    assert got == {"a": "long", "b": "double", "c": "long", "d": "long", "e": "double"}
    rows = [{"column_name": "B", "type": "number"}, {"column_name": "a", "type": "Number"}, {"column_name": "d", "type": "Boolean"}]
    schema = d.schema_from_metadata(rows, ["a", "b", "d", "z"], df.withColumnRenamed("c", "z"))
    assert schema.simpleString() == "struct<a:bigint,b:double,d:boolean,z:string>"
    with pytest.raises(ValueError):
        d.schema_from_metadata(rows, ["a"], numeric="other")


def test_extract_lists(spark, rows):
    meta = spark.createDataFrame([("O.b", "id", 0), ("O.a", "id", 1), ("O.b", "x", 2), ("O.b", "y", 3)], "extract string, column_name string, n int")
    assert rows(d.distinct_extracts(meta, "n")) == [("O.a", 1), ("O.b", 0)]
    assert rows(d.columns_per_extract(meta, "n", 2)) == [("O.a", 0, ["id"]), ("O.b", 0, ["id", "x"]), ("O.b", 1, ["y"])]


def test_diff_and_plan(spark, rows):
    old = spark.createDataFrame([("t", "id", "string"), ("t", "n", "bigint"), ("t", "s", "string"), ("t", "d", "date"), ("u", "id", "string")], CAT)
    new = spark.createDataFrame([("t", "ID", "String"), ("t", "n", "Number"), ("t", "s", "Boolean"), ("t", "d", "LongText"), ("t", "x", "Date"),
                                 ("v", "id", "String"), ("u", "id", "String")], CAT)
    got = {(r["table_name"], r["column_name"]): r["action"] for r in schema_diff(old, new).collect()}
    assert got == {("t", "id"): "keep", ("t", "n"): "keep", ("t", "s"): "modify", ("t", "d"): "keep", ("t", "x"): "add",
                   ("v", "id"): "add", ("u", "id"): "keep"}
    loose = {(r["table_name"], r["column_name"]): r["action"] for r in schema_diff(old, new, allow_to_string=True).collect()}
    assert loose[("t", "d")] == "modify"
    gone = spark.createDataFrame([("t", "N"), ("u", "id"), ("u", "other")], "table_name string, column_name string")
    plan = [tuple(r) for r in change_plan(new, gone, old).orderBy("step", "table_name", "action", "column_name").collect()]
    assert plan == [
        (1, "t", "drop_column", "n", None), (1, "u", "drop_table", None, None),
        (2, "t", "add_column", "n", "double"), (2, "t", "add_column", "x", "date"), (2, "t", "change_type", "s", "boolean"),
        (2, "u", "create_table", "id", "string"), (2, "v", "create_table", "id", "string"),
    ]


def test_evolve_rows(spark, rows):
    df = spark.createDataFrame([(1, "2.5", "x")], "id int, n string, s string")
    assert rows(evolve(df, {"c": "date"}, {"n": "double", "s": "bigint"}, ["ID"])) == [(2.5, None, None)]
    with pytest.raises(ValueError):
        evolve(df, {"n": "date"}, {"n": "double"})


def test_describe(spark):
    df = spark.createDataFrame([(1, "abc"), (None, "de")], "Id int, s string")
    assert describe(df) == [(1, "id", "int"), (2, "s", "string")]
    assert [tuple(r) for r in describe_table(df).collect()] == [(1, "id", "int", 1, None), (2, "s", "string", 2, 3)]


def test_catalog_tables(spark, tmp_path):
    schemas = {"odd `name`": T.StructType.fromDDL("id bigint, `a b` string")}
    assert create_catalog_tables(spark, {"n_12": schemas["odd `name`"]}, "tidemark_test") == ["n_12"]
    assert create_catalog_tables(spark, {"n_12": schemas["odd `name`"]}, "tidemark_test") == []
    assert spark.table("tidemark_test.n_12").columns == ["id", "a b"]
    drop_catalog_tables(spark, ["n_12", "never"], "tidemark_test")
    assert not spark.catalog.tableExists("tidemark_test.n_12")
    spark.sql("DROP DATABASE tidemark_test")


def test_declared_lengths(spark, tmp_path):
    """A length stays with its column through changes of others, goes with it, and the catalogue holds writers to it."""
    from tidemark.operators.dictionary import declare_lengths, declared_length, dictionary_columns
    from tidemark.operators.evolve import catalog_types
    from tidemark.plans.target import Target

    rows = spark.createDataFrame([("Object.t", "A", "String", "5"), ("Object.t", "b", "String", "many"), ("Object.t", "c", "String", "0")], "extract string, column_name string, type string, length string")
    assert [r.length for r in dictionary_columns(rows, with_length=True).orderBy("column_name").collect()] == [5, None, None]
    assert dictionary_columns(rows.drop("length"), with_length=True).where("length IS NULL").count() == 3
    schema = declare_lengths(T.StructType.fromDDL("id bigint, A string, b string"), {"a": 5, "id": 9, "b": None})
    assert [declared_length(f) for f in schema.fields] == [None, 5, None]
    store = Target(spark, str(tmp_path / "store"))
    store.create("t", schema, ["id"])
    store.append("t", spark.createDataFrame([(1, "x", "y")], "id bigint, A string, b string"))
    store.evolve("t", add={"d": "string"}, drop=["b"], lengths={"d": 7, "a": 1})
    assert [(r.column_name, r.length) for r in store.describe(["t"]).orderBy("ordinal").collect()] == [("id", None), ("a", 5), ("d", 7)]
    store.evolve("t", retype={"A": "bigint"})
    assert [r.length for r in store.describe(["t"]).orderBy("ordinal").collect()] == [None, None, 7]
    create_catalog_tables(spark, {"lengths_12": schema}, "tidemark_lengths", str(tmp_path / "it's"))
    assert catalog_types(spark, "lengths_12", "tidemark_lengths") == {"id": "bigint", "A": "varchar(5)", "b": "string"}
    with pytest.raises(Exception, match="length"):
        spark.sql("INSERT INTO tidemark_lengths.lengths_12 VALUES (1, 'longer than five', 'x')")
    drop_catalog_tables(spark, ["lengths_12"], "tidemark_lengths")
