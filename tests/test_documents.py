import os
from urllib.parse import quote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names
from tidemark.operators import documents as docs
from tidemark.plans.documents import read_objects, write_contents, write_objects, write_texts


def value(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression("t").alias("v")).first()["v"]


@pytest.mark.parametrize("header,want", [
    ('attachment; filename="a b.pdf"', "a b.pdf"), ("attachment;filename=plain.txt", "plain.txt"), ('inline; filename="q\\"x\\".txt"', 'q"x".txt'),
    ("attachment; filename=\"f.txt\"; filename*=UTF-8''na%C3%AFve%20a+b.txt", "naïve a+b.txt"), ("attachment; filename*=iso-8859-1'en'%A3.txt", "£.txt"),
    ("attachment", None), ('attachment; FILENAME="up.txt"', "up.txt"), ('attachment; filename="a;b.txt"', "a;b.txt"), (None, None),
])
def test_disposition(spark, header, want):
    assert value(spark, header, names.disposition_filename) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab/é ~*+%.-_&?#é€", max_size=15), min_size=1, max_size=20))
def test_encode_path_against_urllib(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(names.encode_path("t")).collect()
    assert [r[0] for r in got] == [quote(t) for t in texts]


@pytest.mark.parametrize("file,sees_all,want", [("/a b//c.txt", True, "u7/a%20b/c.txt"), ("/a/./b/", False, "a/b"), ("//x", False, "x")])
def test_staging_path(spark, file, sees_all, want):
    df = spark.createDataFrame([(file, 7, sees_all)], "f string, u bigint, s boolean")
    assert df.select(names.staging_path("f", "u", F.col("s"))).first()[0] == want


@pytest.mark.parametrize("name,want", [("123", "n_123"), ("12a", "12a"), ("", ""), ("n_1", "n_1")])
def test_safe_names(spark, name, want):
    assert value(spark, name, names.safe_table_name) == want


def test_name_parts(spark):
    assert value(spark, "Object/a.b/c.csv", names.extract_of_file) == "Object.a.b.c"
    assert value(spark, "Object.77_deletes", names.extract_table) == "n_77"
    assert value(spark, "Object.x", names.extract_domain) == "Object"
    assert value(spark, "x/my.csv.csv", names.parquet_file) == "x/my.csv.parquet"
    assert value(spark, "12_3_x", lambda c: names.version_part(c, 3)) is None
    assert names.quote_name("a`b") == "`a``b`"


@pytest.fixture()
def versions(spark):
    return spark.createDataFrame([("1_0_1", "a", 5), ("2_1_0", "b", None), ("10_1_0", "c", 7)], "version_id string, name__v string, size__v bigint")


def test_text_job(spark, versions, tmp_path, rows):
    texts = spark.createDataFrame([(1, 0, 1, "one\n\"1\"", None), (10, 1, 0, "ten", "failed"), (2, 1, 0, "two", None)],
                                  "doc_id bigint, major bigint, minor bigint, text string, error string")
    write_texts(versions, texts, str(tmp_path / "t"), 1)
    out = spark.read.parquet(str(tmp_path / "t"))
    assert rows(out.select("batch", "path", "text")) == [(0, "1/0_1/a.txt", 'one\n"1"')]
    write_texts(versions, texts.drop("error"), str(tmp_path / "u"), 1)
    assert rows(spark.read.parquet(str(tmp_path / "u")).select("batch", "path")) == [(0, "1/0_1/a.txt"), (1, "10/1_0/c.txt")]


def test_content_job(spark, versions, tmp_path, rows):
    ddl = ("responseStatus string, id bigint, major_version_number__v bigint, minor_version_number__v bigint, file string, user_id__v bigint, "
           "content_disposition string, content binary")
    results = spark.createDataFrame([("success", 1, 0, 1, "/f a", 3, 'attachment; filename="r.bin"', b"\x00\xff"),
                                     ("FAILURE", 10, 1, 0, "/g", 3, "attachment", b"")], ddl)
    write_contents(versions, results, str(tmp_path / "c"))
    out = spark.read.parquet(str(tmp_path / "c"))
    assert [tuple(r) for r in out.select("path", "staged_at", "content").collect()] == [("1/0_1/r.bin", "u3/f%20a", bytearray(b"\x00\xff"))]
    for _ in range(2):
        write_objects(out, str(tmp_path / "objects"))
    assert (tmp_path / "objects/1/0_1/r.bin").read_bytes() == b"\x00\xff"
    assert sum(len(f) for _, _, f in os.walk(tmp_path / "objects")) == 1
    assert docs.export_failed(results).count() == 1


def test_open_record(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x", "c": {"d": [1]}, "e": null}',), ("no json",)], "j string")
    got = docs.open_record(df, "j", T.StructType.fromDDL("a bigint, z string")).collect()
    assert got[0]["a"] == 1 and got[0]["z"] is None and got[0]["rest"] == {"b": "x", "c": '{"d":[1]}', "e": None}
    assert got[1]["a"] is None


def test_latest_and_all(spark, rows):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (1, 0, 9), (2, 0, 1)], "doc int, major int, minor int")
    assert rows(docs.latest_version(df, "doc", ["major", "minor"])) == [(1, 1, 0), (2, 0, 1)]
    pages = docs.all_versions(df, "doc", ["major", "minor"], ["major", "minor"], 2)
    assert [(r["doc"], r["page"], [tuple(v) for v in r["versions"]]) for r in pages.orderBy("doc", "page").collect()] == [
        (1, 0, [(0, 1), (0, 9)]), (1, 1, [(1, 0)]), (2, 0, [(0, 1)])]
    plan = docs.latest_version(df, "doc", ["major"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # cut down before the shuffle as well


def test_search(spark, rows):
    df = spark.createDataFrame([("The x", "s"), (None, "the"), ("y", "z")], "t string, s string")
    assert docs.keyword_search(df, "THE", "t").count() == 1
    assert docs.keyword_search(df, "THE", "t", ["s"]).count() == 2


def test_open_typed_record(spark):
    """Nested and broken records, other JSON, odd names, values of another type."""
    import json

    from pyspark.sql import types as T

    from tidemark.operators.documents import open_typed_record

    texts = ['{"k": 1, "a b": {"x": [1, "2"]}, "n": null}', '{"k": "7", "it\'s": 1.5}', '{"k": "no"}', "{}", "[1]", "3", "null", '{"k": 1', '{"k": 1, "k": 2}', "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string").withColumn("extra", F.lit(1))
    known = T.StructType([T.StructField("k", T.LongType()), T.StructField("it's", T.DoubleType())])
    got = open_typed_record(df, "body", known).withColumn("rest", F.to_json("rest")).orderBy("i").collect()
    assert [r.state for r in got] == ["object"] * 4 + ["other"] * 3 + ["broken"] * 3 + [None]
    assert [r.k for r in got] == [1, 7] + [None] * 9
    assert got[1]["it's"] == 1.5 and got[1].extra == 1
    assert [r.rest and json.loads(r.rest) for r in got] == [{"a b": {"x": [1, "2"]}, "n": None}, {}, {}, {}] + [None] * 7
    assert open_typed_record(df, "body", T.StructType()).where("rest['k'] IS NOT NULL").count() == 3


def test_objects_are_read_by_name(spark, tmp_path, rows):
    """By as many tasks as there are cores, however many objects there are; only the named ones, and none may be missing."""
    data = [(i, f"a/{i % 3}/{i} ü.txt", f"text\n{i}") for i in range(300)]
    df = spark.createDataFrame(data, "id int, path string, content string")
    write_objects(df, str(tmp_path / "objects"))
    found = read_objects(df.where("id % 2 = 0").select("id", "path"), str(tmp_path / "objects"))
    assert rows(found.select("id", F.col("content").cast("string"))) == sorted([(i, t) for i, _, t in data if i % 2 == 0], key=repr)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    with pytest.raises(Exception, match="gone.txt"):
        read_objects(spark.createDataFrame([("a/gone.txt",)], "path string"), str(tmp_path / "objects")).collect()
