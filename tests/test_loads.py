import pytest
from pyspark.sql import types as T

from tidemark.plans.extracts import latest_archive, unpack
from tidemark.plans.loads import LoadOptions, apply_incremental, apply_plan, load_full, load_log
from tidemark.plans.target import Target
from tidemark.session import scratch_path, settle, release, path_exists
from tidemark.sources.model import LISTING_SCHEMA
from tidemark.streaming.incremental import stream_extracts, stream_table

DICT = "modified_date__v,extract,extract_label,column_name,column_label,type,length,related_extract\n"
MANIFEST = "extract,extract_label,type,records,file\n"


def dictionary(rows):
    return DICT + "".join(f"2025-01-01T00:00Z,{e},{e},{c},{c},{t},10,\n" for e, c, t in rows)


def manifest(rows):
    return MANIFEST + "".join(f"{e},{e},{t},{n},{f}\n" for e, t, n, f in rows)


def put(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(folder)


FULL = {
    "Metadata/metadata.csv": dictionary([
        ("Object.a__v", "id", "String"), ("Object.a__v", "Name__v", "String"), ("Object.a__v", "n__v", "Number"), ("Object.a__v", "w__v", "Number"),
        ("Object.a__v", "flag__v", "Boolean"), ("Object.a__v", "at__v", "DateTime"), ("Object.a__v", "day__v", "Date"),
        ("Object.77", "id", "Number"), ("Picklist.picklist__sys", "object", "String"), ("Picklist.picklist__sys", "object_field", "String"),
        ("Picklist.picklist__sys", "picklist_value_name", "String"), ("Object.empty__v", "id", "id"),
    ]),
    "Object/a__v.csv": 'id,name__v,n__v,w__v,flag__v,at__v,day__v,extra\nK1,"x\ny",1,1,true,2025-01-01T00:00Z,2025-01-01,007\nK2,,2.5,2,0,bad,,NA\n',
    "Object/77.csv": "id\n1\n2\n",
    "Picklist/picklist__sys.csv": "object,object_field,picklist_value_name\no,f,v\no,f,w\n",
    "manifest.csv": manifest([
        ("Object.a__v", "updates", 2, "Object/a__v.csv"), ("Object.77", "updates", 3, "Object/77.csv"), ("Object.empty__v", "updates", 0, "Object/empty__v.csv"),
        ("Picklist.picklist__sys", "updates", 2, "Picklist/picklist__sys.csv"),
    ]),
}
INCREMENTAL = {
    "Metadata/metadata.csv": dictionary([
        ("Object.a__v", "id", "String"), ("Object.a__v", "New__v", "Number"), ("Object.a__v", "day__v", "DateTime"), ("Object.a__v", "n__v", "String"),
        ("Object.b__v", "id", "String"), ("Object.b__v", "t__v", "LongText"),
    ]),
    "Metadata/metadata_deletes.csv": "extract,column_name,deleted_date\nObject.a__v,flag__v,2025-01-02\nObject.77,id,2025-01-02\n",
    "Object/a__v.csv": "id,name__v,new__v,day__v\nK2,two,5,2025-02-02\nK3,three,1.5,2025-02-03\n",
    "Object/a__v_deletes.csv": "id,deleted_date\nK1,2025-01-02T00:00Z\nK3,2025-01-02T00:00Z\n",
    "Object/b__v.csv": "id,t__v\nB,text\n",
    "Picklist/picklist__sys_deletes.csv": "object,object_field,picklist_value_name,deleted_date\no,f,v,2025-01-02\n",
    "manifest.csv": manifest([
        ("Metadata.metadata", "updates", 6, "Metadata/metadata.csv"), ("Metadata.metadata", "deletes", 2, "Metadata/metadata_deletes.csv"),
        ("Object.a__v", "updates", 2, "Object/a__v.csv"), ("Object.a__v_deletes", "deletes", 2, "Object/a__v_deletes.csv"),
        ("Object.b__v", "updates", 1, "Object/b__v.csv"), ("Picklist.picklist__sys_deletes", "deletes", 1, "Picklist/picklist__sys_deletes.csv"),
        ("Object.gone__v_deletes", "deletes", 0, "Object/gone__v_deletes.csv"),
    ]),
}


@pytest.fixture()
def store(spark, tmp_path):
    return Target(spark, str(tmp_path / "store"), buckets=4)


@pytest.fixture()
def loaded(spark, tmp_path, store):
    report = load_full(spark, put(tmp_path / "full", FULL), store)
    return store, {r["table_name"]: (r["declared"], r["loaded"], r["status"]) for r in report.collect()}


def test_full_load(loaded, spark, tmp_path, rows):
    store, report = loaded
    # One of its dates is no date.
    assert report == {"a__v": (2, 2, "values lost"), "n_77": (3, 2, "count differs"), "picklist__sys": (2, 2, "ok")}
    assert store.tables() == ["a__v", "empty__v", "metadata", "n_77", "picklist__sys"]
    a = store.read("a__v")
    assert a.schema.simpleString() == ("struct<id:string,name__v:string,n__v:double,w__v:bigint,flag__v:boolean,at__v:timestamp,"
                                       "day__v:date,extra:string>")
    got = {r["id"]: r for r in a.collect()}
    assert got["K1"]["name__v"] == "x\ny" and got["K1"]["extra"] == "007" and got["K1"]["flag__v"] is True
    assert got["K2"]["name__v"] is None and got["K2"]["n__v"] == 2.5 and got["K2"]["at__v"] is None and got["K2"]["extra"] == "NA"
    assert store.read("n_77").schema.simpleString() == "struct<id:bigint>"
    assert store.read("metadata").count() == 12
    # Repeated: append adds the rows again, replace does not.
    load_full(spark, str(tmp_path / "full"), store)
    assert store.read("a__v").count() == 4
    load_full(spark, str(tmp_path / "full"), store, LoadOptions(mode="replace"))
    assert store.read("a__v").count() == 2


@pytest.mark.parametrize("options,kind", [(LoadOptions(profile="all_string"), "string"), (LoadOptions(numeric="decimal"), "decimal(38,10)"),
                                          (LoadOptions(numeric="double"), "double"), (LoadOptions(infer_schema=True), "double")])
def test_type_choices(spark, tmp_path, store, options, kind):
    load_full(spark, put(tmp_path / "full", FULL), store, options)
    assert store.read("a__v").schema["n__v"].dataType.simpleString() == kind
    assert store.read("a__v").count() == 2


def test_incremental(loaded, spark, tmp_path, rows):
    store, _ = loaded
    folder = put(tmp_path / "inc", INCREMENTAL)
    for _ in range(2):  # twice is once
        report = {(r["table_name"], r["change"]): r["status"] for r in apply_incremental(spark, folder, store).collect()}
        assert report == {("a__v", "updates"): "ok", ("a__v", "deletes"): "ok", ("b__v", "updates"): "ok", ("picklist__sys", "deletes"): "ok"}
        a = store.read("a__v")
        # A new column although the update also lists the key; a change to text is left alone; lower-case names.
        assert a.schema.simpleString() == ("struct<id:string,name__v:string,n__v:double,w__v:bigint,at__v:timestamp,"
                                           "day__v:timestamp,extra:string,new__v:double>")
        got = {r["id"]: r for r in a.collect()}
        assert set(got) == {"K2", "K3"}  # K3 is deleted and updated: it survives
        assert got["K2"]["name__v"] == "two" and got["K2"]["n__v"] is None and got["K2"]["new__v"] == 5.0  # whole rows are replaced
        assert "n_77" not in store.tables()
        assert rows(store.read("b__v")) == [("B", "text")]
        assert rows(store.read("picklist__sys")) == [("o", "f", "w")]
        keys = {(r["extract"], r["column_name"]): r["type"] for r in store.read("metadata").collect()}
        assert ("Object.a__v", "flag__v") not in keys and keys[("Object.a__v", "day__v")] == "DateTime"
        assert keys[("Object.b__v", "t__v")] == "LongText"


def test_full_of_new_state_equals_incremental_on_old(spark, tmp_path, rows):
    meta = dictionary([("Object.t", "id", "Number"), ("Object.t", "v", "String")])
    old = {"Metadata/metadata.csv": meta, "Object/t.csv": "id,v\n1,a\n2,b\n3,c\n", "manifest.csv": manifest([("Object.t", "updates", 3, "Object/t.csv")])}
    new = {**old, "Object/t.csv": "id,v\n2,B\n3,c\n4,d\n"}
    inc = {"Object/t.csv": "id,v\n2,B\n4,d\n", "Object/t_deletes.csv": "id,deleted_date\n1,x\n",
           "manifest.csv": manifest([("Object.t", "updates", 2, "Object/t.csv"), ("Object.t_deletes", "deletes", 1, "Object/t_deletes.csv")])}
    one, two = Target(spark, str(tmp_path / "one")), Target(spark, str(tmp_path / "two"))
    load_full(spark, put(tmp_path / "old", old), one)
    apply_incremental(spark, put(tmp_path / "inc", inc), one)
    load_full(spark, put(tmp_path / "new", new), two)
    assert rows(one.read("t")) == rows(two.read("t"))


def test_log_load_and_parquet_extract(spark, tmp_path, store, rows):
    log = {"metadata_full.csv": dictionary([("Log.l", "id", "String"), ("Log.l", "x", "Number")]), "Log/l.csv": "id,x\na,1\nb,2\n",
           "manifest.csv": manifest([("Log.l", "updates", 2, "Log/l.csv")])}
    folder = put(tmp_path / "log", log)
    load_log(spark, folder, store)
    load_log(spark, folder, store)
    assert rows(store.read("l")) == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]


def test_archives_to_parquet_to_tables(spark, tmp_path, rows):
    from test_files import make_archive

    (tmp_path / "in").mkdir()
    make_archive(tmp_path / "in" / "e.tar.gz", FULL)
    report = {r["member"]: r["records"] for r in unpack(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert report == {"Metadata/metadata.csv": 12, "Object/a__v.csv": 2, "Object/77.csv": 2, "Picklist/picklist__sys.csv": 2, "manifest.csv": 4}
    store = Target(spark, str(tmp_path / "store"))
    load_full(spark, str(tmp_path / "out"), store, LoadOptions(parquet=True))
    assert {r["id"]: r["n__v"] for r in store.read("a__v").collect()} == {"K1": 1.0, "K2": 2.5}
    other = unpack(spark, str(tmp_path / "in"), str(tmp_path / "csv"), parquet=False)
    assert other.count() == 5
    plain = Target(spark, str(tmp_path / "plain"))
    load_full(spark, str(tmp_path / "csv"), plain)
    assert rows(plain.read("a__v")) == rows(store.read("a__v"))


def test_plan_is_tolerant(spark, store):
    apply_plan(store, [{"step": 1, "table_name": "no", "action": "drop_table", "column_name": None, "type": None},
                       {"step": 1, "table_name": "no2", "action": "drop_column", "column_name": "x", "type": None}])
    assert store.tables() == []


def test_stream_of_extracts(loaded, spark, tmp_path, rows):
    store, _ = loaded
    landing = tmp_path / "landing"
    put(landing / "2025-01-02", INCREMENTAL)
    stream_extracts(spark, str(landing), store, str(tmp_path / "cp")).awaitTermination()
    first = rows(store.read("a__v"))
    assert {r[0] for r in first} == {"K2", "K3"}
    later = {"Object/b__v.csv": "id,t__v\nC,more\n", "manifest.csv": manifest([("Object.b__v", "updates", 1, "Object/b__v.csv")])}
    put(landing / "2025-01-03", later)
    stream_extracts(spark, str(landing), store, str(tmp_path / "cp")).awaitTermination()
    assert rows(store.read("b__v")) == [("B", "text"), ("C", "more")]
    assert rows(store.read("a__v")) == first


def test_stream_of_one_table(spark, tmp_path, rows):
    store = Target(spark, str(tmp_path / "store"))
    store.create("t", T.StructType.fromDDL("id bigint, v string"), ["id"])
    landing = str(tmp_path / "landing")
    for stop, data in (("2", [(1, "new"), (2, "b")]), ("1", [(1, "old"), (3, "c")])):
        spark.createDataFrame([(*r, stop) for r in data], "id bigint, v string, stop string").coalesce(1).write.mode("append").parquet(landing)
    schema = T.StructType.fromDDL("id bigint, v string, stop string")
    for _ in range(2):
        stream_table(spark, landing, schema, store, "t", ["id"], str(tmp_path / "cp"), "stop").awaitTermination()
        assert rows(store.read("t")) == [(1, "new"), (2, "b"), (3, "c")]


def test_many_waiting_files_are_few_batches(spark, tmp_path, rows, monkeypatch):
    from tidemark.streaming import incremental

    monkeypatch.setattr(incremental, "MOST_BATCHES", 2)
    store = Target(spark, str(tmp_path / "store"))
    store.create("t", T.StructType.fromDDL("id bigint, v string"), ["id"])
    for i in (3, 1, 4, 2, 5):
        spark.createDataFrame([(0, f"v{i}", str(i)), (i, "own", str(i))], "id bigint, v string, stop string").coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
    run = stream_table(spark, str(tmp_path / "landing"), T.StructType.fromDDL("id bigint, v string, stop string"), store, "t", ["id"], str(tmp_path / "cp"), "stop", files_per_batch=1)
    run.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in run.recentProgress) == 2
    assert rows(store.read("t")) == [(0, "v5")] + [(i, "own") for i in range(1, 6)]


def test_late_rows_of_one_table(spark, tmp_path, rows):
    store = Target(spark, str(tmp_path / "store"))
    store.create("t", T.StructType.fromDDL("id bigint, v string"), ["id"])
    landing, ddl = str(tmp_path / "landing"), "id bigint, v string, gone boolean, stop string"
    run = lambda: stream_table(spark, landing, T.StructType.fromDDL(ddl), store, "t", ["id"], str(tmp_path / "cp"), "stop", deleted="gone").awaitTermination()
    batches = [
        ([(1, "new", False, "2"), (2, None, True, "2"), (3, "x", False, "2"), (3, None, True, "2"), (None, "n", False, "2")], [(1, "new"), (3, "x"), (None, "n")]),
        ([(1, "old", False, "1"), (2, "old", False, "1"), (3, None, True, "1"), (4, "d", None, "1"), (None, "o", False, "1")], [(1, "new"), (3, "x"), (4, "d"), (None, "n")]),
        # of the same time: parts of one extract
        ([(1, None, True, "2"), (2, "again", False, "2"), (4, None, True, "3")], [(1, "new"), (2, "again"), (3, "x"), (None, "n")]),
        ([(4, "late", False, "2"), (2, "last", False, "9"), (2, "two", False, "9")], [(1, "new"), (2, "last"), (2, "two"), (3, "x"), (None, "n")]),
    ]
    for data, want in batches:
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(landing)
        for _ in range(2):
            run()
            assert rows(store.read("t")) == sorted(want, key=repr)
    assert store.tables() == ["t"]


def test_late_change_after_a_failure(spark, tmp_path, rows, monkeypatch):
    """The table is changed, the clocks are not yet: the repeated batch sets them and changes nothing else."""
    from tidemark.streaming import incremental

    store = Target(spark, str(tmp_path / "store"))
    store.create("t", T.StructType.fromDDL("id bigint, v string"), ["id"])
    landing, ddl = str(tmp_path / "landing"), "id bigint, v string, stop string"
    run = lambda: stream_table(spark, landing, T.StructType.fromDDL(ddl), store, "t", ["id"], str(tmp_path / "cp"), "stop").awaitTermination()
    spark.createDataFrame([(1, "new", "2")], ddl).write.parquet(landing)
    with monkeypatch.context() as m:
        m.setattr(incremental, "advance", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            run()
    version = store.snapshot("t").version
    run()
    assert store.snapshot("t").version == version and rows(store.read("t")) == [(1, "new")]
    spark.createDataFrame([(1, "old", "1")], ddl).write.mode("append").parquet(landing)
    run()
    assert rows(store.read("t")) == [(1, "new")]


def test_latest_archive_with_parts(spark, tmp_path):
    from test_files import make_archive

    make_archive(tmp_path / "x.tar.gz", FULL)
    data = (tmp_path / "x.tar.gz").read_bytes()
    for i in (1, 2):
        (tmp_path / f"p{i}").write_bytes(data[:200] if i == 1 else data[200:])
    parts = [("b", "p2", 2, 1, None), ("a", "p1", 1, 1, None)]
    listing = spark.createDataFrame([
        ("old", "old.tar.gz", "full", "1", "2", 5, 1, 1, []), ("new", "x.tar.gz", "full", "2", "3", 9, 1, 2, parts),
        ("none", "n.tar.gz", "log", "2", "3", 0, 1, 1, [])], LISTING_SCHEMA)
    found = latest_archive(listing, "full", str(tmp_path))
    assert found == [("x.tar.gz", [f"{tmp_path}/p1", f"{tmp_path}/p2"])]
    assert latest_archive(listing, "log", str(tmp_path)) == []
    assert unpack(spark, found, str(tmp_path / "out")).count() == 5


def test_release_deletes_only_what_was_settled(spark, tmp_path):
    stored = settle(spark.range(5))
    folder = stored.inputFiles()[0].rsplit("/", 1)[0]
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    release(stored, None, spark.read.parquet(str(tmp_path / "mine")))
    assert not path_exists(spark, folder)
    assert spark.read.parquet(str(tmp_path / "mine")).count() == 3
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


@pytest.mark.parametrize("kind, large", [("incremental", False), ("incremental", True), ("log", False)])
def test_fractions_widen_whole_numbers(spark, tmp_path, store, rows, kind, large):
    words = dictionary([("Object.x__v", "id", "String"), ("Object.x__v", "amount__v", "Number")])
    whole = 2**53 + 1 if large else 2
    first = {"Metadata/metadata.csv": words, "metadata_full.csv": words, "Object/x.csv": f"id,amount__v\na,1\nb,{whole}\n", "manifest.csv": manifest([("Object.x__v", "updates", 2, "Object/x.csv")])}
    later = dict(first, **{"Object/x.csv": "id,amount__v\nb,2.5\nc,3.75\nd,none\n", "manifest.csv": manifest([("Object.x__v", "updates", 3, "Object/x.csv")])})
    load = load_full if kind == "incremental" else load_log
    assert [r.status for r in load(spark, put(tmp_path / "1", first), store).collect()] == ["ok"]
    assert store.read("x__v").schema["amount__v"].dataType == T.LongType()
    then = apply_incremental if kind == "incremental" else load_log
    (report,) = then(spark, put(tmp_path / "2", later), store).collect()
    assert (report.status, report.message) == ("values lost", "1 values did not convert")
    table = store.read("x__v")
    assert table.schema["amount__v"].dataType == (T.DecimalType(38, 10) if large and kind == "incremental" else T.DoubleType())
    want = [("a", 1.0), ("b", 2.5), ("c", 3.75), ("d", None)] + ([] if kind == "incremental" else [("b", float(whole))])
    assert rows(table.selectExpr("id", "cast(amount__v as double)")) == sorted(want, key=repr)


def test_typed_parquet_fractions_widen(spark, tmp_path, store, rows):
    store.create("x__v", T.StructType.fromDDL("id string, amount__v bigint"), ["id"])
    store.append("x__v", spark.createDataFrame([("a", 1), ("b", 2)], "id string, amount__v bigint"))
    folder = tmp_path / "p"
    spark.createDataFrame([("b", 2.5)], "id string, amount__v double").write.parquet(str(folder / "Object/x.parquet"))
    spark.createDataFrame([("Object.x__v", "", "updates", 1, "Object/x.csv")], "extract string, extract_label string, type string, records bigint, file string").write.parquet(str(folder / "manifest.parquet"))
    report = apply_incremental(spark, str(folder), store, LoadOptions(parquet=True)).collect()
    assert [r.status for r in report] == ["ok"] and rows(store.read("x__v")) == [("a", 1.0), ("b", 2.5)]


def test_all_dictionary_files_and_numeric_rule(spark, tmp_path, store):
    store.create("a__v", T.StructType.fromDDL("id string, old1 string, old2 string"), ["id"])
    files = {
        "m1.csv": dictionary([("Object.a__v", "c1", "Number")]), "m2.csv": dictionary([("Object.a__v", "c2", "String"), ("Object.a__v", "c3", "Boolean")]),
        "d1.csv": "extract,column_name,deleted_date\nObject.a__v,old1,2025-01-02\n", "d2.csv": "extract,column_name,deleted_date\nObject.a__v,old2,2025-01-02\n",
        "manifest.csv": manifest([("Metadata.metadata", "updates", 1, "m1.csv"), ("Metadata.metadata", "updates", 2, "m2.csv"),
                                  ("Metadata.metadata", "deletes", 1, "d1.csv"), ("Metadata.metadata", "deletes", 1, "d2.csv")]),
    }
    apply_incremental(spark, put(tmp_path / "x", files), store, LoadOptions(numeric="decimal"))
    assert {f.name: f.dataType.simpleString() for f in store.read("a__v").schema.fields} == {"id": "string", "c1": "decimal(38,10)", "c2": "string", "c3": "boolean"}


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import shared_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
