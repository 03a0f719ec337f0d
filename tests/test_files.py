import csv
import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import archive, files, listing
from tidemark.sources.framing import frame_records, lines_of

TEXT = 'id,t,n\r\n1,"a, ""b""\nc",2\r\n2,,3\r\n3,"",007\r\n\r\n4,NA\r\n5,"é €",1,extra\r\n'
WANT = [("1", 'a, "b"\nc', "2"), ("2", None, "3"), ("3", None, "007"), ("4", "NA", None), ("5", "é €", "1")]


@pytest.fixture(params=["7b", "40b", "128m"])
def split_size(spark, request):
    """Tiny splits, small ones, and whole files."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_edge_cases(spark, tmp_path, rows, split_size):
    path = tmp_path / "x.csv"
    path.write_bytes(TEXT.encode())
    assert files.headers(spark, str(path)) == ["id", "t", "n"]
    assert files.may_be_split(spark, str(path)) == (split_size != "128m")
    assert rows(files.scan_csv(spark, str(path))) == WANT


ODD = {
    "stray quotes": (b'a,b\n1,5" pipe\n2,x\n3,4" and 6"\n4,"q"\n5,y\n', [("1", '5" pipe'), ("2", "x"), ("3", '4" and 6"'), ("4", "q"), ("5", "y")]),
    "carriage returns": (b"a,b\r1,x\r2,y\r", [("1", "x"), ("2", "y")]),
    "blank lines first": (b"\n\r\na,b\n1,x\n\n2,y\n", [("1", "x"), ("2", "y")]),
    "line ends in quotes": (b'a,b\r\n1,"x\r\ny\rz\n\n"\r\n2,y', [("1", "x\ny\nz\n\n"), ("2", "y")]),
    "quoted header": (b'"a","b\nb"\n1,""""\n2,"a"",\nb"\n', [("1", '"'), ("2", 'a",\nb')]),
    "only a header": (b"a,b\n", []),
}


@pytest.mark.parametrize("case", ODD)
def test_odd_csv_is_the_same_in_splits_and_archives(spark, tmp_path, rows, split_size, case):
    text, want = ODD[case]
    (tmp_path / "x.csv").write_bytes(text)
    assert rows(files.scan_csv(spark, str(tmp_path / "x.csv"))) == want
    names = files.headers(spark, str(tmp_path / "x.csv"))
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        info = tarfile.TarInfo("x.csv")
        info.size = len(text)
        tar.addfile(info, io.BytesIO(text))
    records = archive.scan_archives(spark, str(tmp_path / "x.tar.gz"))
    assert rows(archive.member_table(records, "x.csv", names)) == want


@pytest.mark.parametrize("text,python", [("a,b\n1,x\n\n2,é\n", False), ("\na,b\n1,x\na,b\n2,é\n", True), ('a,b\n1,"x"\n2,é\n', True)])
def test_small_splits_share_tasks_and_plain_lines_stay_in_the_jvm(spark, tmp_path, rows, text, python):
    """Files without quotes need no framing; a line like the header is data further down."""
    for name in ("1.csv", "2.csv"):
        (tmp_path / name).write_text(text + "3,y\n" * 40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7b")
        scanned = files.scan_csv(spark, str(tmp_path))
        want = [("1", "x"), ("2", "é")] + ([("a", "b")] if text.count("a,b") > 1 else []) + [("3", "y")] * 40
        assert rows(scanned) == sorted(want * 2, key=repr)
        assert ("MapInArrow" in scanned._jdf.queryExecution().executedPlan().toString()) == python
        assert scanned.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism + 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_compressed_csv(spark, tmp_path, rows, split_size):
    import gzip

    with gzip.open(tmp_path / "x.csv.gz", "wb") as out:
        out.write(TEXT.encode())
    assert rows(files.scan_csv(spark, str(tmp_path / "x.csv.gz"))) == WANT


def test_open_quotes_and_other_headers_are_errors(spark, tmp_path, split_size):
    (tmp_path / "x.csv").write_bytes(b'a,b\n1,"x\n2,y\n3,z\n')
    with pytest.raises(Exception, match="left open"):
        files.scan_csv(spark, str(tmp_path / "x.csv")).collect()
    for name, text in (("1.csv", "a,b\n1,x\n"), ("2.csv", "b,a\ny,2\n")):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / name).write_text(text)
    with pytest.raises(Exception, match="instead of"):
        files.scan_csv(spark, str(tmp_path / "two")).collect()


@pytest.mark.parametrize("limit", ["100b", "1000b"])
def test_split_csv_against_csv_module(spark, tmp_path, limit):
    rnd = random.Random(3)
    table = [[str(i)] + ["".join(rnd.choice(['a', 'é', '"', '\n', ',', ' ', '""', '\n\n']) for _ in range(rnd.randrange(60))) + "." for _ in range(2)]
             for i in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["id", "a", "b"], *table])
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_text(out.getvalue(), encoding="utf-8", newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        got = sorted(tuple(r) for r in files.scan_csv(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(tuple(r) for r in table * 2)


def test_split_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for text, want in (("128m", 128 << 20), ("1GB", 1 << 30), ("134217728b", 134217728), ("64k", 65536), ("77", 77)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", text)
        assert files.split_bytes(spark) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_write_csv_round_trip(spark, tmp_path, rows):
    data = [(" lead", 'q"', "l\nf"), ("trail ", None, "\\"), ("c,", "007", "x")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    files.write_csv(df, str(tmp_path / "o.csv"))
    assert rows(files.scan_csv(spark, str(tmp_path / "o.csv"))) == sorted(data, key=repr)


def test_parquet_scan_and_headers(spark, tmp_path):
    spark.range(3).withColumn("x", F.lit("a")).write.parquet(str(tmp_path / "p"))
    assert files.headers(spark, str(tmp_path / "p"), "parquet") == ["id", "x"]
    assert files.scan_parquet(spark, str(tmp_path / "p"), merge_schema=True).count() == 3
    with pytest.raises(ValueError):
        files.headers(spark, "x", "xml")


def test_tolerant(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_bytes(b"id,t,d\n1,a\xffb\n2,abcdefgh,2025-01-02\nzz,x,no\n")
    schema = T.StructType.fromDDL("id bigint, t string, d date")
    got = files.scan_tolerant(spark, str(tmp_path / "x.csv"), schema, max_bytes=4)
    # An invalid byte becomes the replacement character, of three bytes.
    assert [r[:2] for r in rows(got)] == [(1, "a\ufffd"), (2, "abcd"), (None, "x")]


def test_frame_records():
    text = b'a,"b\nc"\r\n\nd,""\re,f"g'
    for size in range(1, 9):
        blocks = [text[i : i + size] for i in range(0, len(text), size)]
        assert list(frame_records(lines_of(blocks))) == [b'a,"b\nc"', b'd,""', b'e,f"g']
    with pytest.raises(ValueError):
        list(frame_records([b'e,"open']))


def make_archive(path, members):
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))


def test_archives_with_parts(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    make_archive(folder / "one.tar.gz", {"Object/a.csv": TEXT, "Metadata/metadata.csv": "x\n1\n", "empty.csv": ""})
    make_archive(tmp_path / "two.tar.gz", {"Object/a.csv": "id,t,n\n9,z,1\n"})
    data = (tmp_path / "two.tar.gz").read_bytes()
    for i in range(3):
        (folder / f"two.tar.gz.{i + 1:03d}").write_bytes(data[i * 60: (i + 1) * 60] if i < 2 else data[120:])
    parts = archive.archive_parts(spark, str(folder))
    assert sorted(len(p) for _, p in parts) == [1, 3]
    records = archive.scan_archives(spark, str(folder))
    assert records.rdd.getNumPartitions() == 2
    assert rows(archive.member_table(records, "Object/a.csv", ["id", "t", "n"])) == sorted([*WANT, ("9", "z", "1")], key=repr)
    assert {r["member"] for r in archive.member_headers(records).collect()} == {"Object/a.csv", "Metadata/metadata.csv"}
    landed = archive.land_archives(spark, str(folder), str(tmp_path / "landed"))
    assert landed.count() == records.count()


def test_reassemble(spark, rows):
    parts = spark.createDataFrame([("a", 2, "y"), ("a", 3, "z"), ("a", 1, "x"), ("b", 1, "q")], "name string, filepart int, data string")
    assert rows(listing.reassemble_parts(parts)) == [("a", "xyz"), ("b", "q")]
    raw = parts.withColumn("data", F.col("data").cast("binary"))
    assert rows(listing.reassemble_parts(raw))[0] == ("a", b"xyz")


@pytest.mark.parametrize("numbers", [(1, 3), (2, 3), (1, 1, 2)])
def test_missing_or_repeated_parts_are_errors(spark, numbers):
    parts = spark.createDataFrame([("a", n, "x") for n in numbers], "name string, filepart int, data string")
    with pytest.raises(Exception, match="missing or repeated"):
        listing.reassemble_parts(parts).collect()


def test_pieces_of_objects(spark, rows):
    rnd = random.Random(8)
    objects = {"a": 1, "b": 40, "c": 300, None: 7}
    parts = [(n, k, f"{n}{k}." if k % 5 else None) for n, count in objects.items() for k in range(1, count + 1)]
    rnd.shuffle(parts)
    df = spark.createDataFrame(parts, "name string, filepart int, data string").repartition(5)
    for size in (1, 50, 1 << 20):
        found = listing.stored_pieces(df, piece_bytes=size)
        got = {}
        for r in sorted(found.collect(), key=lambda r: r.first_part):
            assert r.first_part == got.get(r.name, (0, ""))[0] + 1 and len(r.data) < size + 8
            got[r.name] = (r.last_part, got.get(r.name, (0, ""))[1] + r.data)
        assert got == {n: (count, "".join(f"{n}{k}." for k in range(1, count + 1) if k % 5)) for n, count in objects.items()}
    assert bytes(listing.stored_pieces(df.withColumn("data", F.col("data").cast("binary")).where("name = 'a'")).first().data) == b"a1."
    assert listing.stored_pieces(df.limit(0)).count() == 0
    for numbers in ((1, 3), (2, 3), (1, 1, 2), (0, 1), tuple(range(1, 200)) + (201,)):
        broken = spark.createDataFrame([("a", n, "x") for n in numbers], "name string, filepart int, data string").repartition(4)
        with pytest.raises(Exception, match="missing or repeated"):
            listing.stored_pieces(broken)


def test_addresses_of_object_stores():
    assert archive._local_path("s3a://bucket/a b") == "s3://bucket/a b" and archive._local_path("s3://b/x") == "s3://b/x"
    assert archive._local_path("file:/tmp/x") == "/tmp/x" and archive._local_path("hdfs://h/x") == "hdfs://h/x"


def test_listing_scan(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"name": "a", "extract_type": "full", "stop_time": "2025", "record_count": 3, "filepart_details": [{"name": "p", "filepart": 1}]}\n')
    row = listing.scan_listing(spark, str(tmp_path / "l.json")).first()
    assert row.record_count == 3 and row.filepart_details[0].filepart == 1 and row.size is None


def test_pick_latest(spark):
    ddl = "name string, extract_type string, start_time string, stop_time string, record_count bigint"
    data = [("a", "full", "2025-01-01", "2025-01-02", 5), ("b", "incremental", "2025-01-02", "2025-01-03", 2),
            ("c", "incremental", "2025-01-03", "2025-01-04", 0)]
    df = spark.createDataFrame(data, ddl)
    assert listing.pick_latest(df, "FULL").first()["name"] == "a"
    assert listing.pick_latest(df, "incremental").count() == 0  # the last one is empty
    assert listing.pick_latest(df, "incremental", stop="2025-01-03").first()["name"] == "b"
    assert [r["name"] for r in listing.extracts_in_order(df, "incremental").collect()] == ["b"]


def test_manifest_rules(spark, tmp_path):
    (tmp_path / "manifest.csv").write_text(
        "extract,extract_label,type,records,file\nObject.a,A,updates,3,Object/a.csv\nObject.b,B,updates,0,Object/b.csv\n"
        "Object.12,N,updates,1,Object/12.csv\nObject.my_metadata__c,M,updates,2,Object/m.csv\nMetadata.metadata,D,updates,4,Metadata/m.csv\n"
        "Object.a_deletes,A,deletes,2,Object/a_deletes.csv\n")
    manifest = listing.scan_manifest(spark, str(tmp_path))
    names = lambda df: sorted(r["table_name"] for r in df.collect())
    assert names(listing.manifest_tables(manifest)) == ["a", "metadata", "my_metadata__c", "n_12"]
    assert names(listing.manifest_tables(manifest, kind="incremental")) == ["a", "my_metadata__c", "n_12"]
    assert names(listing.manifest_tables(manifest, "deletes", "incremental")) == ["a"]
    assert listing.metadata_changes(manifest, "updates").count() == 1
    assert listing.metadata_changes(manifest, "deletes").count() == 0
    paths = {r["table_name"]: r["path"] for r in listing.extract_paths(manifest, "s3://x/y", parquet=True).collect()}
    assert paths["n_12"] == "s3://x/y/Object/12.parquet"
    with pytest.raises(ValueError):
        listing.manifest_tables(manifest, kind="other")


def test_inferred(spark, tmp_path, rows, split_size):
    (tmp_path / "x.csv").write_text('a,b,c,d,e,f\n1,1.5,true,2025-01-02,2025-01-02T03:04:05Z,"x\ny"\n-2,2,FALSE,2025-01-03,2025-01-03 00:00:00,7\n,,,,,\n')
    df = files.scan_inferred_csv(spark, str(tmp_path / "x.csv"))
    assert df.schema.simpleString() == "struct<a:bigint,b:double,c:boolean,d:date,e:timestamp,f:string>"
    assert df.agg(F.sum("a"), F.sum("b"), F.count("c"), F.min(F.date_format("e", "HH:mm:ss"))).first()[:] == (-1, 3.5, 2, "00:00:00")


def test_lines_are_framed_alike_one_by_one_and_all_at_once():
    import random

    import pyarrow as pa
    from tidemark.sources.framing import compose, ends_inside, frame_records, line_arrays, line_maps, lines_of, record_arrays

    rnd = random.Random(4)
    for _ in range(200):
        lines = ["".join(rnd.choice('"",,ab é') for _ in range(rnd.randint(0, 12))).encode() for _ in range(rnd.randint(1, 40))]
        maps = line_maps(pa.array(lines, pa.binary()))
        for begin in (False, True):
            state = begin
            assert compose(*maps, begin).tolist() == [state := ends_inside(line, state) for line in lines]
        body = b"".join(line + rnd.choice([b"\n", b"\r\n", b"\r", b"\n\n"]) for line in lines) + rnd.choice([b"", b"end", b"\xff,x"])
        size = rnd.choice([1, 3, 17, 1000])
        blocks = [body[i : i + size] for i in range(0, len(body), size)]
        assert [x for part in line_arrays(blocks) for x in part.to_pylist()] == list(lines_of(blocks))
        try:
            want = list(frame_records(lines_of(blocks)))
        except ValueError:
            with pytest.raises(ValueError, match="left open"):
                list(record_arrays(blocks))
        else:
            assert [x for part in record_arrays(blocks) for x in part.to_pylist()] == want


def test_archives_grow_with_the_table(spark, tmp_path, rows):
    from pyspark.sql import functions as F

    from tidemark.sources import archive

    df = spark.range(0, 50_000, 1, 2).select("id", F.concat(F.lit('a "quoted",\n'), F.col("id")).alias("text"))
    made = archive.pack_archives(df, "Object/t.csv", str(tmp_path / "out"), archive_bytes=200_000).collect()
    assert len(made) > 4 and sum(r.records for r in made) == 50_000
    found = archive.scan_archives(spark, str(tmp_path / "out"))
    assert found.select("archive").distinct().count() == len(made)
    table = archive.member_table(found, "Object/t.csv", ["id", "text"]).select(F.col("id").cast("bigint"), "text")
    assert rows(table) == rows(df)
    assert archive.pack_archives(df.where("id < 0"), "t.csv", str(tmp_path / "none")).agg(F.sum("records")).first()[0] == 0
