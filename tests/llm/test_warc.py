"""WARC bundles: round trip, revisits, random access."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.files import open_file
from tidemark.llm.warc import read_bundles, read_record, read_records, seek_table, write_bundles
from tidemark.session import qualified, scratch_path


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rows = [(i, f"http://x/{i}", f"<p>page {i % 7}</p>\r\n\r\nWARC/1.1" + "é" * (i % 3)) for i in range(40)]
    rows += [(50, None, None), (51, "http://a\r\nb%0A%", ""), (52, "u", "abc"), (53, "u", "abc"), (53, "u", "abc"), (None, "n", "abc"), (None, "n", "alone"), (54, "long", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit("other")).withColumn("key", F.lit(1)).repartition(4)
    path = scratch_path(spark, "warc")
    index = write_bundles(df, path, min_payload_bytes=least, frame_bytes=400)
    got = read_bundles(spark, path, index).collect()
    assert sorted(map(repr, read_records(spark, path, index).collect())) == sorted(map(repr, got))
    want = []
    for i, url, html in rows:
        body = (html or "").encode("utf-8")
        same = [j for j, _, h in rows if (h or "").encode("utf-8") == body and j is not None] if len(body) >= least else []
        last = max(same, default=None)
        refers = last if last is not None and (i is None or i < last) else None
        want.append((i, url, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers, body if refers is None else None))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in got), key=repr) == sorted(want, key=repr)
    entry = index.where("page_id = 54").first()
    head, block = read_record(spark, path, entry.bundle, entry.frame_offset, entry.record_offset)
    assert head["WARC-Record-ID"] == "<urn:page:54>" and len(block) == 300_000
    # Frames are independent and the whole bundle is a plain Zstandard stream.
    import zstandard

    with open_file(f"{qualified(spark, path)}/{entry.bundle}") as source:
        frames = seek_table(source)
        source.seek(0)
        whole = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True).read()
    assert len(whole) == frames[:, 2].sum() and len(frames) == index.where(F.col("bundle") == entry.bundle).agg(F.max("frame")).first()[0] + 1


def test_no_pages(spark):
    path = scratch_path(spark, "warc")
    index = write_bundles(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert index.count() == 0 and read_bundles(spark, path, index).count() == 0
    assert read_records(spark, path, index).count() == 0


def test_a_repeated_task_leaves_the_index_valid(spark):
    """Two runs of the same tasks, whose rows come in different orders, write to one folder."""
    df = spark.range(60).selectExpr("id AS page_id", "concat('u', id) AS url", "repeat(cast(id AS string), cast(id + 1 AS int)) AS html").coalesce(1)
    path = scratch_path(spark, "warc")
    indexes = [write_bundles(rows, path, frame_bytes=900) for rows in (df, df.orderBy(F.col("page_id").desc()).coalesce(1))]
    for index in indexes:
        assert {r.page_id: bytes(r.payload) for r in read_records(spark, path, index).collect()} == {i: str(i).encode() * (i + 1) for i in range(60)}
        assert [r.page_id for r in read_records(spark, path, index.where("page_id = 37")).collect()] == [37]
    with pytest.raises(Exception, match="does not fit|no record begins|no frame begins|substring not found"):
        read_records(spark, path, indexes[0].withColumn("record_offset", F.col("record_offset") + 1)).collect()
