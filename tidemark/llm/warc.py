"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames of bounded size; the frames of one task are one bundle. A bundle ends with a seek table (a skippable frame
with the sizes of all frames), so a reader finds any frame without those before it. The index, returned by the writer, maps each record
to its bundle, frame and place within the frame. Records whose payload another record already has become revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import create_file, open_file
from tidemark.session import qualified, settle

#: Fixed values of the seekable format: magic numbers of the skippable frame and of the seek table.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: Fixed value of the archive format: the profile of a record whose payload is the same as another's.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES = 1 << 20
DATE = "2025-01-01T00:00:00Z"
INDEX = "page_id bigint, bundle string, frame int, frame_offset bigint, record_offset bigint, record_bytes bigint"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def decide(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """id, url, html (UTF-8), refers (the response's id, null for responses).

    Payloads are compared by SHA-256; sums are made before the shuffle, and a hot payload is split by Spark's skew join.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "UTF-8").alias("html"),
    )
    key = F.sha2("html", 256).alias("key")
    groups = rows.where(F.octet_length("html") >= least).select(key, "id").groupBy("key").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = groups.where((F.col("n") > 1) & F.col("last").isNotNull()).select("key", "last")
    refers = F.when(F.col("id").isNull() | (F.col("id") < F.col("last")), F.col("last"))
    return rows.withColumn("key", F.when(F.octet_length("html") >= least, F.sha2("html", 256))).join(repeated, "key", "left").select("id", "url", "html", refers.alias("refers"))


def record_bytes(page_id, url, payload: bytes, refers) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = "" if page_id is None else page_id
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        # A header is one line: line ends and the escape itself are escaped.
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    body = payload
    if refers is None:
        head.append("Content-Type: text/html")
    else:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {SAME_PAYLOAD}"]
        body = b""
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record that begins at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record begins at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(head["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} is not whole")
    return head, data[start:stop], stop + 4


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_payload_bytes: int = 0,
                  frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """Write a record per row as bundles under ``path``; returns the index, stored: page_id, bundle, frame, frame_offset, record_offset, record_bytes.

    The payload is the html in UTF-8; a null one is empty. Of records with equal payloads of at least ``min_payload_bytes`` the one with the largest id is a
    response and the others are revisits of it. Rows that repeat both the largest id and its payload are each a response; a row without an id is a revisit if
    any equal payload has an id, else a response. Each run of a task writes a bundle of its own: those that the index does not name are of attempts that were
    repeated, and may be deleted. A null url is left out. An empty table gives no records. Other columns are not read.
    """
    path = qualified(pages.sparkSession, path)
    decided = decide(pages, id_col, url_col, html_col, min_payload_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        # Rows come in no certain order, so each attempt has a bundle of its own; the stored index names those of the attempts that count.
        bundle = f"bundle-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        packer, sizes, offset = zstandard.ZstdCompressor(level=level), [], 0
        frame, held, index = [], 0, []

        def flush(out) -> pa.RecordBatch:
            nonlocal offset, held
            body = b"".join(frame)
            packed = packer.compress(body)
            out.write(packed)
            ids, starts, lengths = zip(*index)
            made = pa.RecordBatch.from_pydict({
                "page_id": pa.array(ids, pa.int64()), "bundle": [bundle] * len(ids), "frame": pa.array([len(sizes)] * len(ids), pa.int32()),
                "frame_offset": [offset] * len(ids), "record_offset": list(starts), "record_bytes": list(lengths)})
            sizes.append((len(packed), len(body)))
            offset += len(packed)
            frame.clear()
            index.clear()
            held = 0
            return made

        with create_file(f"{path}/{bundle}") as out:
            for batch in batches:
                for page_id, url, html, refers in zip(*(batch.column(i) for i in range(4))):
                    record = record_bytes(page_id.as_py(), url.as_py(), html.as_py(), refers.as_py())
                    index.append((page_id.as_py(), held, len(record)))
                    frame.append(record)
                    held += len(record)
                    if held >= frame_bytes:
                        yield flush(out)
            if frame:
                yield flush(out)
            table = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
            out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)

    return settle(decided.mapInArrow(write, INDEX), "warc-index")


def seek_table(source) -> np.ndarray:
    """Offset, packed and plain size of each frame of an open bundle."""
    end = source.size()
    source.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    source.seek(end - 9 - 8 * count)
    sizes = np.frombuffer(source.read(8 * count), "<u4").reshape(-1, 2).astype(np.int64)
    return np.column_stack([np.cumsum(sizes[:, 0]) - sizes[:, 0], sizes])


def read_frame(source, offset: int, packed: int) -> bytes:
    import zstandard

    source.seek(offset)
    return zstandard.ZstdDecompressor().decompress(source.read(packed))


def read_bundles(spark: SparkSession, path: str, bundles: DataFrame) -> DataFrame:
    """All records of the bundles named in ``bundles`` (column ``bundle``): their headers and payloads; a revisit has no payload of its own."""
    path = qualified(spark, path)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_file(f"{path}/{name}") as source:
                    table = seek_table(source)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(table), pa.string()), pa.array(table[:, 0]), pa.array(table[:, 1])], names=["bundle", "at", "size"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with open_file(f"{path}/{name}") as source:
                    data = read_frame(source, at, size)
                rows, place = [], 0
                while place < len(data):
                    head, block, place = parse_record(data, place)
                    rows.append(_row(head, block))
                yield _batch(rows)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = bundles.select("bundle").distinct().mapInArrow(frames, "bundle string, at bigint, size bigint")
    return found.repartition(parts, "bundle", "at").mapInArrow(records, RECORDS)


def read_records(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """The records that ``index``, or any rows of it, names, as ``read_bundles`` gives them; only their frames are read.

    A frame is read once for all its records, whose number its size bounds. An entry that points at no record, or at one of another length, is an error.
    """
    path = qualified(spark, path)
    entries = F.sort_array(F.collect_list(F.struct("record_offset", "record_bytes"))).alias("entries")
    # Dealt by number, not by size: a row of the index stands for up to a frame of archive.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames = index.repartition(parts, "bundle", "frame_offset").groupBy("bundle", "frame_offset").agg(entries)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, entries in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with open_file(f"{path}/{name}") as source:
                    data = read_frame(source, at, _packed(seek_table(source), at))
                rows = []
                for entry in entries:
                    head, block, end = parse_record(data, entry["record_offset"])
                    if end != entry["record_offset"] + entry["record_bytes"]:
                        raise ValueError(f"the index does not fit {name}")
                    rows.append(_row(head, block))
                yield _batch(rows)

    return frames.mapInArrow(records, RECORDS)


def _packed(table: np.ndarray, frame_offset: int) -> int:
    """The packed size of the frame that begins at ``frame_offset``."""
    place = int(np.searchsorted(table[:, 0], frame_offset))
    if place == len(table) or table[place, 0] != frame_offset:
        raise ValueError(f"no frame begins at {frame_offset}")
    return int(table[place, 1])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in RECORDS.split(", ")])


def _row(head: dict, block: bytes) -> tuple:
    number = lambda text: int(text[len("<urn:page:") : -1]) if text and text != "<urn:page:>" else None
    kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
    if kind == "response":
        if len(block) != size or base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
    url = head.get("WARC-Target-URI")
    url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return number(head["WARC-Record-ID"]), url, size, digest, kind, number(head.get("WARC-Refers-To")), block if kind == "response" else None


def read_record(spark: SparkSession, path: str, bundle: str, frame_offset: int, record_offset: int) -> tuple[dict, bytes]:
    """One record by its index entry; only its frame is read."""
    with open_file(f"{qualified(spark, path)}/{bundle}") as source:
        head, block, _ = parse_record(read_frame(source, frame_offset, _packed(seek_table(source), frame_offset)), record_offset)
    return head, block
