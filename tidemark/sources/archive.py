"""Archive source: ``.tar.gz`` files of CSV members, each possibly stored in several numbered parts.

A gzip stream can only be read from its start, so one archive is one task; archives are read side by
side. The task only unpacks and frames records, a block at a time, with no step per line. Parsing and typing happen afterwards in Spark, on as many tasks as there are rows for.
"""

from __future__ import annotations

import io
import json
import sys
import tarfile
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.session import qualified
from tidemark.sources import framing
from tidemark.sources.files import parse_records
from tidemark.sources.framing import as_text, record_arrays

# The reader travels to the executors with its code, so that they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(framing)

RECORDS_SCHEMA = "archive string, member string, record_no bigint, record string"
BLOCK_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20


def _local_path(uri: str) -> str:
    """An address as pyarrow takes it: ``file:/x`` as ``/x``, Hadoop's names of an object store by the store's own."""
    if uri.startswith("file:/") and "://" not in uri:
        return uri[len("file:"):]
    scheme, mark, rest = uri.partition("://")
    return f"s3{mark}{rest}" if scheme in ("s3a", "s3n") else uri


class _PartStream(io.RawIOBase):
    """Stored parts of one object, read one after the other."""

    def __init__(self, uris: Sequence[str]):
        self._pending = list(uris)
        self._current = None

    def readable(self) -> bool:
        return True

    def _next(self):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(_local_path(self._pending.pop(0)))
        return system.open_input_stream(path, compression=None)

    def readinto(self, buffer) -> int:
        while True:
            if self._current is None:
                if not self._pending:
                    return 0
                self._current = self._next()
            data = self._current.read(len(buffer))
            if data:
                buffer[: len(data)] = data
                return len(data)
            self._current.close()
            self._current = None


class _ArchivePartition(InputPartition):
    def __init__(self, name: str, uris: Sequence[str]):
        super().__init__(name)
        self.name = name
        self.uris = list(uris)


class _ArchiveReader(DataSourceReader):
    def __init__(self, archives: Sequence[tuple[str, Sequence[str]]]):
        self._archives = archives

    def partitions(self):
        return [_ArchivePartition(name, uris) for name, uris in self._archives]

    def read(self, partition):
        import pyarrow as pa

        def batch(member, first, records):
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(v), n) for v in (partition.name, member)] + [pa.array(range(first, first + n), pa.int64()), as_text(records)],
                names=["archive", "member", "record_no", "record"],
            )

        stream = io.BufferedReader(_PartStream(partition.uris), 1 << 20)
        with tarfile.open(fileobj=stream, mode="r|gz") as tar:
            for info in tar:
                if not info.isfile():
                    continue
                first = 0
                source = tar.extractfile(info)
                for records in record_arrays(iter(lambda: source.read(BLOCK_BYTES), b"")):
                    yield batch(info.name, first, records)
                    first += len(records)


class ArchiveDataSource(DataSource):
    """``spark.read.format("tar_extract").option("archives", json)``; see ``scan_archives``."""

    @classmethod
    def name(cls) -> str:
        return "tar_extract"

    def schema(self) -> str:
        return RECORDS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader([(name, uris) for name, uris in json.loads(self.options["archives"])])


def archive_parts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Archives at ``path`` with their parts in order: ``name.tar.gz``, or ``name.tar.gz.001`` and so on.

    Only file names come to the driver, one per archive part.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    part = F.regexp_extract("path", r"\.tar\.gz\.(\d+)$", 1)
    named = files.select(
        F.regexp_replace("path", r"\.(\d+)$", "").alias("archive"),
        F.when(part == "", 0).otherwise(part.try_cast("int")).alias("part"),
        "path",
        "length",
    ).where(F.col("archive").endswith(".tar.gz"))
    listed = named.groupBy("archive").agg(
        F.sum("length").alias("bytes"), F.array_sort(F.collect_list(F.struct("part", "path"))).alias("parts")
    )
    # Largest first, so that the longest task does not start last.
    return [(r["archive"], [p["path"] for p in r["parts"]]) for r in listed.orderBy(F.desc("bytes"), "archive").collect()]


def scan_archives(spark: SparkSession, path: str) -> DataFrame:
    """Raw records ``(archive, member, record_no, record)`` of every member; record 0 is the header."""
    return scan_archive_parts(spark, archive_parts(spark, path))


def scan_archive_parts(spark: SparkSession, archives: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """As ``scan_archives``, for archives given by name with their parts in order."""
    spark.dataSource.register(ArchiveDataSource)
    return spark.read.format("tar_extract").option("archives", json.dumps(list(archives))).load()


def land_records(records: DataFrame, out: str) -> DataFrame:
    """Unpack once into Parquet by member, so that later reads are columnar, pruned to a member and splittable."""
    records.write.partitionBy("member").parquet(out)
    schema = "archive string, record_no bigint, record string, member string"
    return records.sparkSession.read.schema(schema).parquet(out)


def land_archives(spark: SparkSession, path: str, out: str) -> DataFrame:
    return land_records(scan_archives(spark, path), out)


def member_headers(records: DataFrame) -> DataFrame:
    """First record of each member."""
    return records.where("record_no = 0").groupBy("member").agg(F.min("record").alias("header"))


def member_table(records: DataFrame, member: str, columns: Sequence[str]) -> DataFrame:
    """Rows of one member as text columns."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = records.where((F.col("member") == member) & (F.col("record_no") > 0))
    return parse_records(rows, "record", schema)


def pack_archives(df: DataFrame, member: str, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``df`` as archives under ``path``, with one CSV member each; returns their names and rows.

    A task begins a new archive after ``archive_bytes`` of text, so their number grows with the table and a task holds no more than that (and a batch). A task
    that has no rows still writes an archive, with the header alone. The counterpart of the scan, used to hand extracts on and to test with.
    """
    path = qualified(df.sparkSession, path)
    header = ",".join(df.columns).encode("utf-8") + b"\n"
    quoted = [
        F.coalesce(F.concat(F.lit('"'), F.replace(F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
        for c in df.columns
    ]
    records = df.select(F.concat_ws(",", *quoted).alias("record"))

    def write(batches):
        import gzip

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), []

        def store(parts, rows):
            name = f"{path}/archive-{task:05d}-{len(made):05d}.tar.gz"
            system, base = fs.FileSystem.from_uri(_local_path(name))
            system.create_dir(base.rsplit("/", 1)[0], recursive=True)
            info = tarfile.TarInfo(member)
            info.size = sum(map(len, parts))  # the tar header states it, so an archive's text is put together before it is sent
            with system.open_output_stream(base, compression=None) as raw:
                with gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1) as zipped:
                    with tarfile.open(fileobj=zipped, mode="w|") as tar:
                        tar.addfile(info, io.BufferedReader(_Parts(parts)))
            made.append((name, rows))

        parts, size, rows = [header], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            whole = pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(0).cast(pa.binary()))
            parts.append(pc.binary_join(whole, b"\n")[0].as_py() + b"\n")
            size += len(parts[-1])
            rows += len(batch)
            if size >= archive_bytes:
                store(parts, rows)
                parts, size, rows = [header], 0, 0
        if rows or not made:
            store(parts, rows)
        yield pa.RecordBatch.from_pylist([{"archive": n, "records": r} for n, r in made])

    return records.mapInArrow(write, "archive string, records bigint")


class _Parts(io.RawIOBase):
    """Bytes in several parts, each given up when it is read."""

    def __init__(self, parts: Sequence[bytes]):
        self._pending, self._at = list(parts), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while self._pending and self._at == len(self._pending[0]):
            self._pending.pop(0)
            self._at = 0
        if not self._pending:
            return 0
        data = self._pending[0][self._at : self._at + len(buffer)]
        buffer[: len(data)] = data
        self._at += len(data)
        return len(data)
