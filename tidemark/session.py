"""Shared storage helpers: where intermediate tables live and how small control files are kept.

Everything that several tasks, or a recomputed task, must see goes to the folder the cluster names
in ``spark.checkpoint.dir``. Only when that is unset and driver and tasks are one process (tests, a laptop) a private folder is made.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def in_parallel(spark: SparkSession, work: Callable, items: Sequence, width: int) -> list:
    """Independent tables as concurrent Spark jobs, so that small tables do not leave the cluster idle."""
    if not items:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(items)))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release(*frames: DataFrame | None) -> None:
    """Delete what ``settle`` stored for these DataFrames; they cannot be read afterwards."""
    for df in frames:
        if df is None:
            continue
        root = _scratch_root(df.sparkSession)
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"{root.split(':', 1)[-1].lstrip('/')}/" in folder:
                delete_path(df.sparkSession, folder)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete everything this application stored in the shared folder; call it when its results are consumed."""
    return delete_path(spark, _scratch_root(spark))


def observed(df: DataFrame, *measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with measures that the job which writes it takes on its way; ``observation.get`` has them afterwards.

    The measures belong directly below a write: there they are part of its last stage, whose tasks count once however often they run.
    """
    taken = Observation()
    return df.observe(taken, *measures), taken


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a plan is read more than once and must give the same rows each time (row positions,
    sampled range boundaries), also when executors are lost in between.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when the query ends. Else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def local_rows(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A handful of rows the driver made (catalogue entries, reports), as a relation whose size the optimizer knows."""
    fields = [part.split() for part in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(values), _ARROW[kind]) for values, (_, kind) in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[name for name, _ in fields]))


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame, which the optimizer sees to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, as tasks outside the JVM need it."""
    fs, jpath = _file_system(spark, path)
    return fs.makeQualified(jpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty when it does not exist."""
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size in bytes of everything at ``path``, which may hold wildcards."""
    fs, jpath = _file_system(spark, path)
    found = fs.globStatus(jpath)
    return sum(fs.getContentSummary(status.getPath()).getLength() for status in found) if found else 0


def files_at(spark: SparkSession, path: str) -> list[str]:
    """Addresses of the data files at ``path`` (a file, a folder or a pattern), sorted."""
    fs, jpath = _file_system(spark, path)
    out = []
    for found in fs.globStatus(jpath) or []:
        for status in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if not status.isDirectory() and status.getPath().getName()[0] not in "_.":
                out.append(status.getPath().toString())
    return sorted(out)


def text_lines(spark: SparkSession, path: str) -> Iterator[bytes]:
    """Lines of one file, compressed or not, read through the file system as far as they are taken."""
    fs, jpath = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(jpath)
    stream = fs.open(jpath) if codec is None else codec.createInputStream(fs.open(jpath))
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            yield line.encode("utf-8", "replace")
    finally:
        reader.close()


def read_small_text(spark: SparkSession, path: str) -> str:
    """Content of one control file (a few kilobytes)."""
    fs, jpath = _file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Create one control file; fails when it exists, so two writers cannot both win."""
    fs, jpath = _file_system(spark, path)
    stream = fs.create(jpath, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.delete(jpath, True)
