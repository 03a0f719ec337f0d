"""Document jobs: text and content of document versions to stored objects."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.documents import content_objects, text_objects
from tidemark.session import qualified
from tidemark.sources.archive import _local_path

#: Objects that a task reads, and that it holds before it hands them on.
OBJECTS_A_TASK, OBJECTS_AT_ONCE = 10_000, 64


def write_texts(versions: DataFrame, texts: DataFrame, out: str, batch_size: int = 10_000) -> None:
    """Document texts as Parquet ``(path, text)``, partitioned by batch; line breaks stay inside the value."""
    _by_batch(text_objects(versions, texts, batch_size)).write.partitionBy("batch").parquet(out)


def write_contents(
    versions: DataFrame, results: DataFrame, out: str, batch_size: int = 10_000, sees_all: Column | None = None
) -> None:
    """Document contents as Parquet ``(path, staged_at, content)``, partitioned by batch."""
    _by_batch(content_objects(versions, results, batch_size, sees_all)).write.partitionBy("batch").parquet(out)


def _by_batch(objects: DataFrame) -> DataFrame:
    """Rows of a batch together, so that a batch is a few files and not one per task; a heavy batch is split."""
    return objects.hint("rebalance", "batch")


def write_objects(df: DataFrame, root: str, path: str = "path", content: str = "content") -> None:
    """One stored object per row, written by the tasks. An object has its name only when it is whole; a task that is repeated writes the same objects again."""
    root = qualified(df.sparkSession, root)
    body = F.col(content)
    if isinstance(df.schema[content].dataType, T.StringType):
        body = body.cast("binary")

    def store(rows):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(_local_path(root))
        made = None
        for row in rows:
            name = f"{base}/{row['path']}"
            folder, last = name.rsplit("/", 1)
            if folder != made:
                system.create_dir(folder, recursive=True)
                made = folder
            hidden = f"{folder}/_{uuid.uuid4().hex}.{last}"
            try:
                with system.open_output_stream(hidden, compression=None) as out:
                    out.write(bytes(row["content"]))
                system.move(hidden, name)
            except BaseException:
                with contextlib.suppress(OSError):
                    system.delete_file(hidden)
                raise

    df.select(F.col(path).alias("path"), body.alias("content")).foreachPartition(store)


def read_objects(df: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Rows of ``df`` with the ``content`` of the stored object that each one names; a missing object is an error.

    The names are dealt out and the tasks open the objects themselves: no folder is listed, and no split is planned for each object.
    """
    root = qualified(df.sparkSession, root)
    schema = T.StructType([*df.schema.fields, T.StructField("content", T.BinaryType())])

    def fetch(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(_local_path(root))

        def load(name):
            with system.open_input_stream(f"{base}/{name}", compression=None) as source:
                return source.read()

        for batch in batches:
            # In small pieces, since an object is larger than its name.
            for piece in (batch.slice(i, OBJECTS_AT_ONCE) for i in range(0, batch.num_rows, OBJECTS_AT_ONCE)):
                content = pa.array([load(name) for name in piece.column(path).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*piece.columns, content], names=schema.names)

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // OBJECTS_A_TASK))
    return df.repartition(tasks, path).mapInArrow(fetch, schema)
