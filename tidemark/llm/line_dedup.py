"""Line dedup: hashes in a range-partitioned order, first occurrences streamed, keep bitmaps returned instead of text.

1. Each line of at least ``min_chars`` code points becomes (128-bit hash of its key, document, position); stored once, because a range partitioning reads
   its input twice.
2. These rows are range-partitioned by hash, document and position and sorted in each partition. The document is part of the range, so a
   line that a third of all documents hold is cut into as many partitions as its rows need.
3. Each partition is streamed: in the run of a hash the first row names the smallest document, rows of other documents are drops. A
   run that began in an earlier partition is decided afterwards from one summary row per partition.
4. Drops of one document become one compressed bitmap.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import local_rows, settle

SPACE = b" \t\n\x0b\x0c\r"
LINES = "h1 bigint, h2 bigint, doc bigint, version bigint, pos int"
FOUND = "part int, kind int, h1 bigint, h2 bigint, doc bigint, version bigint, pos int, own_first bigint"
DROP, OPEN, SUMMARY = 0, 1, 2
#: The document key of a null id: after all others.
NO_ID = 2**63 - 1


def line_key(line: bytes) -> bytes:
    """White space at both ends removed, A-Z in lower case."""
    return line.strip(SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)


def keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """doc, version, text. ``version`` tells rows apart that share an id."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"), *more)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            parts, positions, counts = [], [], []
            for text in batch.column("text"):
                before = len(parts)
                for pos, line in enumerate(text.as_py().encode("utf-8").split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        parts.append(digest(key))
                        positions.append(pos)
                counts.append(len(parts) - before)
            both = np.frombuffer(b"".join(parts), dtype="<i8").reshape(-1, 2)
            repeat = np.array(counts, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.repeat(batch.column("doc").to_numpy(zero_copy_only=False), repeat)),
                pa.array(np.repeat(batch.column("version").to_numpy(zero_copy_only=False), repeat)), pa.array(positions, pa.int32()),
            ], names=["h1", "h2", "doc", "version", "pos"])

    return docs.mapInArrow(hashes, LINES)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops of one sorted partition; rows of its leading run, which may have begun earlier, are left open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    head = None  # hash of the leading run
    head_first = first = 0
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, version, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if head is None:
            head, head_first = (int(h1[0]), int(h2[0])), int(doc[0])
        starts = np.empty(len(h1), bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts[0] = last != (int(h1[0]), int(h2[0]))
        at = np.maximum.accumulate(np.where(starts, np.arange(len(h1)), -1))
        firsts = np.where(at >= 0, doc[np.maximum(at, 0)], first)
        leading = (h1 == head[0]) & (h2 == head[1])
        keep = leading | (doc != firsts)
        if keep.any():
            n = int(keep.sum())
            yield _found(part, np.where(leading[keep], OPEN, DROP), h1[keep], h2[keep], doc[keep], version[keep], pos[keep], firsts[keep], n)
        last, first = (int(h1[-1]), int(h2[-1])), int(firsts[-1])
    if head is not None:
        # One row for the leading run (pos 0) and one for the last run (pos 1): hash and first document.
        both = np.array([head, last], dtype=np.int64)
        yield _found(part, np.full(2, SUMMARY), both[:, 0], both[:, 1], np.array([head_first, first]), np.zeros(2, np.int64), np.arange(2), np.zeros(2, np.int64), 2)


def _found(part, kind, h1, h2, doc, version, pos, own_first, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, part, np.int32)), pa.array(np.asarray(kind, np.int32)), pa.array(h1), pa.array(h2), pa.array(doc), pa.array(version),
        pa.array(np.asarray(pos, np.int32)), pa.array(own_first),
    ], names=["part", "kind", "h1", "h2", "doc", "version", "pos", "own_first"])


def carried(summaries: list[tuple]) -> list[tuple[int, int]]:
    """(part, first document of the run that this partition's leading run continues). ``summaries``: part, pos, h1, h2, doc; in order."""
    out, last, first = [], None, 0
    for i in range(0, len(summaries), 2):
        (part, _, a1, a2, _), (_, _, b1, b2, end_first) = summaries[i], summaries[i + 1]
        continues = last == (a1, a2)
        if continues:
            out.append((part, first))
        one_run = (a1, a2) == (b1, b2)
        first = first if continues and one_run else end_first
        last = (b1, b2)
    return out


def dropped_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, version, pos of the lines to drop. ``docs`` as of ``keyed``."""
    spark = docs.sparkSession
    lines = settle(line_hashes(docs, min_chars), "line-hashes")
    order = ["h1", "h2", "doc", "pos"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = settle(lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_stream, FOUND), "line-runs")
    # Two rows per partition.
    rows = found.where(F.col("kind") == SUMMARY).select("part", "pos", "h1", "h2", "doc").orderBy("part", "pos").collect()
    carry = local_rows(spark, carried([tuple(r) for r in rows]), "part bigint, carried bigint")
    opened = found.where(F.col("kind") == OPEN).join(F.broadcast(carry), "part", "left").where(F.col("doc") != F.coalesce("carried", "own_first"))
    return found.where(F.col("kind") == DROP).select("doc", "version", "pos").unionByName(opened.select("doc", "version", "pos"))


def pack_bitmap(positions: np.ndarray) -> bytes:
    """Compressed keep bits, one per line up to the last dropped one; lines beyond it are kept."""
    keep = np.ones(8 * (int(positions.max()) // 8 + 1), np.uint8)
    keep[positions] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    keep = np.ones(n_lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    keep[: len(bits)] = bits
    return keep


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """doc, version, keep_bitmap of documents that lose lines (see ``line_dedup`` for the rules)."""
    drops = dropped_lines(keyed(docs, id_col, text_col), min_chars)
    packed = F.udf(lambda p: pack_bitmap(np.array(p, dtype=np.int64)), "binary")
    # A document's own positions: never more than the lines of one text.
    return drops.groupBy("doc", "version").agg(F.collect_set("pos").alias("pos")).select("doc", "version", packed("pos").alias("keep_bitmap"))


def _apply(texts: pd.Series, bitmaps: pd.Series) -> pd.DataFrame:
    out = []
    for text, bitmap in zip(texts, bitmaps):
        if bitmap is None:
            out.append((text.count("\n") + 1, 0, text))
            continue
        lines = text.split("\n")
        keep = unpack_bitmap(bitmap, len(lines))
        out.append((len(lines), int((~keep).sum()), "\n".join(line for line, k in zip(lines, keep) if k)))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept_text"])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with keep_bitmap, n_lines, n_dropped and kept_text.

    Texts are split at ``\\n``. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. A key of at least
    ``min_chars`` code points that at least two documents hold loses its lines in all but the smallest id. A null or empty text is one
    empty line. A null id comes after all others, as one document. Rows of equal id count as one document, and each gets its own
    bitmap. An empty table gives no rows. ``docs`` may have any further columns, except the four that are added, which are replaced.
    """
    added = ["keep_bitmap", "n_lines", "n_dropped", "kept_text"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row")
    # Other columns travel inside one struct, so that their names clash with nothing.
    left = keyed(docs, id_col, text_col, row)
    joined = left.join(keep_bitmaps(docs, id_col, text_col, min_chars), ["doc", "version"], "left")
    apply = F.pandas_udf(_apply, "n_lines bigint, n_dropped bigint, kept_text string")
    done = joined.select("row", "keep_bitmap", apply("text", "keep_bitmap").alias("out"))
    return done.select("row.*", "keep_bitmap", "out.n_lines", "out.n_dropped", "out.kept_text")
