"""Packing by concatenation and cutting.

Documents are encoded once, where they are, and stored with their partition and the ids before them in it (first pass). One total per partition,
summed along the partitions, gives each document its place in the one long sequence of all ids (second pass). Fixed windows over
that sequence are the packed sequences; a document that crosses a window's boundary gives a boundary record on either side. Ids
are never shuffled, and nothing but the totals is put in order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import KEPT_UNITS, encoder, slices
from tidemark.session import local_rows, settle

ENCODED = "doc_id bigint, part int, before bigint, doc_tokens bigint, ids binary"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
          "boundary boolean, ids binary")


def encode_documents(docs: DataFrame, tokenizer: str, cut: str, end_id: int, id_col: str, text_col: str, kept_units: int = KEPT_UNITS) -> DataFrame:
    """doc_id, part, before (ids before it in the partition), doc_tokens, ids (little-endian unsigned 32-bit); stored."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, cut, kept_units)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.utf8_length(texts).to_numpy().tolist()):
                ids, begins = encode.flat(texts.slice(a, b - a))
                # Each document's end behind its ids.
                ids = np.insert(ids.astype("<u4"), begins[1:], end_id)
                sizes = np.diff(begins) + 1
                ends = before + np.cumsum(sizes)
                bounds = pa.py_buffer((4 * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(ends - sizes), pa.array(sizes),
                    pa.Array.from_buffers(pa.binary(), b - a, [None, bounds, pa.py_buffer(ids)]),
                ], names=["doc_id", "part", "before", "doc_tokens", "ids"])
                before = int(ends[-1])

    return settle(rows.mapInArrow(encode, ENCODED), "encoded")


def with_starts(encoded: DataFrame) -> DataFrame:
    """Each document with ``begin``, the ids of all documents before it."""
    # One row per partition.
    totals = sorted(tuple(r) for r in encoded.groupBy("part").agg(F.sum("doc_tokens")).collect())
    begins = accumulate([0] + [t for _, t in totals])
    bases = local_rows(encoded.sparkSession, [(p, b) for (p, _), b in zip(totals, begins)], "part bigint, base bigint")
    return encoded.join(F.broadcast(bases), "part").withColumn("begin", F.col("base") + F.col("before"))


def pack(docs: DataFrame, tokenizer: str, cut: str, end_id: int, window: int = 1024, id_col: str = "doc_id", text_col: str = "text",
         kept_units: int = KEPT_UNITS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, boundary, ids.

    A document is the ids of its whole text and ``end_id``; a null or empty text is ``end_id`` alone. Pieces of one sequence follow each other
    from offset 0 without gaps; only the last sequence can have less than ``window`` ids. ``boundary`` says that the document goes on in another
    sequence. ``kept_units`` bounds what a worker remembers (see ``tokens``). Rows of equal id, or a null id, are separate documents. An empty table gives no rows. Other columns are not read.
    """
    placed = with_starts(encode_documents(docs, tokenizer, cut, end_id, id_col, text_col, kept_units)).select("doc_id", "begin", "doc_tokens", "ids")

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            first = begin // window
            count = (begin + size - 1) // window - first + 1
            for a, b in slices(size.tolist()):
                row = np.repeat(np.arange(a, b), count[a:b])
                sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
                start = np.maximum(sequence * window, begin[row])
                length = np.minimum((sequence + 1) * window, begin[row] + size[row]) - start
                inside = start - begin[row]
                ids, pieces, at = batch.column(3), [], -1
                for r, i, n in zip(row.tolist(), inside.tolist(), length.tolist()):
                    if r != at:
                        at, body = r, ids[r].as_py()
                    pieces.append(body[4 * i : 4 * (i + n)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row)), pa.array(inside), pa.array(length), pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                    pa.array(size[row]), pa.array(sequence), pa.array(start - sequence * window), pa.array(count[row] > 1), pa.array(pieces, pa.binary()),
                ], names=[c.split()[0] for c in PIECES.split(", ")])

    return placed.mapInArrow(cut_windows, PIECES)


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, ids (array), n_tokens; filled up to ``window`` unless their size is a power of two."""
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # at most ``window`` ids
    joined = whole.select("sequence_id", F.expr("aggregate(transform(parts, p -> p.ids), cast('' as binary), (a, b) -> concat(a, b))").alias("body"))

    @F.udf("array<bigint>")
    def filled(body):
        ids = np.frombuffer(bytes(body), "<u4").tolist()
        n = len(ids)
        return ids if n & (n - 1) == 0 else ids + [pad_id] * (window - n)

    return joined.select("sequence_id", filled("body").alias("ids"), (F.octet_length("body") / 4).cast("bigint").alias("n_tokens"))
