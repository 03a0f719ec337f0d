"""Token ids of documents in binary files, in ascending order of the documents' ids.

One file per partition of a range partitioning by id: Simple-8b blocks (``simple8b``), then per-block offsets and sizes, then the documents with their
token counts. A block is decoded without those before it. Which id a document starts at in the whole corpus follows from one total per file.

File: 8 bytes magic; blocks, each its words and then its escapes (unsigned 64-bit, little-endian); block table (offset, ids, words,
escapes: 4 x 64 bits each); document table (id, 1 if the id is null, tokens: 3 x 64 bits each); count of blocks, count of documents, magic.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import simple8b
from tidemark.llm.files import create_file, open_file
from tidemark.llm.tokens import encoder, slices
from tidemark.session import create_small_text, qualified, read_small_text

MAGIC = b"tokens8b"
#: Blocks that are coded, or read, at a time.
TOGETHER = 256
PARTS = "part int, n_docs bigint, n_tokens bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, cut: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the ids under ``path``, which must not exist.

    A null text is empty, so it has ``end_id`` alone. Rows of equal id are separate documents, in the order of a hash of their texts. A null id comes first. An
    empty table gives no ids. Other columns are not read.
    """
    spark = docs.sparkSession
    path = qualified(spark, path)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer, cut)
        doc_table, blocks, waiting, size, total = [], [], [], 0, 0
        with create_file(f"{path}/part-{part:06d}.tok") as out:
            out.write(MAGIC)
            place = len(MAGIC)

            def flush(whole: bool) -> int:
                nonlocal waiting, place
                ids = np.concatenate(waiting) if waiting else np.zeros(0, np.uint64)
                cut_at = len(ids) if whole else len(ids) // simple8b.BLOCK * simple8b.BLOCK
                for n, words, escapes in simple8b.encode(ids[:cut_at]):
                    blocks.append((place, n, len(words), len(escapes)))
                    body = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
                    out.write(body)
                    place += len(body)
                waiting = [ids[cut_at:]]
                return len(ids) - cut_at

            for batch in batches:
                texts = batch.column("text")
                own = batch.column("id")
                for a, b in slices(pc.utf8_length(texts).to_numpy().tolist()):
                    ids, begins = encode.flat(texts.slice(a, b - a))
                    # Each document's end behind its ids.
                    waiting.append(np.insert(ids.astype(np.uint64), begins[1:], end_id))
                    docs = own.slice(a, b - a)
                    doc_table.append(np.stack([docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(begins) + 1], axis=1))
                    size += len(waiting[-1])
                    total += len(waiting[-1])
                    if size >= TOGETHER * simple8b.BLOCK:
                        size = flush(False)
            flush(True)
            out.write(np.array(blocks, "<i8").tobytes())
            n_docs = sum(map(len, doc_table))
            out.write(b"".join(t.astype("<i8").tobytes() for t in doc_table))
            out.write(np.array([len(blocks), n_docs], "<i8").tobytes() + MAGIC)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": pa.array([n_docs]), "n_tokens": pa.array([total])})

    totals = sorted(tuple(r) for r in ordered.mapInArrow(write, PARTS).collect())  # one row per file
    create_small_text(spark, f"{path}/files.json", json.dumps(totals))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    path = qualified(spark, path)
    totals = json.loads(read_small_text(spark, f"{path}/files.json"))
    begins = dict(zip([t[0] for t in totals], np.cumsum([0] + [t[2] for t in totals]).tolist()))
    parts = sorted(begins)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from _documents(f"{path}/part-{parts[i]:06d}.tok", begins[parts[i]])

    # One task per file; a task holds a few blocks at a time.
    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, ROWS)


def _documents(file: str, begin: int) -> Iterator[pa.RecordBatch]:
    with open_file(file) as source:
        end = source.size()
        source.seek(end - 16 - len(MAGIC))
        n_blocks, n_docs = (int(x) for x in np.frombuffer(source.read(16), "<i8"))
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{file} is not a whole token file")
        tables = end - 16 - len(MAGIC) - 32 * n_blocks - 24 * n_docs
        source.seek(tables)
        blocks = np.frombuffer(source.read(32 * n_blocks), "<i8").reshape(-1, 4)
        table = np.frombuffer(source.read(24 * n_docs), "<i8").reshape(-1, 3)
        lengths = table[:, 2]
        starts = begin + np.cumsum(lengths) - lengths
        left = np.zeros(0, np.uint32)
        doc, sums = 0, []
        for a in range(0, n_blocks, TOGETHER):
            left = np.concatenate([left, _decode(source, blocks[a : a + TOGETHER])])
            used = 0
            while doc < n_docs and used + lengths[doc] <= len(left):
                sums.append(zlib.crc32(left[used : used + lengths[doc]].tobytes()))
                used += int(lengths[doc])
                doc += 1
            left = left[used:]
        if doc != n_docs or len(left):
            raise ValueError(f"{file} has other ids than its document table")
    yield pa.RecordBatch.from_arrays(
        [pa.array(table[:, 0], mask=table[:, 1] == 1), pa.array(starts), pa.array(lengths), pa.array(np.array(sums, np.int64))],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def _decode(source, blocks: np.ndarray) -> np.ndarray:
    """Ids of some consecutive blocks."""
    source.seek(int(blocks[0, 0]))
    both = blocks[:, 2] + blocks[:, 3]
    body = np.frombuffer(source.read(8 * int(both.sum())), "<u8")
    is_word = np.arange(len(body)) - np.repeat(np.cumsum(both) - both, both) < np.repeat(blocks[:, 2], both)
    return simple8b.decode(blocks[:, 1], blocks[:, 2], body[is_word], blocks[:, 3], body[~is_word]).astype("<u4")
