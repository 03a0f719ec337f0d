"""From documents to packed training sequences: language ID, line dedup, SimHash near-dedup, substring dedup, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``: doc_id, text, lang, source, n_chars (the code points of the text as it is then). Further columns of the input, whatever their names, end at
the first stage; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import UNKNOWN, detect, train
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.near_copies import simhash_dedup
from tidemark.llm.packing import pack
from tidemark.llm.registry import small_batches
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if less than this share of its letters is in its main language.
LEAST_SHARE = 0.34
END_ID = 0
#: Units of text that a worker remembers while it packs; the memory of a long-running executor is shared with its other stages.
KEPT_UNITS = 200_000


def _with_text(docs: DataFrame, text) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and a main language, with that language in ``lang``; a model is learned from the labelled ones.

    Null texts and texts without letters go, and so does every text if none has a label. Repeated rows are judged one by one and stay so; of languages with equal shares
    the first in order is the main one.
    """
    small_batches(spark)
    found = detect(docs.select(*COLUMNS), train(docs))
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id has; null texts become empty.

    No document goes, also if all its lines do. Rows of equal id are one document and keep the lines they share; a null id comes after all others.
    """
    small_batches(spark)
    return _with_text(line_dedup(docs.select(*COLUMNS)), F.col("kept_text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: five-word shingles, a similarity of at least 0.8.

    Texts without words, null ones included, are copies of each other. Rows that repeat the id that stays, and belong to the same group, all stay; a null id comes after all others.
    """
    small_batches(spark)
    return simhash_dedup(docs.select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that a document with a smaller id has. Texts that lose nothing stay as they are.

    No document goes; null texts become empty. Rows of equal id are one document and keep what they share; a null id comes after all others.
    """
    small_batches(spark)
    found = substring_dedup(docs.select(*COLUMNS))
    return _with_text(found, F.when(F.col("n_removed") > 0, F.col("kept_words")).otherwise(F.coalesce("text", F.lit(""))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, boundary, ids.

    A null or empty text is the end id alone. Rows of equal id, or without one, are packed as documents of their own.
    """
    small_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), "bytes", END_ID, kept_units=KEPT_UNITS)


STAGES = [
    ("language ID", identify_language), ("line dedup", drop_repeated_lines), ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages), ("packing", pack_sequences),
]
#: SQL cannot express the stages; tests/llm/test_pipeline.py compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
