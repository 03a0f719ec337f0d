"""The queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import url_filter
from tidemark.llm.embedding_dedup import embedding_dedup
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language_id import detect, train
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.packing import pack
from tidemark.llm.registry import QUERIES, SQL, query, table
from tidemark.llm.sentencepiece_scan import decode, encode
from tidemark.llm.simhash import simhash_components
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.url_filter import Rule
from tidemark.llm.warc import read_records, write_bundles
from tidemark.llm.whitening import whiten
from tidemark.session import scratch_path

#: Ids that end a document.
WORD_END, BYTE_END = 2, 0

__all__ = ["QUERIES", "SQL"]


@query("op8_exact_dedup", r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
         g AS (SELECT norm, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op10_line_dedup", r"""
    WITH l AS (SELECT doc_id, pos, lines[pos] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
                      unnest(range(1, len(lines) + 1)) AS u(pos)),
         k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
         f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
         j AS (SELECT doc_id, pos, line, first_doc IS NOT NULL AND first_doc <> doc_id AS dropped FROM k LEFT JOIN f USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM j GROUP BY doc_id""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), "words", WORD_END)
    return read_token_files(spark, path)


@query("op5_warc", r"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
         g AS (SELECT payload, max(page_id) AS last FROM p GROUP BY payload HAVING octet_length(payload) >= 0),
         h AS (SELECT page_id, octet_length(p.payload) AS payload_bytes, sha1(p.payload) AS hex, CASE WHEN page_id < last THEN last END AS refers_to
               FROM p LEFT JOIN g ON p.payload = g.payload),
         b AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                   (('0x' || substr(hex, 1 + (i * 5) // 4, 2))::INT >> (3 - (i * 5) % 4)) & 31)::INT, 1)), '') AS payload_digest
               FROM (SELECT * REPLACE (hex || '0' AS hex) FROM h))
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM b""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    index = write_bundles(table(spark, sf_dir, "pages"), path)
    return read_records(spark, path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "bytes", BYTE_END).drop("boundary", "ids")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle_words=4)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return detect(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_spans")


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@query("op6_embedding_dedup")
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    done = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    size = (F.octet_length("piece_ids") / 4).cast("bigint")
    return done.select("doc_id", size.alias("n_tokens"), F.crc32("piece_ids").alias("ids_crc32"), "chunks", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), typo_every=97)


#: The rules of the query.
URL_RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]


@query("op12_url_filter")
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge(pages, model, URL_RULES).withColumnRenamed("id", "page_id")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
