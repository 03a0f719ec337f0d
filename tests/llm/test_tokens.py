"""Token files, packing and SentencePiece against the libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from plain import corpus
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import sentencepiece_scan as scan
from tidemark.llm import simple8b
from tidemark.llm.packing import pack, sequences
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.tokens import Encoder, slices
from tidemark.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    alphabet = [*"abdeé t.,'s  \n\tKİKÅ3#&<|>́ \x1c\0▁世", "<|endoftext|>", " <|endoftext|> ", "<|EndOfText|>", "<|startoftext|>."]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("path, cut", [(WORDS, "words"), (BYTES, "bytes"), (BYTES, "whole")])
def test_units_give_the_librarys_ids(path, cut):
    plain = library(path)
    texts = odd_texts(1500) + [t or "" for _, t in corpus()]
    for kept in (1_000_000, 0):  # with and without room for units
        encode = Encoder(path, cut, kept)
        for part in (texts[:800], texts[400:1200], texts):
            for text, ids in zip(part, encode.encode(part)):
                assert ids.tolist() == plain(text), repr(text)


def test_slices():
    assert list(slices([1, 1, 9, 1], 3)) == [(0, 2), (2, 3), (3, 4)] and list(slices([])) == []


@pytest.mark.parametrize("n", [0, 1, 59, 4095, 4096, 4097, 30_000])
def test_simple8b_round_trip(n):
    rnd = np.random.default_rng(n)
    width = rnd.integers(0, 64, n).astype(np.uint64)
    values = rnd.integers(0, 2**63, n).astype(np.uint64) >> width
    values[: n // 2] %= np.uint64(50_000)
    if n:
        values[-1] = 2**64 - 1
    blocks = simple8b.encode(values)
    sizes, words, escapes = (list(x) for x in zip(*blocks)) if blocks else ([], [], [])
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    got = simple8b.decode(np.array(sizes, int), np.array([len(w) for w in words], int), flat(words), np.array([len(e) for e in escapes], int), flat(escapes))
    assert (got == values).all() and len(got) == n
    # Each block on its own.
    for i, (size, w, e) in enumerate(blocks):
        one = simple8b.decode(np.array([size]), np.array([len(w)]), w, np.array([len(e)]), e)
        assert (one == values[i * simple8b.BLOCK : i * simple8b.BLOCK + size]).all()


def test_simple8b_takes_the_greatest_count():
    ((_, words, _),) = simple8b.encode(np.array([1] * 60 + [3, 70_000, 2**61], np.uint64))
    assert [int(w) >> 60 for w in words] == [0, 12, 14]


def test_token_files(spark, table):
    rows = corpus(5) + [(None, "no id")]
    path = scratch_path(spark, "tokens")
    write_token_files(table(rows), path, WORDS, "words", 2)
    plain = library(WORDS)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32) for r in read_token_files(spark, path).collect())
    assert sorted((k, n, c) for k, _, n, c in got) == sorted(
        ((d is not None, d or 0), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in ((d, plain(t) + [2]) for d, t in rows))
    # Null ids first, then ascending; starts are sums of what is before.
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == sorted(r[0] for r in got)
    assert [r[1] for r in by_start] == (np.cumsum([0] + [r[2] for r in by_start])[:-1]).tolist()


def test_token_files_of_nothing(spark, table):
    path = scratch_path(spark, "tokens")
    write_token_files(table([]), path, WORDS, "words", 2)
    assert read_token_files(spark, path).count() == 0


def test_packing(spark, table):
    rows = [r for r in corpus(6) if r[0] not in (10, 12)] + [(None, "no id")]
    pieces = pack(table(rows), BYTES, "bytes", 0, window=64)
    found = pieces.collect()
    plain = library(BYTES)
    want = {i: plain(t) + [0] for i, (_, t) in enumerate(rows)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append((r.start, r.length, bytes(r.ids)))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4
    for i, (d, _) in enumerate(rows):
        if sum(x == d for x, _ in rows) == 1:
            own = sorted(by_doc[d])
            assert b"".join(p[2] for p in own) == np.array(want[i], "<u4").tobytes()
            assert all(r.boundary == (len(own) > 1) and r.doc_tokens == len(want[i]) for r in found if r.doc_id == d)
    assert sum(r.length for r in found) == sum(map(len, want.values()))
    for k, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 if k < max(by_sequence) else 0 < at <= 64
    whole = {r.sequence_id: r for r in sequences(pieces, 64, pad_id=7).collect()}
    last = whole[max(whole)]
    assert all(len(r.ids) == 64 for k, r in whole.items() if k != max(whole))
    assert len(last.ids) == (last.n_tokens if last.n_tokens & (last.n_tokens - 1) == 0 else 64)
    assert pack(table([]), BYTES, "bytes", 0).count() == 0


def test_sentencepiece_scan_of_any_chunks():
    import sentencepiece

    model, lib = scan.pieces_of(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(2)
    for text in odd_texts(150, 3) + ["x" * 300, "internationalisation" * 20, "", "▁" * 40]:
        body, chunk, steps = model.normal(text), rnd.choice([1, 2, 5, 17, 60]), []
        for a in range(0, len(body), chunk):
            b, low = min(len(body), a + chunk), max(0, a - 2 * model.longest)
            steps.append((low, a - low, b - low, body[low : b + 2 * model.longest]))
        ids, before = [], None
        if steps:
            done = [scan.transfer(model, t, a, b, i == 0, i == len(steps) - 1) for i, (_, a, b, t) in enumerate(steps)]
            for (low, a, _, t), (_, exits, _), j in zip(steps, done, scan.best_states([m for _, _, m in done])):
                entry = (a, a) if before is None else (before[0] - low, before[1] - low)
                ids += scan.backtrace(model, t, entry, exits[j]).tolist()
                before = (exits[j][0] + low, exits[j][1] + low)
        assert ids == lib.encode(text), repr(text)
        assert model.encode([body])[0].tolist() == ids and model.decode(np.array(ids, int)) == lib.decode(ids)


def test_prefixes_are_products():
    rnd = np.random.default_rng(1)
    shapes = rnd.integers(1, 5, 8)
    matrices = [rnd.normal(size=(a, b)) for a, b in zip(shapes, shapes[1:])]
    total = matrices[0]
    for got, m in zip(scan.prefixes(matrices)[1:], matrices[1:]):
        total = scan.product(total, m)
        assert np.allclose(got, total)


def test_sentencepiece(table):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = corpus(7) + [(None, "no id")]
    got = scan.decode(scan.encode(table(rows), PIECES, chunk=200), PIECES).where("doc_id is null or doc_id not in (10, 12)")
    assert {"row", "doc", "Text2"} <= set(got.columns)
    want = sorted(((d, t, np.array(lib.encode(t or ""), "<u4").tobytes(), lib.decode(lib.encode(t or ""))) for d, t in rows if d not in (10, 12)), key=repr)
    assert sorted(((r.doc_id, r.text, bytes(r.piece_ids), r.decoded) for r in got.collect()), key=repr) == want
    assert got.agg(F.max("chunks")).first()[0] > 10
    assert scan.encode(table([]), PIECES).count() == 0
