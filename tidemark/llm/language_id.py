"""Language ID: script ranges narrow the candidates, Viterbi over per-word scores with a switching penalty labels spans of mixed-language text.

A word is a run of letters. Its script (that of its first letter) leaves the languages that write in it; among these its score is the sum of log probabilities of its
hashed letter n-grams, with word ends, from a smoothed model. The best path over the words, where each change of language costs ``SWITCH``, gives the spans; the
language with most letters is the document's.

Training counts n-grams in tasks over a bounded sample of labelled rows (``per_lang`` rows of each language, chosen by a hash; whole texts); what comes to the driver is one
count per language and n-gram bucket, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import whole_row
from tidemark.llm.tokens import slices

#: Scripts and their code point ranges.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
UNKNOWN = "und"
#: What a change of language costs, in the unit of the scores (natural logarithms, times SCALE as n-grams overlap).
SWITCH, SCALE = 8.0, 0.4
#: Buckets of each n-gram length; a language writes in a script that holds this share of its letters.
BUCKETS, SCRIPT_SHARE, SMOOTH = 1 << 16, 0.01, 0.5
#: Outside its scripts a language has this score a word.
FOREIGN = -20.0
_SIZES = (2, 3, 4)
_NONE = BUCKETS * len(_SIZES)
_TABLES: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its script (0: another one)."""
    if not _TABLES:
        script = np.zeros(0x110000, np.uint8)
        for i, ranges in enumerate(SCRIPTS.values(), 1):
            for a, b in ranges:
                script[a : b + 1] = i
        _TABLES.extend([np.array([chr(i).isalpha() for i in range(0x110000)]), script])
    return _TABLES[0], _TABLES[1]


def lowered(text: str) -> str:
    """Lower case, code point by code point, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@dataclass
class Words:
    """Words of some texts: place of the first letter, letters, script; and the bounds of each text in places and in words."""

    start: np.ndarray
    size: np.ndarray
    script: np.ndarray
    places: np.ndarray
    bounds: np.ndarray
    grams: list[np.ndarray]


def words_of(texts: list[str]) -> Words:
    letters, scripts = tables()
    # One blank in front of each text and after the last, so that every word has both ends.
    codes = np.frombuffer((" " + " ".join(map(lowered, texts)) + "    ").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters[codes]
    places = np.cumsum([0, *[len(t) + 1 for t in texts]]) + 1
    change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = change[0::2], change[1::2]
    plain = np.where(letter, codes, 0).astype(np.uint64)
    n = len(codes) - 3
    grams = []
    for i, size in enumerate(_SIZES):
        mixed = np.zeros(n, np.uint64)
        for k in range(size):
            mixed = mixed * np.uint64(0x100000001B3) + plain[k : k + n]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        bucket = (mixed >> np.uint64(48)).astype(np.int64) + i * BUCKETS
        valid = letter[1 : 1 + n] if size > 2 else letter[:n] | letter[1 : 1 + n]
        if size > 3:
            valid = valid & letter[2 : 2 + n]
        bucket[~valid] = _NONE
        grams.append(bucket)
    return Words(start, end - start, scripts[codes[start]], places, np.searchsorted(start, places), grams)


@dataclass
class Model:
    """Learned languages in order, centred weights per bucket (last row: zero), and which language writes in which script."""

    langs: list[str]
    weights: np.ndarray
    scripts: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Words by languages. The n-grams of a word begin at the place before its first letter at the earliest."""
        if not len(words.start):
            return np.zeros((0, len(self.langs)), np.float32)
        sums = sum(self.weights[g] for g in words.grams)
        out = np.add.reduceat(sums, words.start - 1, axis=0)
        out[~self.scripts[words.script]] = FOREIGN
        out[~self.scripts[words.script].any(axis=1)] = 0  # a script of no learned language says nothing
        return out


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on the best path."""
    total = scores.sum(axis=0, dtype=np.float64)
    top = int(total.argmax())
    n, k = scores.shape
    if k == 1:
        return np.zeros(n, np.int64)
    # Leaving ``top`` for some words gains no more than the best stretch of gains; below the cost of one change the path stays.
    others = scores.copy()
    others[:, top] = -np.inf
    run = np.cumsum(others.max(axis=1).astype(np.float64) - scores[:, top])
    before = np.minimum.accumulate(np.concatenate([[0.0], run[:-1]]))
    if (run - before).max() <= switch:
        return np.full(n, top)
    now, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        best = max(now)
        at, moved = now.index(best), best - switch
        back.append([i if v >= moved else at for i, v in enumerate(now)])
        now = [(v if v >= moved else moved) + s for v, s in zip(now, row)]
    path = [now.index(max(now))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 5000) -> Model:
    """A model of the languages in ``lang_col``; rows without text or language are left out."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where("text is not null and lang is not null")
    # One row per language.
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((_NONE + 1, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    share = F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(min(1.0, per_lang / sizes[l])))])
    # Of a large language a share chosen by a hash of the row, so that copies of one text count as often as they occur.
    chance = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1_000_000)) / 1_000_000
    sample = rows.where(chance < share[F.col("lang")])
    number = {l: i for i, l in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(langs), _NONE + 1), np.int64)
        scripts = np.zeros((len(langs), len(SCRIPTS) + 1), np.int64)
        for batch in batches:
            texts, own = batch.column("text").to_pylist(), [number[l] for l in batch.column("lang").to_pylist()]
            for l in set(own):
                mine = [t for t, o in zip(texts, own) if o == l]
                for a, b in slices([len(t) for t in mine]):
                    words = words_of(mine[a:b])
                    for g in words.grams:
                        grams[l] += np.bincount(g, minlength=_NONE + 1)
                    scripts[l] += np.bincount(words.script, words.size, len(SCRIPTS) + 1).astype(np.int64)
        grams[:, _NONE] = 0
        both = np.hstack([grams, scripts])
        l, b = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(b), pa.array(both[l, b])], names=["lang", "bucket", "n"])

    counts = np.zeros((len(langs), _NONE + 1 + len(SCRIPTS) + 1))
    for r in sample.mapInArrow(count, "lang bigint, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r[0], r[1]] = r[2]
    weights = np.zeros((len(langs), _NONE + 1))
    for i in range(len(_SIZES)):
        own = slice(i * BUCKETS, (i + 1) * BUCKETS)
        part = counts[:, own] + SMOOTH
        weights[:, own] = np.log(part / part.sum(axis=1, keepdims=True))
    weights = SCALE * (weights - weights.mean(axis=0))
    letters = counts[:, _NONE + 1 :]
    scripts = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=1, keepdims=True), 1)
    return Model(langs, weights.T.astype(np.float32), (scripts & (letters > 0)).T)


def detect(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans.

    ``lang_pred`` is a learned language, or ``und`` if the text is null or has no letter (or nothing was learned); ``score`` is the share of the document's letters that are labelled so
    and are in a script of a learned language (0 for ``und``); ``lang_spans`` are (start, end, lang) in code points, first letter to behind the last, for consecutive words of one language. Ties go to
    the first language in order. Only the text is read. An empty table gives no rows. ``docs`` may have any columns; the three added ones are replaced.
    """
    added = ["lang_pred", "score", "lang_spans"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, whatever the corpus

    def label(batches):
        import pandas as pd

        model = shared.value
        for texts in batches:
            plain = [t or "" for t in texts]
            out = []
            for a, b in slices([len(t) for t in plain], 500_000):
                out += _labels(model, plain[a:b])
            yield pd.DataFrame(out, columns=added)

    apply = F.pandas_udf(label, "lang_pred string, score double, lang_spans array<struct<start:int,end:int,lang:string>>", F.PandasUDFType.SCALAR_ITER)
    # So that a filter on the result is not also evaluated below it, which would run the model twice.
    apply = apply.asNondeterministic()
    return docs.select(whole_row(docs, added), apply(F.col(f"`{text_col}`")).alias("out")).select("row.*", "out.*")


def _labels(model: Model, texts: list[str]) -> list[tuple]:
    words = words_of(texts)
    scores = model.scores(words)
    counted = words.size * model.scripts.any(axis=1)[words.script]  # the path labels a script of no learned language by its neighbours only
    out = []
    for i in range(len(texts)):
        a, b = words.bounds[i], words.bounds[i + 1]
        if a == b or not model.langs:
            out.append((UNKNOWN, 0.0, []))
            continue
        path = best_path(scores[a:b], SWITCH)
        size, start = words.size[a:b], words.start[a:b] - words.places[i]
        letters = np.bincount(path, counted[a:b], len(model.langs))
        top = int(letters.argmax())
        edges = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]])
        spans = [{"start": int(start[x]), "end": int(start[y - 1] + size[y - 1]), "lang": model.langs[path[x]]} for x, y in zip(edges, edges[1:])]
        out.append((model.langs[top], float(letters[top] / size.sum()), spans))
    return out
