"""Spelling variants of words: which words are one edit apart, and which of them is the usual form.

The words are indexed by grams of variable length. A gram of two code points is made longer, up to four, as long as it begins many words' places (``GramDictionary``):
common beginnings are told apart, rare ones stay short, and every list stays small. A word, with a mark at either end, is decomposed into the
gram that begins at each of its places. What a gram is depends only on the code points in it, so an edit changes just the grams that reach over its place; the most that
any one place has, a word's affected-gram bound, is at most four. All other grams of a word stand in every near word too, at the same place or one further.

So of a word's rarest grams, one more than its bound says, one at least is kept in each near word, and is among the rarest of that word as well: take the rarest gram
that the edit leaves alone; whatever is rarer in either word is affected. Only those few, shortest lists are merged, by equality of gram, place and length of
the word, and each pair that meets is verified. No near pair is lost, whatever the frequencies.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import release, settle

#: Marks before and behind a word; no letters.
BEGIN, END = "^", "$"
LEAST_GRAM, MOST_GRAM = 2, 4
#: A gram that begins this many places or fewer is not made longer.
SHORT_LIST = 64
#: Grams that are made longer: at most this many of each length, whatever the number of words.
MOST_LONGER = 50_000
#: Counters of how often grams occur.
SLOTS = 1 << 18
#: Different words that a task holds before it hands them on; bytes of text that it takes at a time.
HELD, WINDOW = 300_000, 8 << 20

# By byte of UTF-8: A-Z in lower case, what begins or goes on with a letter as it is, all else a blank. U+00C0 to U+00FF are C3 and one byte more.
_TABLE = np.full(256, 0x20, np.uint8)
for _b in [*range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]:
    _TABLE[_b] = _b
_TABLE[0x41:0x5B] = np.arange(0x61, 0x7B)
# crc32 of one more zero byte, by the lowest byte (CRC-32 of zlib: a fixed value, its polynomial).
_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _STEP = (_STEP >> 1) ^ np.where(_STEP & 1, np.uint32(0xEDB88320), np.uint32(0))
#: Runs of more bytes are checked one by one.
_USUAL = 48


def _windows(body: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a text buffer that end before an ASCII character that is no letter."""
    at = 0
    while at < len(body):
        stop = min(len(body), at + WINDOW)
        while stop < len(body):
            ahead = body[stop : stop + 4096]
            free = np.flatnonzero((ahead < 0x80) & (_TABLE[ahead] == 0x20))
            if len(free):
                stop += int(free[0])
                break
            stop += len(ahead)
        yield at, stop
        at = stop


def _runs(body: np.ndarray, begins: np.ndarray, least: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Runs of ``least`` code points or more, A-Z in lower case: the runs, the text that each is in, their bytes. ``begins``: where texts begin."""
    low = _TABLE[body]
    inner = (low & 0xC0) == 0x80
    inner[1:] &= body[:-1] == 0xC3
    inner[:1] = False
    letter = (low != 0x20) & ((low < 0x80) | (low == 0xC3) | inner)
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    own = begins[(begins > 0) & (begins < len(body))]
    first[own] = letter[own]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    last[own - 1] = letter[own - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    points = np.concatenate([[0], np.cumsum(~inner)])
    enough = points[stops] - points[starts] >= least
    starts, stops = starts[enough], stops[enough]
    sizes = stops - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    kept = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(low[kept]))
    return found, np.searchsorted(begins, starts, "right") - 1, sizes


def _typos(docs: list[str], runs: list[bytes], which: np.ndarray, doc: np.ndarray, sizes: np.ndarray, every: int) -> Iterator[tuple[int, str]]:
    """Occurrences whose crc32 of ``<id>:<run>`` is a multiple of ``every``: the run's number and what is left of it.

    The crc32 of two strings is that of the second, and that of the first with as many zero bytes behind it, exclusive or; so each id and each run is summed once.
    """
    ids = np.array([zlib.crc32(f"{d}:".encode()) for d in docs], np.uint32)
    shifted = [ids]
    for _ in range(_USUAL):
        shifted.append((shifted[-1] >> 8) ^ _STEP[shifted[-1] & 0xFF])
    table, sums = np.array(shifted), np.array([zlib.crc32(r) for r in runs], np.uint32)
    h = table[np.minimum(sizes, _USUAL), doc] ^ sums[which]
    for i in np.flatnonzero(sizes > _USUAL).tolist():
        h[i] = zlib.crc32(runs[which[i]], int(ids[doc[i]]))
    for i in np.flatnonzero(h % every == 0).tolist():
        run = runs[which[i]].decode("utf-8")
        gone = int(h[i]) % len(run)
        yield int(which[i]), run[:gone] + run[gone + 1 :]


def _listed(strings: pa.StringArray) -> list[bytes]:
    """The strings of an array, which is no slice."""
    raw, at = strings.buffers()[2].to_pybytes() if len(strings) else b"", np.frombuffer(strings.buffers()[1], np.int32)[: len(strings) + 1].tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def _added(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, typo_every: int | None = None) -> DataFrame:
    """word, n: runs of letters, A-Z in lower case, of ``least_length`` code points or more that occur ``least_count`` times or more in all texts.

    ``typo_every`` makes typing errors for trials: h is the crc32 of ``<id>:<run>``, and where it is a multiple of ``typo_every`` the run loses its code point
    number h modulo its length. A null id is an empty one there. A null text has no words. Rows of equal id count each. Other columns are not read. Words are counted
    in every task before they are shuffled.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("doc"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    least = max(1, least_length)

    def counted(docs: list[str], body: np.ndarray, begins: np.ndarray) -> pa.Table:
        found, doc, sizes = _runs(body, begins, least)
        coded = found.dictionary_encode()
        which, runs = coded.indices.to_numpy(), coded.dictionary
        counts = np.bincount(which, minlength=len(runs))
        new: list[str] = []
        if typo_every and len(runs):
            for i, left in _typos(docs, _listed(runs), which, doc, sizes, typo_every):
                counts[i] -= 1
                if len(left) >= least:
                    new.append(left)
        words = pa.concat_arrays([runs, pa.array(new, pa.string())])
        return pa.table([words, pa.array(np.concatenate([counts, np.ones(len(new), np.int64)]))], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            begins = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begins[0] : begins[-1]]
            begins, docs = begins[:-1] - begins[0], batch.column(0).to_pylist()
            for a, b in _windows(body):
                held.append(counted(docs, body[a:b], begins - a))
                size += len(held[-1])
                if size > HELD:
                    held = [_added(held)]
                    size = len(held[0])
                    if size > HELD // 2:
                        yield from held.pop().to_batches()
                        size = 0
        if held:
            yield from _added(held).to_batches()

    found = rows.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


@dataclass(frozen=True)
class GramDictionary:
    """Which grams are made longer. All others of their places' grams, as they are, make up the dictionary."""

    longer: frozenset[str]

    def decompose(self, word: str) -> list[str]:
        """The gram that begins at each place of a word and its marks."""
        marked, longer, out = f"{BEGIN}{word}{END}", self.longer, []
        for p in range(len(marked) - LEAST_GRAM + 1):
            q = LEAST_GRAM
            gram = marked[p : p + q]
            while q < MOST_GRAM and p + q < len(marked) and gram in longer:
                q += 1
                gram = marked[p : p + q]
            out.append(gram)
        return out


def affected(grams: list[str]) -> int:
    """The affected-gram bound of a word: how many grams, at most, reach over one of its letters."""
    n = len(grams)
    over = [0] * (n + MOST_GRAM)
    for p, gram in enumerate(grams):
        for i in range(max(p, 1), min(p + len(gram), n)):
            over[i] += 1
    return max(over)


def gram_dictionary(words: DataFrame) -> GramDictionary:
    """Grams that begin many places are made longer. Their number is bounded, since all places together are shared among them."""
    places = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    least = max(SHORT_LIST, -(-places // MOST_LONGER))
    marked = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("w"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch in batches:
            for w in batch.column(0):
                w = w.as_py()
                for q in range(LEAST_GRAM, MOST_GRAM):
                    for p in range(len(w) - q + 1):
                        gram = w[p : p + q]
                        totals[gram] = totals.get(gram, 0) + 1
            if len(totals) >= HELD:
                yield pa.RecordBatch.from_pydict({"gram": list(totals.keys()), "n": list(totals.values())})
                totals = {}
        if totals:
            yield pa.RecordBatch.from_pydict({"gram": list(totals.keys()), "n": list(totals.values())})

    many = marked.mapInArrow(grams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    return GramDictionary(frozenset(r["gram"] for r in many.select("gram").collect()))  # at most MOST_LONGER of each length


def _slot(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8")) % SLOTS


def _frequencies(numbered: DataFrame, dictionary: Broadcast) -> np.ndarray:
    """How many places have the grams of each slot. Any order of grams would do; this one, with few slots met twice, brings short lists to the front."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for words in _some(batch.column(0), 2000):
                grams = pc.value_counts(pa.array([g for w in words for g in dictionary.value.decompose(w)]))
                np.add.at(totals, [_slot(g) for g in grams.field(0).to_pylist()], grams.field(1).to_numpy())
        own = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(totals[own])], names=["slot", "n"])

    counts = numbered.select("word").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(SLOTS, np.int64)
    for slot, n in counts.collect():  # at most SLOTS
        out[slot] = n
    return out


def _some(words: pa.Array, size: int) -> Iterator[list[str]]:
    for i in range(0, len(words), size):
        yield words.slice(i, size).to_pylist()


def _lists(numbered: DataFrame, dictionary: Broadcast, frequencies: np.ndarray) -> DataFrame:
    """wid, word, gram, place, size: the rarest grams of each word, one more than its affected-gram bound."""
    shared = numbered.sparkSession.sparkContext.broadcast(frequencies)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        for batch in batches:
            wids, at = batch.column(0).to_pylist(), 0
            for words in _some(batch.column(1), 10_000):
                columns: list[list] = [[], [], [], [], []]
                for wid, word in zip(wids[at : at + len(words)], words):
                    grams = dictionary.value.decompose(word)
                    ranked = heapq.nsmallest(affected(grams) + 1, ((freq[_slot(g)], g, p) for p, g in enumerate(grams)))
                    n = len(ranked)
                    for c, values in zip(columns, ([wid] * n, [word] * n, [g for _, g, _ in ranked], [p for _, _, p in ranked], [len(word)] * n)):
                        c.extend(values)
                at += len(words)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["wid", "word", "gram", "place", "size"])

    return numbered.select("wid", "word").mapInArrow(rarest, "wid bigint, word string, gram string, place int, size int")


def _halves(gap: int, *names: str) -> list[Column]:
    """Hashes of a word's halves, as a word of ``gap`` code points fewer has them before and behind an edit."""
    half = ((F.col("size") - gap) / 2).cast("int")
    halves = F.hash(F.substring(F.col("word"), F.lit(1), half)), F.hash(F.substring(F.col("word"), half + 1 + gap, F.col("size")))
    return [h.alias(n) for h, n in zip(halves, names)] if names else list(halves)


def _letters(word: Column) -> Column:
    """A set of letters as bits (by code point modulo 64); one edit changes two at most."""
    points = F.transform(F.filter(F.split(word, ""), lambda c: c != ""), lambda c: F.ascii(c) % 64)
    return F.aggregate(points, F.lit(0).cast("bigint"), lambda a, p: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), p)))


def _met(lists: DataFrame) -> DataFrame:
    """a, a_word, b, b_word: words that stand in the same list and may be near, the longer one as b; a pair as often as it does."""
    word, size, place, gram = (F.col(c) for c in ("word", "size", "place", "gram"))

    def entries(longer: int) -> Column:
        """Where a word stands in the lists of the words that have ``longer`` code points more.

        An edit lies behind a kept gram, and all to the gram's end is equal, or before it, and all from its begin is. So every list is cut up by that.
        """
        before = F.xxhash64(F.lit(0), size + longer, place, gram, F.substring(word, F.lit(1), place + F.char_length(gram) - 1))
        behind = F.xxhash64(F.lit(1), size + longer, size - place, gram, F.substring(word, place, size))
        # No edit lies before the first gram, or behind the last ones.
        return F.array_compact(F.array(F.when(~gram.endswith(END), before), F.when(place > 0, behind)))

    own = lists.select(F.explode(entries(0)).alias("list"), F.col("wid").alias("b"), word.alias("b_word"), F.col("letters").alias("b_letters"), F.array(*_halves(0), *_halves(1)).alias("b_halves"))
    role = F.array(*[F.struct(F.lit(longer).alias("longer"), entries(longer).alias("lists")) for longer in (0, 1)])
    asked = lists.select(F.explode(role).alias("e"), F.col("wid").alias("a"), word.alias("a_word"), F.col("letters").alias("a_letters"), *_halves(0, "a_left", "a_right"))
    met = asked.select(F.explode("e.lists").alias("list"), "e.longer", "a", "a_word", "a_letters", "a_left", "a_right").join(own, "list")
    # An edit changes two letters at most, and leaves one half alone: only words that agree in that are compared whole.
    same = (F.col("a_left") == F.get("b_halves", 2 * F.col("longer"))) | (F.col("a_right") == F.get("b_halves", 2 * F.col("longer") + 1))
    return met.where((F.col("longer") == 1) | (F.col("a") < F.col("b"))).where(F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2).where(same)


def near_pairs(numbered: DataFrame) -> DataFrame:
    """a, b (wid): each pair of words that differ by one inserted, deleted or replaced code point, once. ``numbered``: wid, word."""
    dictionary = numbered.sparkSession.sparkContext.broadcast(gram_dictionary(numbered))
    lists = settle(_lists(numbered, dictionary, _frequencies(numbered, dictionary)).withColumn("letters", _letters(F.col("word"))), "gram-lists")
    pairs = settle(_met(lists).where(F.levenshtein("a_word", "b_word", 1) == 1).select("a", "b").distinct(), "near-words")
    release(lists)
    return pairs


def _roots(links: DataFrame) -> DataFrame:
    """wid, root: where the links from each word end. ``links``: wid, to; each leads to a word with at least twice the count, so paths are short and end."""
    now = settle(links.select("wid", F.col("to").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").limit(1).isEmpty():
        on = now.select(F.col("wid").alias("at"), F.col("root").alias("further"))
        new = now.join(on, F.col("root") == F.col("at"), "left").select("wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = settle(new, "roots")
        release(now)
        now = new
    return now.select("wid", "root")


def group_variants(words: DataFrame, ratio: float = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of the distinct ``words`` (word, n; not null, without the marks ``^`` and ``$``, of four code points or more).

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form is its near word of largest n, of several the first in the order of
    code points, if that n is at least ``ratio`` times the word's own; else null. root: the last word that forms lead to, the word itself if it has none. No words give no rows.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than the word, or forms could lead in a circle")
    numbered = settle(words.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "words")
    pairs = near_pairs(numbered)
    both = pairs.select(F.col("a").alias("wid"), F.col("b").alias("to")).unionByName(pairs.select(F.col("b").alias("wid"), F.col("a").alias("to")))
    others = numbered.select(F.col("wid").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = both.join(others, "to").groupBy("wid").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("least"), F.col("form"), F.col("to"))).alias("best"))
    judged = numbered.join(best, "wid", "left").withColumn("has", F.coalesce(-F.col("best.least") >= ratio * F.col("n"), F.lit(False)))
    judged = settle(judged.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[
        F.when(F.col("has"), c).alias(name) for c, name in ((F.col("best.form"), "form"), (-F.col("best.least"), "form_n"), (F.col("best.to"), "to"))]), "judged")
    roots = _roots(judged.where("to IS NOT NULL").select("wid", "to"))
    ends = roots.join(numbered.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    return judged.join(ends, "wid", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, ratio: float = 2,
                      typo_every: int | None = None) -> DataFrame:
    """``group_variants`` of ``count_words``; see there for nulls, repeated rows and empty tables."""
    return group_variants(count_words(docs, id_col, text_col, least_length, least_count, typo_every), ratio)
