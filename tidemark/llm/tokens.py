"""Token ids of whole texts by the tokenizers library, for use inside tasks.

A text is cut at places that are token boundaries for certain, and each distinct unit is encoded once per worker. Which places are certain
depends on the tokenizer (see below). Texts are cut, and units told apart, by Arrow for many texts at a time; their ids are gathered with numpy. Units that are one plain word
are encoded many at a time, as one text whose ids are told apart by their tokens: the library spends more on a call than on a word. A full stop or comma behind
letters and before white space is a token of its own.

``words``
    White space is dropped by the pre-tokenizer, so a blank or a line feed always ends a token.
``bytes``
    A byte-level pre-tokenizer puts one blank before the word that follows. A blank or a line feed without other white space next to it
    always begins a token, and a line feed always ends one.
``whole``
    No cutting; for other tokenizers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker keeps: those that it has met in two slices of texts. Others are encoded once per slice.
KEPT_UNITS = 1_000_000
#: Code points of text that are encoded together.
SLICE = 2_000_000

# White space of Python, as a character class of Arrow's regular expressions.
_SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_CROWDED = rf"[{_SPACE}][ \n]|[ \n][{_SPACE}]"
_SURE = rf"([^{_SPACE}]) ([^{_SPACE}])"
# Letters that stay letters when they are normalised and put in lower case, and such a letter with a full stop or comma that ends a unit.
_LETTER = r"A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\x{12F}"
_MARKED = rf"([{_LETTER}])([.,])( |\n|\z)"
_PLAIN = rf"\A ?[{_LETTER}]+\z"


def _words(texts: pa.Array) -> pa.ListArray:
    return pc.split_pattern(pc.replace_substring(pc.replace_substring_regex(texts, _MARKED, r"\1 \2\3"), "\n", " "), " ")


def _bytes(texts: pa.Array) -> pa.ListArray:
    """Units of texts without the character 0, which marks where one begins, so that the blank stays with its word."""
    marked = pc.replace_substring_regex(texts, _MARKED, "\\1\0\\2\\3")
    marked = pc.replace_substring(pc.replace_substring(marked, " ", "\0 "), "\n", "\0\n\0")
    crowded = pc.match_substring_regex(texts, _CROWDED)
    if pc.any(crowded).as_py():
        # A letter ends one match at most, so not every sure place is found; larger units are as good.
        marked = pc.replace_with_mask(marked, crowded, pc.replace_substring_regex(texts.filter(crowded), _SURE, "\\1\0 \\2"))
    return pc.split_pattern(marked, "\0")


_CUTS = {"words": _words, "bytes": _bytes}
_MADE: dict[tuple[str, str, int], "Encoder"] = {}


class Memo:
    """Ids (bytes) of units, kept from slice to slice if they come again; most different units never do."""

    _now: list["Memo"] = []

    def __init__(self, make: Callable[[set[str]], dict[str, bytes]], most: int):
        self.make, self.most = make, most
        self.kept: dict[str, bytes] = {"": b""}
        self.met = bytearray(1 << 22)

    def forget(self) -> None:
        self.kept = {"": b""}

    def join(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of each list of units, one after the other."""
        if Memo._now != [self]:
            take_over(self)
        known, met, last = self.kept, self.met, len(self.met) - 1
        fresh = set().union(*cut).difference(known)
        added = self.make(fresh) if fresh else {}
        room = self.most - len(known)
        known.update(added)
        get = known.__getitem__
        out = [b"".join(map(get, units)) for units in cut]
        for unit in added:
            at = hash(unit) & last
            if met[at] and room > 0:
                room -= 1
            else:
                met[at] = 1
                del known[unit]
        return out


def take_over(memo) -> None:
    """One memo per worker: what an earlier operator has left is given up."""
    for other in Memo._now:
        other.forget()
    Memo._now[:] = [memo]


class Pool:
    """Ids of units in one array, each unit known by where its ids begin and how many they are; kept as those of ``Memo``.

    ``make`` gives the ids of some units, one after the other, and how many each has.
    """

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int, kind: np.dtype):
        self.make, self.most, self.kind = make, most, kind
        self.met = np.zeros(1 << 22, bool)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begins, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)

    def gather(self, units: list[bytes], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``units`` (all different) in some order, and how many ids end with each one of that order."""
        if Memo._now != [self]:
            take_over(self)
        get = self.known.get
        at = np.array([get(u, -1) for u in units], np.int64)
        old, fresh = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        begins, sizes, pool = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), self.ids
        begins[old], sizes[old] = self.begins[at[old]], self.sizes[at[old]]
        if len(fresh):
            named = [units[i] for i in fresh.tolist()]
            made, sizes[fresh] = self.make(named)
            pool = np.concatenate([pool, made])
            begins[fresh] = len(self.ids) + np.cumsum(sizes[fresh]) - sizes[fresh]
            self._keep(named, pool, begins[fresh], sizes[fresh])
        sizes, begins = sizes[order], begins[order]
        ends = np.cumsum(sizes)
        return pool[_ranges(begins, sizes)], ends

    def _keep(self, units: list[bytes], pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> None:
        slots = np.fromiter(map(hash, units), np.int64, len(units)) & (len(self.met) - 1)
        again = np.flatnonzero(self.met[slots])[: max(0, self.most - len(self.known))]
        self.met[slots] = True
        if len(again):
            self.known.update(zip([units[i] for i in again.tolist()], range(len(self.begins), len(self.begins) + len(again))))
            sizes, begins = sizes[again], begins[again]
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, pool[_ranges(begins, sizes)]])


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


_TOGETHER = 500


class Encoder:
    """Texts to ids. A special token's text becomes that token, as the library has it; it lies within one unit."""

    def __init__(self, path: str, cut: str, kept_units: int = KEPT_UNITS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A text with white space in it could lie in several units.
        self.how = "whole" if any(len(t.split()) != 1 or t.split()[0] != t for t in special) else cut
        self.special = "(?i)" + "|".join(map(re.escape, special)) if special else None
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2") if size <= 65536 else np.dtype("<u4")
        self.pool = Pool(self._fresh, kept_units, self.kind)
        # Tokens that end a word, begin one with its blank, and that are a line feed.
        self.ends, self.blanks, self.feeds = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
        for token, i in vocabulary.items():
            self.ends[i], self.blanks[i], self.feeds[i] = token.endswith("</w>"), token.startswith("\u0120"), token == "\u010a"

    def _each(self, units: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _plain(self, words: list[bytes], glue: bytes, flags: np.ndarray, shift: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Plain words, many in one text; ``flags`` marks the last id of each (shift 1), its first id (shift 0), or what stands between (shift -1)."""
        bodies, counts = [], []
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        for group, ids in zip(groups, self._each([glue.join(g).decode("utf-8") for g in groups])):
            at = np.flatnonzero(flags[ids])
            if shift > 0:
                sizes, whole = np.diff(at, prepend=-1), len(at) and at[-1] == len(ids) - 1
            elif shift == 0:
                sizes, whole = np.diff(at, append=len(ids)), len(at) and at[0] == 0
            else:
                sizes, whole, ids = np.diff(at, prepend=-1, append=len(ids)) - 1, True, ids[~flags[ids]]
            if not whole or len(sizes) != len(group):
                each = self._each([w.decode("utf-8") for w in group])
                ids, sizes = np.concatenate(each), np.array([len(x) for x in each])
            bodies.append(ids)
            counts.append(sizes)
        return bodies, counts

    def _fresh(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are not kept, and how many each has."""
        byte = self.how == "bytes"
        plain = pc.match_substring_regex(pa.array(units, pa.binary()).cast(pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        led = np.fromiter((u[:1] == b" " for u in units), bool, len(units))
        kinds = [np.flatnonzero(plain & ~led), np.flatnonzero(plain & led), np.flatnonzero(~plain)]
        named = [[units[i] for i in k.tolist()] for k in kinds]
        parts = [self._plain(named[0], b"\n", self.feeds, -1) if byte else self._plain(named[0], b" ", self.ends, 1), self._plain(named[1], b"", self.blanks, 0)]
        other = self._each([u.decode("utf-8") for u in named[2]])
        parts.append((other, [np.array([len(x) for x in other], np.int64)]))
        ids = np.concatenate([np.zeros(0, self.kind), *[x for bodies, _ in parts for x in bodies]])
        found = np.concatenate([np.zeros(0, np.int64), *[x for _, counts in parts for x in counts]])
        # Back in the order of the units.
        sizes, begins = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        order = np.concatenate(kinds)
        sizes[order], begins[order] = found, np.cumsum(found) - found
        return ids[_ranges(begins, sizes)], sizes

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin, with the end of the last. ``texts``: strings, not null."""
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring(texts, "\0") if self.how == "bytes" else None
        if self.how == "whole" or (odd is not None and pc.any(odd).as_py()):
            return self._one_by_one(texts)
        lists = _CUTS[self.how](texts)
        coded = lists.values.dictionary_encode()
        units, order = coded.dictionary, coded.indices.to_numpy()
        if self.how == "words":
            # The tokenizer takes ASCII letters in lower case, except in special tokens.
            low = pc.string_is_ascii(units)
            if self.special:
                low = pc.and_not(low, pc.match_substring_regex(units, self.special))
            again = pc.if_else(low, pc.ascii_lower(units), units).dictionary_encode()
            units, order = again.dictionary, again.indices.to_numpy()[order]
        ids, ends = self.pool.gather(_listed(units), order)
        return ids, np.concatenate([[0], ends])[lists.offsets.to_numpy()]

    def _one_by_one(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._each([t])[0] if self.how == "whole" or "\0" in t else self.flat(pa.array([t]))[0] for t in texts.to_pylist()]
        return np.concatenate([np.zeros(0, self.kind), *parts]), np.cumsum([0, *map(len, parts)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, begins = self.flat(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in zip(begins, begins[1:])]


def _listed(strings: pa.LargeStringArray) -> list[bytes]:
    """The strings of an array, which is no slice."""
    if not len(strings):
        return []
    at = np.frombuffer(strings.buffers()[1], np.int64)[: len(strings) + 1].tolist()
    raw = strings.buffers()[2].to_pybytes() if strings.buffers()[2] is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


def encoder(path: str, cut: str, kept_units: int = KEPT_UNITS) -> Encoder:
    """One per worker process, kept from task to task."""
    key = (path, cut, kept_units)
    if key not in _MADE:
        _MADE[key] = Encoder(*key)
    return _MADE[key]


def slices(sizes: list[int], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to about ``most``; a larger item stands alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
