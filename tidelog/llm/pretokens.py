"""Texts as the pieces a tokenizer works on, a block of texts at a time, and a bounded memory of what each piece becomes."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

from tidelog.llm.texts import blocks, mix

# The splitting rules of the two vocabularies. ``cut`` does the same on numbers.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

#: Characters whose classes and lower cases are the same here and in the tokenizer's library, and that no
#: normal form changes, as tests prove one by one. A text with any other goes through the library whole.
PLAIN = regex.compile(r"[\t-\r\x20-\x7e\xa0-įı-ɏ‐-‧‰-⁞€]")

PIECES = 1_000_000  # remembered by a worker; beyond that it forgets all and goes on

OTHER, LETTER, DIGIT, SPACE, ODD = range(5)

_BASE = np.uint64(0x5851F42D4C957F2D)
_SMALL = 1 << 14  # all plain characters are below


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each character its class, its lower case and a random number; the last entry is for all that is not plain."""
    kinds = np.full(_SMALL + 1, ODD, np.uint8)
    lower = np.arange(_SMALL + 1, dtype=np.uint32)
    for c in map(chr, range(_SMALL)):
        if PLAIN.match(c):
            kinds[ord(c)] = LETTER if regex.match(r"\p{L}", c) else DIGIT if regex.match(r"\p{N}", c) else SPACE if regex.match(r"\s", c) else OTHER
            lower[ord(c)] = ord(c.lower())
    return kinds, lower, mix(np.arange(1, _SMALL + 2, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def _byte_names() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: b for b in seen} | {b: 256 + i for i, b in enumerate(hidden)}


def cut(chars: np.ndarray, kinds: np.ndarray, first: np.ndarray, words: bool) -> np.ndarray:
    """Where pieces start. ``first``: does a text start here? Runs of white space start pieces, too."""
    n = len(chars)
    change = np.r_[True, kinds[1:] != kinds[:-1]] | first
    start = change.copy()
    joined = np.zeros(n, bool)
    if words:
        start |= kinds == DIGIT
    else:
        after = np.flatnonzero(change[1:] & (kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~first[1:]) + 1
        start[after - 1] = True  # the last one of several is apart
        after = after[chars[after - 1] == 32]
        start[after] = False  # a space belongs to what follows
        joined[after] = True
    quote = np.flatnonzero((chars == 39) & change & ~joined)
    quote = quote[quote + 1 < n]
    quote = quote[(kinds[quote + 1] == LETTER) & ~first[quote + 1]]
    if len(quote):
        one = chars[quote + 1]
        after = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~first[after], chars[after], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for where, size in ((quote[short], 2), (quote[long], 3)):
            start[where + 1] = False
            end = where + size
            end = end[end < n]
            start[end] = True
    return start


def _taken(values: array, kind: type, at: np.ndarray) -> np.ndarray:
    """Some of the values; no view is kept, so that the array can grow again."""
    return np.frombuffer(values, kind)[at] if len(at) else np.zeros(0, kind)


class Pieces:
    """What the tokenizer makes of pieces of texts. A piece is merged once and then known by its hash."""

    def __init__(self, path: str, words: bool, whole: list[str] = ()):
        """``words``: split as WORD_LEVEL after lower-casing, else as BYTE_LEVEL. ``whole``: strings proved to be one token."""
        self.tokenizer = load(path)
        self.words = words
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds, self.lower, self.numbers = _classes()
        self.names = _byte_names()
        self.powers = np.ones(1, np.uint64)
        self.whole = list(whole)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.starts, self.lengths = array("I"), array("q"), array("q")
        if self.whole:
            chars = np.frombuffer("".join(self.whole).encode("utf-32-le"), np.uint32)
            ends = np.cumsum([len(w) for w in self.whole])
            plain = np.add.reduceat((self.kinds[np.minimum(chars, _SMALL)] == ODD).astype(int), np.r_[0, ends[:-1]]) == 0
            hashes = self._hashes(chars, np.r_[0, ends[:-1]])[plain]
            self._remember(hashes, [[0]] * len(hashes))  # for counting, any one id will do

    def _hashes(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sizes = np.diff(np.r_[starts, len(chars)])
        if (longest := int(sizes.max())) > len(self.powers):
            self.powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(2 * longest, _BASE)])
        values = self.numbers[np.minimum(chars, _SMALL)]
        values *= self.powers[np.arange(len(chars)) - np.repeat(starts, sizes)]
        return mix(np.add.reduceat(values, starts) + sizes.astype(np.uint64))

    def _remember(self, hashes: np.ndarray, lists: list[list[int]]) -> None:
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.places = np.insert(self.places, at, len(self.starts) + order)
        self.hashes = np.insert(self.hashes, at, hashes[order])
        for ids in lists:
            self.starts.append(len(self.flat))
            self.lengths.append(len(ids))
            self.flat.extend(ids)

    def _merged(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(self.names))]

    def found(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict[int, list[int]]]]:
        """For each block of texts: index of the first one; the known place of each piece; how many pieces come
        before each text; the ids of those texts that went through the library."""
        for first, data, offsets in blocks(texts):
            text = data.tobytes().decode()
            chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            ends = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
            kinds = self.kinds[np.minimum(chars, _SMALL)]
            odd = np.r_[0, np.cumsum(kinds == ODD)]
            left = odd[ends[1:]] > odd[ends[:-1]]
            for special in self.special:
                at = text.find(special)
                while at >= 0:
                    left[np.searchsorted(ends, at, "right") - 1] = True
                    at = text.find(special, at + 1)
            by_library = {}
            for i in np.flatnonzero(left):
                by_library[int(i)] = self.tokenizer.encode(text[ends[i] : ends[i + 1]], add_special_tokens=False).ids
            if self.words:
                chars = self.lower[np.minimum(chars, _SMALL)]
            if not len(chars):
                yield first, np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), by_library
                continue
            starts_text = np.zeros(len(chars), bool)
            starts_text[ends[:-1][ends[:-1] < len(chars)]] = True
            starts = np.flatnonzero(cut(chars, kinds, starts_text, self.words))
            hashes = self._hashes(chars, starts)
            real = ~np.repeat(left, np.diff(np.searchsorted(starts, ends)))
            if self.words:
                real &= kinds[starts] != SPACE
            stops = np.r_[starts[1:], len(chars)][real]
            starts, hashes = starts[real], hashes[real]
            unique, index, back = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.starts) > PIECES:
                self._forget()
            at = np.searchsorted(self.hashes, unique)
            new = np.ones(len(unique), bool)
            inside = at < len(self.hashes)
            new[inside] = self.hashes[at[inside]] != unique[inside]
            if new.any():
                said = chars.astype("<u4").tobytes().decode("utf-32-le")
                some = index[new]
                self._remember(unique[new], [self._merged(said[a:b]) for a, b in zip(starts[some].tolist(), stops[some].tolist())])
            places = self.places[np.searchsorted(self.hashes, unique)]
            yield first, places[back], np.searchsorted(starts, ends), by_library

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for first, places, cuts, by_library in self.found(texts):
            sums = np.r_[0, np.cumsum(_taken(self.lengths, np.int64, places))]
            out[first : first + len(cuts) - 1] = np.diff(sums[cuts])
            for i, ids in by_library.items():
                out[first + i] = len(ids)
        return out

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for _, places, cuts, by_library in self.found(texts):
            size = _taken(self.lengths, np.int64, places)
            ends = np.cumsum(size)
            before = _taken(self.starts, np.int64, places) - ends + size
            all_ids = _taken(self.flat, np.uint32, np.repeat(before, size) + np.arange(size.sum()))
            bounds = np.r_[0, ends][cuts]
            for i in range(len(cuts) - 1):
                yield np.array(by_library[i], np.uint32) if i in by_library else all_ids[bounds[i] : bounds[i + 1]]
