"""Token ids of whole texts from a public tokenizer, with a cache of short units.

The library encodes about a megabyte a second. Its pre-tokenizers never join text
across certain places, so a text is cut there and each distinct unit is encoded by
the library once per worker and kept. ``SPACED`` cuts for byte-level BPE whose pieces
may start with one space, ``PLAIN`` for tokenizers that drop white space: runs of
Latin letters and a full stop or comma before white space are units, and so is any
other run without white space. Texts for which a cut could matter (special tokens in
the text, or characters on whose being white space libraries differ) go to the
library whole; texts with white space beyond ASCII are cut by the patterns themselves.
All others are cut as UTF-8 bytes by array operations, their units told apart by one
dictionary encoding, and their ids gathered from those of the distinct units. A unit
of letters alone is one word to the pre-tokenizer, so it goes straight to the
library's model, spelt as the library spells each letter.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from ratewright.llm.words import byte_class, text_buffers

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_STOP = r"[.,](?=\s|\Z)"
SPACED = rf" ?{_LETTERS}+(?=[.,]?(?:\s|\Z))|{_STOP}| ?\S+|\s+(?!\S)|\s+"
PLAIN = rf"{_LETTERS}+(?=[.,]?(?:\s|\Z))|{_STOP}|\S+"
_ODD = r"[\x1c-\x1f\x85᠎​﻿]"
_WIDE = r"[\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # white space beyond ASCII
_SPACE = byte_class((0x09, 0x0D), (0x20, 0x20))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC3))
CACHE_UNITS = 500_000  # per generation, of two; about 200 bytes each
CACHED_LENGTH = 40  # longer units are encoded but not kept
ASK = 20_000  # units per call of the library
AT_ONCE = 2 << 20  # bytes of text that callers encode at once


def cut(column: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the rows, where their units begin (and the end), and which unit is the first of each row.

    Cuts as ``SPACED`` or ``PLAIN`` do where the only white space is ASCII; for ``PLAIN``
    the runs of white space are among the units.
    """
    data, offsets = text_buffers(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    n = len(data)
    space = _SPACE[data]
    solid = np.concatenate(([False], ~space, [False]))
    edge = np.zeros(n + 1, dtype=bool)  # a row begins
    edge[offsets] = True
    begins = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    # letters and a full stop or comma are two units
    after = np.zeros(n, dtype=bool)
    after[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    odd = np.zeros(n + 1, dtype=np.int32 if n < 1 << 31 else np.int64)
    np.cumsum(~(_LETTER[data] | after), out=odd[1:])
    last = data[ends - 1] if n else data
    split = ((last == 0x2E) | (last == 0x2C)) & (ends - begins > 1) & (odd[ends - 1] == odd[begins])
    mark = edge.copy()
    mark[ends[split] - 1] = True
    mark[ends] = True
    if spaced:
        # one space before a word belongs to it; what is before that is a unit, any other last character too
        gap = begins > 0
        gap[gap] &= space[begins[gap] - 1] & ~edge[begins[gap]]
        own = gap.copy()
        own[gap] = data[begins[gap] - 1] == 0x20
        mark[begins[~own]] = True
        mark[begins[gap] - 1] = True
    else:
        mark[begins] = True
    starts = np.flatnonzero(mark)
    if not len(starts) or starts[-1] != n:
        starts = np.append(starts, n)
    return data, starts, np.searchsorted(starts, offsets)


class Encoder:
    """Encodes texts; keeps the units of the present and the last generation."""

    def __init__(self, path: str, units: str, cache_units: int = CACHE_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._odd = re.compile(_ODD)
        self._special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE) if special else None
        # a text without any of these has no special token: of each, a character without case, where it has one
        marks = [next((c for c in s if c.isascii() and not c.isalpha()), None) for s in special]
        self._marks = None if None in marks else sorted(set(marks))
        self._wide = re.compile(_WIDE)
        self._units = re.compile(units)
        self._spaced = units == SPACED
        self._by_arrays = units in (SPACED, PLAIN)
        self._drops_space = units == PLAIN
        self._word = re.compile(rf"{' ?' if self._spaced else ''}{_LETTERS}+")
        self._spelling = self._spelt()
        self._cache_units = cache_units
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _spelt(self) -> dict[int, str] | None:
        """How the library gives its model each letter, and a space before them; none where it is not letter by letter."""
        library = self._tokenizer
        if library.pre_tokenizer is None or library.truncation or library.padding:
            return None

        def given(text: str) -> list[str]:
            clean = library.normalizer.normalize_str(text) if library.normalizer else text
            return [piece for piece, _ in library.pre_tokenizer.pre_tokenize_str(clean)]

        letters = [c for c in map(chr, range(0x100)) if re.fullmatch(_LETTERS, c)]
        lead = " " if self._spaced else ""
        spelling = {ord(c): "".join(given(c)) for c in [*letters, *lead]}
        for word in ("".join(letters), "".join(reversed(letters))):
            if any(given(w) != [w.translate(spelling)] for w in (word, lead + word)):
                return None
        return spelling

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """The ids of runs of letters, asked of the library's model without its normaliser and pre-tokenizer."""
        found: list[bytes] = []
        tokenize = self._tokenizer.model.tokenize
        for start in range(0, len(words), ASK):
            ids, stops = [], [0]
            for word in "\n".join(words[start : start + ASK]).translate(self._spelling).split("\n"):
                ids += [token.id for token in tokenize(word)]
                stops.append(4 * len(ids))
            data = np.array(ids, dtype="<u4").tobytes()
            found += [data[low:high] for low, high in zip(stops[:-1], stops[1:])]
        return found

    def _ids_of_units(self, units: list[str]) -> list[bytes]:
        found = [b""] * len(units)
        words, others = [], []
        for i, unit in enumerate(units):
            if self._spelling is not None and self._word.fullmatch(unit):
                words.append(i)
            elif not (self._drops_space and unit.isspace()):
                others.append(i)
        for places, ask in ((words, self._ids_of_words), (others, self._ids_of_any)):
            for i, ids in zip(places, ask([units[i] for i in places])):
                found[i] = ids
        return found

    def _ids_of_any(self, units: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for start in range(0, len(units), ASK):
            some = units[start : start + ASK]
            answer = self._tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(answer.ids, dtype="<u4").tobytes()
            at = 4 * np.searchsorted(np.array(answer.word_ids, dtype=np.int64), np.arange(len(some) + 1))
            edges = at.tolist()
            found += [ids[low:high] for low, high in zip(edges[:-1], edges[1:])]
        return found

    def _ids_of_distinct(self, units: list[str]) -> list[bytes]:
        """The ids of each of ``units``, none twice; asks the library for those not kept."""
        if len(self._young) > self._cache_units:
            self._young, self._old = {}, self._young
        young, old = self._young, self._old
        out = list(map(young.get, units))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in missing:
            known = old.get(units[i])
            if known is None:
                new.append(i)
            else:
                out[i] = young[units[i]] = known
        for i, ids in zip(new, self._ids_of_units([units[i] for i in new])):
            out[i] = ids
            if len(units[i]) <= CACHED_LENGTH:
                young[units[i]] = ids
        return out

    def _by_patterns(self, text: str) -> bytes:
        units = self._units.findall(text)
        distinct = list(dict.fromkeys(units))
        found = dict(zip(distinct, self._ids_of_distinct(distinct)))
        return b"".join(map(found.__getitem__, units))

    def _goes_whole(self, text: str) -> bool:
        if self._odd.search(text):
            return True
        if self._special is None or (self._marks is not None and not any(mark in text for mark in self._marks)):
            return False
        return self._special.search(text) is not None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(texts)
        plain = list(texts)
        for i, text in enumerate(texts):
            if self._goes_whole(text):
                out[i], plain[i] = self._ids(text), ""
            elif not self._by_arrays or (not text.isascii() and self._wide.search(text)):
                out[i], plain[i] = self._by_patterns(text), ""
        data, starts, first = cut(pa.array(plain, pa.large_string()), self._spaced)
        if len(starts) < 2:
            return out
        units = pa.Array.from_buffers(
            pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = units.indices.to_numpy()
        each = self._ids_of_distinct(distinct)
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        before = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.frombuffer(b"".join(each), dtype="<u4")
        counts = sizes[which]
        stops = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(stops[-1]) + np.repeat(before[which] - stops[:-1], counts)
        flat = ids[at].tobytes()
        edges = (4 * stops[first]).tolist()
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
            if high > low:
                out[i] = flat[low:high]
        return out


@lru_cache(maxsize=2)
def encoder(path: str, units: str, cache_units: int = CACHE_UNITS) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path, units, cache_units)
