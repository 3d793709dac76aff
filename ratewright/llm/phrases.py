"""Phrase collocation mining: double-array tries of Apriori-safe candidates over all positions.

Candidates grow by a word a level: a phrase of k words is a candidate if both phrases of
k - 1 words in it are (Apriori) and if a distributed count of the phrases that occur does
not rule it out. Apriori alone would propose every pair of frequent words, the square of
the vocabulary. Words and pairs, of which most are rare, are first counted in 2**BITS
buckets by their codes: a task adds its own up and sends each range of buckets as one
packed row, and what lies in a bucket below the threshold is rare. Buckets only ever let
too much through, never too little. What a task needs to know of the level below is one
bit array of fixed size, with false positives only. Spelling a phrase out costs a row, so
the phrases that a sixteenth of the streams shows to be common are found there first, in
tasks as large as any, and all other tasks send only what is not among these.

One pass over the texts fills the word buckets. A second one turns the texts into streams
of 64-bit word codes, 0 where a piece ends or a rare word stands, and counts the other words.
The words that a sixteenth of the texts shows are spelled out there once; of these a task of
the second pass sends its counts alone, packed, and it spells out only what is not among them.

The candidates then go, at most about ``TRIE_PHRASES`` at a time, into a double-array trie
over the bytes of word numbers. Each trie is broadcast; a task starts a state at every text
position, numpy advances all of them together level by level, bincount adds up the
accepting states, and the tasks' packed sums are added. These counts decide. Streams are
cut into rows that repeat the next ``LONGEST - 1`` codes, so no phrase is lost at a cut.

Scores are integers: products are DECIMAL(38), so nothing is rounded. A phrase falls if a
longer candidate around it occurs as often. It is enough to look one word further: of a
phrase two words longer, the one in between occurs at least as often and is a candidate.

Defined cases: null or empty texts have no words, null languages are ``und``; rows with
equal ids are documents of their own (ids are not read, nor any other column); texts of
any length are cut at separators into segments of ``SEGMENT_BYTES``; two words of equal
code are noticed by a second code, and the passes are made again with other codes; languages
without phrases have no rows; ties of score and count are ordered by the phrase's bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm import doublearray
from ratewright.llm.common import materialize
from ratewright.llm.words import Words, byte_class, mix, powers, segments, words_of

LONGEST = 5
ROW_CODES = 32_768  # codes of a stream in one row
HELD = 250_000  # counted phrases a task holds before it adds them up or passes them on
SHARD_HELD = 500_000  # bucket numbers, of four bytes
KNOWN = 1_000_000  # words or phrases found in a share of the input that tasks need not send again
SHARE = 16
TASK_ROWS = 256  # rows of a stream, 64 MiB, that a task of that share reads
SEGMENT_BYTES = 1 << 18  # text read at once; arrays over it take some hundred times as much
TRIE_PHRASES = 400_000  # candidates in one broadcast trie
BITS = 27  # the bit array has 2**27 bits: 16 MiB
RANGE_BITS = 20  # buckets, or phrases, of one packed row

#: ends of pieces: . , ; : ! ? and \n \v \f \r
BREAK = byte_class((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
#: everything but ends of pieces, space and tab
WORD = ~(BREAK | byte_class((0x20, 0x20), (0x09, 0x09)))

_CODES_2 = np.random.default_rng(20250711).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---- counts in shards --------------------------------------------------------------------


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending numbers below 2**32 and their counts: steps and counts by byte planes, compressed."""
    rows = np.stack([np.diff(ids, prepend=0).astype("<u4"), counts.astype("<u4")])
    planes = rows.view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(2, 4, -1)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]
    return np.cumsum(steps.astype(np.int64)), counts.astype(np.int64)


class _Shard:
    """Counts of numbers below 2**32 of one task, passed on as one packed row a range."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
        self.held.append((ids, np.broadcast_to(np.uint32(1), len(ids))))
        self.size += len(ids)
        if self.size > SHARD_HELD:
            self._merge()
            if self.size > SHARD_HELD // 2:
                yield from self.rows()

    def _merge(self) -> None:
        ids, counts = (np.concatenate([h[i] for h in self.held]) for i in (0, 1))
        order = np.argsort(ids, kind="stable").astype(np.uint32)
        ids = ids[order]
        new = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        # a count beyond 32 bits would need that many positions in one task
        self.held = [(ids[new], np.add.reduceat(counts[order], new, dtype=np.uint32))]
        self.size = len(new)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        if self.size:
            self._merge()
            ids, counts = self.held[0]
            ranges = ids >> RANGE_BITS
            cuts = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1]))).tolist()
            for low, high in zip(cuts, [*cuts[1:], len(ids)]):
                yield int(ranges[low]), pack(ids[low:high] & ((1 << RANGE_BITS) - 1), counts[low:high])
        self.held, self.size = [], 0


def _sum_shards(then):
    """Add up the packed rows of each range and give ``then(range, sums)``; rows come ordered by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, sums = None, None
        for batch in batches:
            for number, blob in zip(batch.column("range").to_pylist(), batch.column("blob").to_pylist()):
                if number != present:
                    if present is not None:
                        yield then(present, sums)
                    present, sums = number, np.zeros(1 << RANGE_BITS, dtype=np.int64)
                ids, counts = unpack(blob)
                sums[ids] += counts
        if present is not None:
            yield then(present, sums)

    return run


def _summed(shards: DataFrame, then, schema: str) -> DataFrame:
    return shards.repartition("range").sortWithinPartitions("range").mapInArrow(_sum_shards(then), schema)


class Bits:
    """A bit array of 2**BITS bits that travels compressed: most bits are 0."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def __getstate__(self) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(self.words.tobytes())

    def __setstate__(self, state: bytes) -> None:
        self.words = np.frombuffer(zstandard.ZstdDecompressor().decompress(state), dtype=np.uint64)


def frequent_buckets(shards: DataFrame, least: int) -> Bits:
    """The bit array of buckets with at least ``least``."""

    def bits(number: int, sums: np.ndarray) -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(sums >= least, bitorder="little").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([packed], pa.binary())], names=["range", "bits"])

    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    wide = 1 << max(RANGE_BITS - 6, 0)
    for row in _summed(shards, bits, "range int, bits binary").collect():  # 2**(BITS - RANGE_BITS) rows
        found = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row.bits)), dtype=np.uint64)
        out[row.range * wide : (row.range + 1) * wide] = found
    return Bits(out)


def bit_array(keys: DataFrame) -> Bits:
    """2**BITS bits, set at the upper bits of every ``key``; built in Spark, a slot of 64 bits a row."""
    spot = F.shiftrightunsigned("key", 64 - BITS)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(key, {64 - BITS}) & 63 AS INT))")
    slots = (
        keys.select(F.shiftright(spot, 6).alias("slot"), bit.alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most 2**(BITS - 6) rows
    )
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    out[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy().view(np.uint64)
    return Bits(out)


def is_set(bits: Bits, keys: np.ndarray) -> np.ndarray:
    spot = keys >> np.uint64(64 - BITS)
    return (bits.words[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.uint32)


# ---- texts to streams of word codes ----------------------------------------------------


def _lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _gather(words: Words, some: np.ndarray) -> pa.Array:
    """The words of numbers ``some`` as strings."""
    sizes = words.ends[some] - words.starts[some]
    stops = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(stops[-1]) - np.repeat(stops[:-1] - words.starts[some], sizes)
    return pa.Array.from_buffers(
        pa.large_string(), len(some), [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(words.data[at])]
    ).cast(pa.string())


@dataclass
class _Read:
    """The words of one segment: their codes, which begin a piece, and the language number of each."""

    words: Words
    codes: np.ndarray
    twins: np.ndarray | None
    begins: np.ndarray
    langs: np.ndarray


def _read(batches: Iterator[pa.RecordBatch], seed: int, twins: bool) -> Iterator[tuple[_Read, list[str]]]:
    """Segments of (text, lang) batches in order, with the batch's languages."""
    gap = False  # a piece ended after the last word of the row that goes on
    for batch in batches:
        texts = batch.column("text")
        tags = pa.array([v if v is not None else "und" for v in batch.column("lang").to_pylist()], pa.string()).dictionary_encode()
        names = tags.dictionary.to_pylist()
        lang_codes = np.array([_lang_code(v) for v in names], dtype=np.uint64)
        lang_of = tags.indices.to_numpy(zero_copy_only=False)
        for row, some, whole in segments(texts, WORD, SEGMENT_BYTES):
            words = words_of(some, WORD)
            before = np.concatenate(([0], np.cumsum(BREAK[words.data])))
            n = len(words.starts)
            if not n:
                gap = whole or gap or bool(before[-1])
                continue
            langs = lang_of[np.repeat(np.arange(len(some)), np.diff(words.first)) + row]
            tag = lang_codes[langs]
            codes, twin = mix(words.hashes + tag), None
            if twins or seed:
                size = len(words.data)
                forward, back = powers(size + 1)
                sums = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(_CODES_2[words.data] * forward[:size], out=sums[1:])
                twin = mix((sums[words.ends] - sums[words.starts]) * back[words.starts] + tag * _STEP)
            if seed:
                codes = mix(codes + twin * np.uint64(2 * seed + 1))
            codes[codes == 0] = 1
            begins = np.zeros(n, dtype=bool)
            begins[1:] = before[words.starts[1:]] > before[words.ends[:-1]]
            begins[words.first[:-1][np.diff(words.first) > 0]] = True
            if not whole:
                begins[0] = gap or before[words.starts[0]] > 0
            gap = bool(before[-1] > before[words.ends[-1]])
            yield _Read(words, codes, twin, begins, langs), names


def _count_words(seed: int):
    """Word buckets of a task, and its words by language."""

    def row(number=None, blob=None, lang=None, n=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([blob], pa.binary()), pa.array([lang], pa.string()), pa.array([n], pa.int64())],
            names=["range", "blob", "lang", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, totals = _Shard(), {}
        for read, names in _read(batches, seed, False):
            for lang, n in zip(names, np.bincount(read.langs, minlength=len(names)).tolist()):
                totals[lang] = totals.get(lang, 0) + n
            yield from (row(*found) for found in shard.add(_buckets(read.codes)))
        yield from (row(*found) for found in shard.rows())
        for lang, n in totals.items():
            if n:
                yield row(lang=lang, n=n)

    return run


class _Tally:
    """Counts by code; equal codes with unequal second codes in one task are marked as a clash."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, *part) -> None:
        """codes, second codes, languages, words, counts and clashes"""
        self.parts.append(part)
        self.rows += len(part[0])

    def merge(self) -> None:
        codes, checks, counts, clash = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1, 4, 5))
        langs, texts = (pa.concat_arrays([p[i] for p in self.parts]) for i in (2, 3))
        order = np.argsort(codes, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], codes[order][1:] != codes[order][:-1])))
        low, high = (f.reduceat(checks[order], new) for f in (np.minimum, np.maximum))
        clash = np.logical_or.reduceat(clash[order], new) | (low != high)
        first = order[new]
        take = pa.array(first)
        self.parts = [(codes[first], low, langs.take(take), texts.take(take), np.add.reduceat(counts[order], new), clash)]
        self.rows = len(first)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self.merge()
            codes, checks, langs, texts, counts, clash = self.parts[0]
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(codes), pa.binary()), pa.nulls(len(codes), pa.int32()), pa.array(codes.view(np.int64)),
                    langs, texts, pa.array(counts), pa.array(clash), pa.array(checks.view(np.int64)), pa.nulls(len(codes), pa.binary()),
                ],
                names=_STREAM_FIELDS,
            )
            for low in range(0, self.rows, 20_000):
                yield whole.slice(low, 20_000)
        self.parts, self.rows = [], 0


_STREAM = "codes binary, own int, code bigint, lang string, word string, n bigint, clash boolean, twin bigint, blob binary"
_STREAM_FIELDS = [f.split()[0] for f in _STREAM.split(", ")]


def _without_lone(stream: np.ndarray) -> np.ndarray:
    """A stream without words that have a 0 on both sides, and with one 0 for each run of them."""
    solid = stream != 0
    beside = np.zeros(len(stream), dtype=bool)
    beside[1:] |= solid[:-1]
    beside[:-1] |= solid[1:]
    # the ends of the stream may go on
    if len(stream):
        beside[0] |= solid[0]
        beside[-1] |= solid[-1]
    kept = np.where(solid & ~beside, np.uint64(0), stream)
    zero = kept == 0
    return kept[~(zero & np.concatenate(([False], zero[:-1])))]


def _stream_rows(stream: np.ndarray, last: bool) -> tuple[list[tuple[bytes, int]], np.ndarray]:
    """Rows of ``ROW_CODES`` own codes and the following ones, and what is left of the stream."""
    rows, at = [], 0
    while len(stream) - at >= ROW_CODES + LONGEST - 1 or (last and at < len(stream)):
        own = min(ROW_CODES, len(stream) - at)
        rows.append((stream[at : at + own + LONGEST - 1].tobytes(), own))
        at += own
    return rows, stream[at:]


@dataclass
class _Frequent:
    """Buckets of frequent words, and of known words the codes in order and the second codes."""

    bits: Bits
    codes: np.ndarray
    twins: np.ndarray


class _Words:
    """The words of a task in frequent buckets: known ones by number, all others spelled out."""

    def __init__(self, known: _Frequent):
        self.known, self.counts, self.tally = known, np.zeros(len(known.codes), dtype=np.int64), _Tally()

    def add(self, read: _Read, names: list[str], often: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes, twins, some = read.codes, read.twins, np.flatnonzero(often)
        if not len(some):
            return
        order = some[np.argsort(codes[some], kind="stable")]
        new = np.flatnonzero(np.concatenate(([True], codes[order][1:] != codes[order][:-1])))
        first = order[new]
        low, high = (f.reduceat(twins[order], new) for f in (np.minimum, np.maximum))
        counts = np.diff(np.concatenate((new, [len(order)]))).astype(np.int64)
        if len(self.counts):
            at = np.minimum(np.searchsorted(self.known.codes, codes[first]), len(self.counts) - 1)
            known = (self.known.codes[at] == codes[first]) & (self.known.twins[at] == low) & (low == high)
            self.counts[at[known]] += counts[known]
            first, low, high, counts = (v[~known] for v in (first, low, high, counts))
        if not len(first):
            return
        langs = pa.array(names, pa.string()).take(pa.array(read.langs[first]))
        self.tally.add(codes[first], low, langs, _gather(read.words, first), counts, low != high)
        if self.tally.rows > 2 * HELD:
            self.tally.merge()
            if self.tally.rows > HELD:
                yield from self.tally.batches()

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield from self.tally.batches()
        seen = np.flatnonzero(self.counts)
        for number in np.unique(seen >> RANGE_BITS).tolist():
            ids = seen[seen >> RANGE_BITS == number]
            yield _row(own=number, blob=pack(ids & ((1 << RANGE_BITS) - 1), self.counts[ids]))


def _spell(seed: int, shared):
    """Streams of codes in frequent buckets, and these words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rest = _Words(shared.value), np.empty(0, np.uint64)
        for read, names in _read(batches, seed, True):
            often = is_set(shared.value.bits, read.codes)
            stream = np.insert(np.where(often, read.codes, np.uint64(0)), np.flatnonzero(read.begins), np.uint64(0))
            rows, rest = _stream_rows(np.concatenate((rest, _without_lone(stream))), False)
            yield from _streams(rows)
            yield from words.add(read, names, often)
        yield from _streams(_stream_rows(rest, True)[0])
        yield from words.rows()

    return run


def _spell_words(seed: int, shared):
    """The words of ``_spell`` without the streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value)
        for read, names in _read(batches, seed, True):
            yield from words.add(read, names, is_set(shared.value.bits, read.codes))
        yield from words.rows()

    return run


def _row(codes=None, own=None, blob=None) -> pa.RecordBatch:
    given = {"codes": pa.array([codes], pa.binary()), "own": pa.array([own], pa.int32()), "blob": pa.array([blob], pa.binary())}
    none = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64())
    absent = {name: pa.nulls(1, kind) for name, kind in zip(("code", "lang", "word", "n", "clash", "twin"), none)}
    return pa.RecordBatch.from_pydict({name: (given | absent)[name] for name in _STREAM_FIELDS})


def _streams(rows: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for codes, own in rows:
        yield _row(codes, own)


def _known_words(rows: DataFrame, seed: int, bits: Bits, least: int, total: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(code, twin, lang, word) of at most ``KNOWN`` words that a share of the texts shows, and their codes in order with the second codes.

    Codes that two words of the share have are left out: these words are spelled out by all tasks.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(_Frequent(bits, np.empty(0, np.uint64), np.empty(0, np.uint64)))
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(SHARE)) == 0).repartition(max(1, total // (SHARE * TASK_ROWS * ROW_CODES)))
    word = F.struct("twin", "lang", "word")
    met = (
        some.mapInArrow(_spell_words(seed, shared), _STREAM)
        .groupBy("code")
        .agg(F.min(word).alias("word"), F.max(word).alias("other"), F.sum("n").alias("n"), F.bool_or("clash").alias("clash"))
        .where((F.col("n") >= max(2, least // (2 * SHARE))) & ~F.col("clash") & (F.col("word") == F.col("other")))
    )
    known = materialize(met.orderBy(F.desc("n"), "code").limit(KNOWN).select("code", "word.*"), "known_words")
    shared.unpersist()
    found = known.select("code", "twin").toArrow()  # KNOWN at most
    codes, twins = (found.column(c).to_numpy().view(np.uint64) for c in ("code", "twin"))
    order = np.argsort(codes)
    return known, codes[order], twins[order]


def word_streams(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streams (codes, own), words (code, lang, word, n) of at least ``least``, and totals (lang, n)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    for seed in range(8):
        counted = materialize(rows.mapInArrow(_count_words(seed), "range int, blob binary, lang string, n bigint"), "word_buckets")
        bits = frequent_buckets(counted.where("blob IS NOT NULL").select("range", "blob"), least)
        totals = counted.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
        known, codes, twins = _known_words(rows, seed, bits, least, totals.agg(F.sum("n")).first()[0] or 0)
        shared = spark.sparkContext.broadcast(_Frequent(bits, codes, twins))
        encoded = materialize(rows.mapInArrow(_spell(seed, shared), _STREAM), "streams")
        shared.unpersist()
        shards = encoded.where("blob IS NOT NULL").select(F.col("own").alias("range"), "blob")
        numbers = spark.createDataFrame(pa.table({"number": pa.array(np.arange(len(codes))), "code": pa.array(codes.view(np.int64))}))
        listed = (
            _summed(shards, _numbered, "number bigint, a bigint")
            .join(numbers, "number")
            .join(known, "code")
            .select("code", "lang", "word", F.col("a").alias("n"), F.lit(False).alias("clash"))
        )
        # dealt by code alone, so that two words of one code meet; tasks have added up their own rows
        words = materialize(
            encoded.where("code IS NOT NULL")
            .select("code", "lang", "word", "n", "clash")
            .unionByName(listed)
            .repartition("code")
            .groupBy("code", "lang", "word")
            .agg(F.sum("n").alias("n"), F.bool_or("clash").alias("clash")),
            "words",
        )
        twice = words.groupBy("code").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("clash").alias("clash"))
        if not twice.where("clash OR rows > 1").limit(1).count():
            streams = encoded.where("codes IS NOT NULL").select("codes", "own")
            return streams, words.where(F.col("n") >= least).drop("clash"), totals
    raise RuntimeError("words of equal codes under eight seeds")


# ---- candidates ---------------------------------------------------------------------------


def roll(states: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Code of a phrase from that of all but its last word, and its last word."""
    return mix(states * _STEP + codes)


def _allowed(stream: np.ndarray, own: int, bits: Bits, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Own positions whose phrases of k - 1 words, there and one word on, are both set; and the k words' codes."""
    if len(stream) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    short, inner = stream[: len(stream) - k + 2], stream != 0
    full = inner[: len(short)].copy()
    for i in range(1, k - 1):
        short = roll(short, stream[i : i + len(short)])
        full &= inner[i : i + len(full)]
    alive = full & is_set(bits, short)
    at = np.flatnonzero(alive[:-1] & alive[1:])
    at = at[at < own]
    return at, roll(short[at], stream[at + k - 1])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    for batch in batches:
        for blob, own in zip(batch.column("codes"), batch.column("own").to_pylist()):
            yield np.frombuffer(blob.as_buffer(), dtype=np.uint64), own


def _count_phrases(shared, k: int):
    """Buckets of the phrases of k words of a task."""

    def row(number: int, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([blob], pa.binary())], names=["range", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for stream, own in _rows_of(batches):
            _, keys = _allowed(stream, own, shared.value, k)
            yield from (row(*found) for found in shard.add(_buckets(keys)))
        yield from (row(*found) for found in shard.rows())

    return run


def _grouped(codes: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """Equal rows of ``codes`` (one column a phrase) with equal keys added up."""
    order = np.argsort(keys, kind="stable")
    codes, keys, counts = codes[:, order], keys[order], counts[order]
    change = (codes[:, 1:] != codes[:, :-1]).any(axis=0)
    new = np.flatnonzero(np.concatenate(([True], change)))
    return codes[:, new], keys[new], np.add.reduceat(counts, new)


def _sieve(shared, k: int, own_bits=None, known=None):
    """Phrases of k words that occur and whose parts of k - 1 words may be candidates, with counts.

    With ``own_bits`` only those that are set there themselves; none of the ``known`` keys, in order.
    """

    def emit(codes, keys, counts) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(counts), 20_000):
            some = slice(low, low + 20_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts[some])] + [pa.array(c[some].view(np.int64)) for c in codes],
                names=["n", *(f"c{i}" for i in range(1, k + 1))],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        together = lambda: _grouped(*(np.concatenate([h[i] for h in held], axis=-1) for i in range(3)))
        for stream, own in _rows_of(batches):
            at, keys = _allowed(stream, own, shared.value, k)
            if own_bits is not None:
                often = is_set(own_bits.value, keys)
                at, keys = at[often], keys[often]
            if known is not None and len(known.value):
                place = np.minimum(np.searchsorted(known.value, keys), len(known.value) - 1)
                fresh = known.value[place] != keys
                at, keys = at[fresh], keys[fresh]
            if not len(at):
                continue
            held.append(_grouped(np.stack([stream[at + i] for i in range(k)]), keys, np.ones(len(at), np.int64)))
            size += len(held[-1][1])
            if size > HELD:
                held = [together()]
                size = len(held[0][1])
                if size > HELD // 2:
                    yield from emit(*held[0])
                    held, size = [], 0
        if held:
            yield from emit(*together())

    return run


def _keyed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [batch.column(f"c{i}").to_numpy().view(np.uint64) for i in range(1, k + 1)]
            key = codes[0]
            for other in codes[1:]:
                key = roll(key, other)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    return run


def _spelled(streams: DataFrame, shared, k: int, own_bits, least: int) -> DataFrame:
    """(c1..ck): the phrases of k words that the sieve lets through and that may occur ``least`` times.

    A phrase that a share of the streams shows often enough is a candidate at once. All
    others are counted over all streams, and stay if they reach ``least``.
    """
    spark = streams.sparkSession
    names = [f"c{i}" for i in range(1, k + 1)]
    schema = ", ".join(["n bigint", *(f"{c} bigint" for c in names)])

    def counted(rows: DataFrame, known, enough: int) -> DataFrame:
        found = rows.mapInArrow(_sieve(shared, k, own_bits, known), schema).groupBy(*names).agg(F.sum("n").alias("n"))
        return found.where(F.col("n") >= enough)

    some = streams.where(F.pmod(F.xxhash64(F.substring("codes", 1, 256)), F.lit(SHARE)) == 0)
    some = some.coalesce(max(1, streams.count() // (SHARE * TASK_ROWS)))
    first = materialize(
        counted(some, None, max(2, least // (2 * SHARE))).orderBy(F.desc("n"), *names).limit(KNOWN).select(*names), f"known_{k}"
    )
    keys = first.mapInArrow(_keyed(k), "key bigint").toArrow().column("key").to_numpy()  # KNOWN at most
    known = spark.sparkContext.broadcast(np.sort(keys.view(np.uint64)))
    rest = counted(streams, known, least).select(*names)
    spelled = materialize(first.unionByName(rest), f"candidates_{k}")
    known.unpersist()
    return spelled


def candidates(streams: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(c1..c5): every phrase of 2 to ``LONGEST`` words that may occur ``least`` times."""
    spark = streams.sparkSession
    shared = spark.sparkContext.broadcast(bit_array(words.select(F.col("code").alias("key"))))
    found = None
    for k in range(2, LONGEST + 1):
        names = [f"c{i}" for i in range(1, k + 1)]
        own_bits = None
        if k <= 3:  # of longer phrases Apriori leaves little
            shards = streams.mapInArrow(_count_phrases(shared, k), "range int, blob binary")
            own_bits = spark.sparkContext.broadcast(frequent_buckets(shards, least))
        level = _spelled(streams, shared, k, own_bits, least)
        for done in filter(None, (shared, own_bits)):
            done.unpersist()
        if k < LONGEST:
            shared = spark.sparkContext.broadcast(bit_array(level.mapInArrow(_keyed(k), "key bigint")))
        some = level.select(*names, *(F.lit(None).cast("bigint").alias(f"c{i}") for i in range(k + 1, LONGEST + 1)))
        found = some if found is None else found.unionByName(some)
    return materialize(found, "candidates")


# ---- counting by tries ------------------------------------------------------------------------


@dataclass
class PhraseTrie:
    """Word codes in order, the bytes a word number takes, and the trie of the phrases' numbers."""

    phrases: int
    vocabulary: np.ndarray
    width: int
    array: doublearray.DoubleArray

    @staticmethod
    def of(codes: np.ndarray, lengths: np.ndarray) -> PhraseTrie:
        """Of the rows of ``codes``, whose first ``lengths`` count."""
        inside = np.arange(codes.shape[1]) < lengths[:, None]
        vocabulary = np.unique(codes[inside])
        width = max(1, -(-max(1, len(vocabulary) - 1).bit_length() // 8))
        numbers = np.where(inside, np.searchsorted(vocabulary, codes), 0)
        digits = np.stack([(numbers >> (8 * (width - 1 - i))) & 255 for i in range(width)], axis=2).reshape(len(codes), -1)
        return PhraseTrie(len(codes), vocabulary, width, doublearray.build(digits, lengths * width))

    def accepted(self, stream: np.ndarray, own: int) -> np.ndarray:
        """Accepting states, as numbers of phrases from 1 on, of the first ``own`` positions."""
        at = np.minimum(np.searchsorted(self.vocabulary, stream), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == stream
        found = []
        position = np.flatnonzero(known[:own])
        state = np.zeros(len(position), dtype=np.int64)
        for word in range(LONGEST):
            if word:
                live = np.flatnonzero(position + word < len(stream))
                live = live[known[position[live] + word]]
                position, state = position[live], state[live]
            if not len(position):
                break
            number = at[position + word]
            for i in range(self.width):
                which, state = self.array.advance(state, (number >> (8 * (self.width - 1 - i))) & 255)
                position, number = position[which], number[which]
            accepted = self.array.accept[state]
            found.append(accepted[accepted > 0])
        return np.concatenate(found) if found else np.empty(0, np.int32)


def _count(shared):
    """Counts of a task's accepting states, packed by ranges of phrases."""

    def row(number: int, counts: np.ndarray) -> pa.RecordBatch:
        seen = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([pack(seen, counts[seen])], pa.binary())], names=["range", "blob"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        totals, held, n = np.zeros(trie.phrases + 1, dtype=np.int64), [], 0
        add = lambda: np.bincount(np.concatenate(held), minlength=trie.phrases + 1)
        for stream, own in _rows_of(batches):
            held.append(trie.accepted(stream, own))
            n += len(held[-1])
            if n > trie.phrases:
                totals += add()
                held, n = [], 0
        if held:
            totals += add()
        for number in range(-(-trie.phrases >> RANGE_BITS) or 1):
            counts = totals[1:][number << RANGE_BITS : (number + 1) << RANGE_BITS]
            if counts.any():
                yield row(number, counts)

    return run


def _numbered(number: int, sums: np.ndarray) -> pa.RecordBatch:
    seen = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(seen + (number << RANGE_BITS)), pa.array(sums[seen])], names=["number", "a"]
    )


def count_phrases(streams: DataFrame, phrases: DataFrame, least: int, at_once: int = TRIE_PHRASES) -> DataFrame:
    """(codes, a) of the phrases (c1..c5) that occur at least ``least`` times."""
    spark = streams.sparkSession
    names = [f"c{i}" for i in range(1, LONGEST + 1)]
    blocks = max(1, -(-phrases.count() // at_once))
    split = F.pmod(F.xxhash64(*names, F.lit(5)), F.lit(blocks))
    counted = None
    for block in range(blocks):
        some = phrases.where(split == block).select(*names).toArrow()  # about ``at_once`` rows
        if not some.num_rows:
            continue
        columns = [some.column(c) for c in names]
        lengths = sum((np.asarray(c.is_valid()).astype(np.int64) for c in columns))
        codes = np.stack([c.fill_null(0).to_numpy().view(np.uint64) for c in columns], axis=1)
        shared = spark.sparkContext.broadcast(PhraseTrie.of(codes, lengths))
        sums = _summed(streams.mapInArrow(_count(shared), "range int, blob binary"), _numbered, "number bigint, a bigint")
        numbered = spark.createDataFrame(some.append_column("number", pa.array(np.arange(len(codes)))))
        part = materialize(
            numbered.join(sums.where(F.col("a") >= least), "number").select(
                F.filter(F.array(*names), lambda c: c.isNotNull()).alias("codes"), "a"
            ),
            "phrases",
        )
        shared.unpersist()
        counted = part if counted is None else counted.unionByName(part)
    return counted if counted is not None else spark.createDataFrame([], "codes array<bigint>, a bigint")


# ---- scores ------------------------------------------------------------------------------------


def collocations(docs: DataFrame, least: int = 100, first: int = 2000, at_once: int = TRIE_PHRASES) -> DataFrame:
    """The ``first`` phrases of each language of ``docs(text, lang)`` by score.

    Gives lang, rank, phrase, a, l, r, n and score.
    """
    streams, common, totals = word_streams(docs, least)
    phrases = count_phrases(streams, candidates(streams, common, least), least, at_once)
    # every part of a candidate occurs as often as it or more often, so it is here
    parts = phrases.unionByName(common.select(F.array("code").alias("codes"), F.col("n").alias("a")))
    spelled = (
        phrases.select("codes", F.posexplode("codes").alias("at", "code"))
        .join(common.select("code", "lang", "word"), "code")
        .groupBy("codes")
        .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("codes", "lang", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"))
        .join(totals, "lang")
    )
    halves = phrases.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k")).select(
        "codes",
        "a",
        "k",
        F.expr("slice(codes, 1, k)").alias("head"),
        F.expr("slice(codes, k + 1, size(codes) - k)").alias("tail"),
    )
    cuts = (
        halves.join(parts.select(F.col("codes").alias("head"), F.col("a").alias("l")), "head")
        .join(parts.select(F.col("codes").alias("tail"), F.col("a").alias("r")), "tail")
        .join(spelled.select("codes", "lang", "phrase", "n"), "codes")
    )
    exact = "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0)))"
    score = F.expr(f"{exact} div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))")
    scored = (
        cuts.select("codes", "lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("codes", "lang", "phrase", "a", "n")
        .agg(F.min("cut").alias("cut"))
    )
    longer = (
        phrases.where(F.size("codes") > 2)
        .select("a", F.explode(F.expr("array(slice(codes, 1, size(codes) - 1), slice(codes, 2, size(codes) - 1))")).alias("codes"))
        .groupBy("codes")
        .agg(F.max("a").alias("around"))
    )
    kept = (
        scored.join(longer, "codes", "left")
        .where("around IS NULL OR 100 * around < 100 * a")
        .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    )
    # first within slices of a language, so that the last window sees no more than slices * first rows of it
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    ahead = slices.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= first)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
