"""Benchmark decontamination: a broadcast hash set of test n-grams over token windows.

The benchmark's windows of ``n`` words are broadcast as sorted hashes with their
words. Each document is scanned once: a bit table screens the hash of every word
window, a sorted search confirms the hash, and the words themselves confirm the hit.
A benchmark with more than ``BLOCK_WINDOWS`` distinct windows is dealt into blocks by
window, and the documents pass through one block after the other, so what is
broadcast at once stays bounded whatever the size of the benchmark.

Defined cases: null text has no words; an item of fewer than ``n`` words (but some)
is one window; items without id are hit but not listed; repeated items are one;
rows and further columns of ``docs`` are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize, with_columns
from ratewright.llm.words import ALNUM, chunks, rolling, words_of

BLOCK_WINDOWS = 250_000
SCREEN_BITS = 22
MARKS = "n_words bigint, hit_starts array<int>, hit_ends array<int>, hit_chars array<int>, items array<bigint>"


def _windows(n: int):
    """(words, width, item) of every benchmark window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, widths, hashes, items = [], [], [], []
            ids = batch.column(0).to_pylist()
            for start, end in chunks(batch.column(1)):
                words = words_of(batch.column(1).slice(start, end - start), ALNUM)
                for row in range(end - start):
                    first, last = int(words.first[row]), int(words.first[row + 1])
                    width = min(n, last - first)
                    if not width:
                        continue
                    for at, code in enumerate(rolling(words.hashes[first:last], width).view(np.int64)):
                        texts.append(words.text(first + at, width))
                        widths.append(width)
                        hashes.append(int(code))
                        items.append(ids[start + row])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.binary()),
                    pa.array(widths, pa.int32()),
                    pa.array(hashes, pa.int64()),
                    pa.array(items, pa.int64()),
                ],
                names=["words", "width", "code", "item"],
            )

    return run


@dataclass
class _Block:
    """Windows of one width, sorted by hash; equal hashes stand side by side."""

    width: int
    codes: np.ndarray
    words: list[bytes]
    items: list[list[int]]

    def __post_init__(self) -> None:
        self.screen = np.zeros(1 << SCREEN_BITS, dtype=bool)
        self.screen[self.codes & np.uint64((1 << SCREEN_BITS) - 1)] = True

    def find(self, codes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.screen[codes & np.uint64((1 << SCREEN_BITS) - 1)])
        place = np.searchsorted(self.codes, codes[at])
        place[place == len(self.codes)] = 0
        return at[self.codes[place] == codes[at]]

    def match(self, code: np.uint64, words: bytes) -> list[int] | None:
        place = int(np.searchsorted(self.codes, code))
        while place < len(self.codes) and self.codes[place] == code:
            if self.words[place] == words:
                return self.items[place]
            place += 1
        return None


def _blocks(rows) -> list[_Block]:
    widths: dict[int, list] = {}
    for row in rows:
        widths.setdefault(row.width, []).append(row)
    blocks = []
    for width, own in sorted(widths.items()):
        codes = np.array([r.code for r in own], dtype=np.int64).view(np.uint64)
        order = np.argsort(codes, kind="stable")
        blocks.append(
            _Block(width, codes[order], [bytes(own[i].words) for i in order], [list(own[i].items) for i in order])
        )
    return blocks


def _scan(shared):
    """Adds the hits of one block of windows to each document's marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[_Block] = shared.value
        for batch in batches:
            names = batch.schema.names
            text = batch.column(names.index("text"))
            before = (
                [batch.column(names.index(c)).to_pylist() for c in ("hit_starts", "hit_ends", "items")]
                if "n_words" in names
                else None
            )
            out: dict[str, list] = {"n_words": [], "hit_starts": [], "hit_ends": [], "hit_chars": [], "items": []}
            for start, end in chunks(text):
                words = words_of(text.slice(start, end - start), ALNUM)
                covered = np.zeros(len(words.hashes) + 1, dtype=np.int32)
                row_of_word = np.searchsorted(words.first, np.arange(len(words.hashes)), side="right") - 1
                listed: dict[int, set[int]] = {}
                for block in blocks:
                    codes = rolling(words.hashes, block.width)
                    for at in block.find(codes).tolist():
                        row = int(row_of_word[at])
                        if at + block.width > words.first[row + 1]:
                            continue
                        items = block.match(codes[at], words.text(at, block.width))
                        if items is not None:
                            covered[at] += 1
                            covered[at + block.width] -= 1
                            listed.setdefault(row, set()).update(items)
                hit = np.cumsum(covered[:-1]) > 0
                for row in range(end - start):
                    first, last = int(words.first[row]), int(words.first[row + 1])
                    own, items = hit[first:last], listed.get(row, set())
                    if before:
                        for s, e in zip(before[0][start + row], before[1][start + row]):
                            own[s:e] = True
                        items |= set(before[2][start + row])
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], own, [False]))))
                    begins, ends = edge[::2], edge[1::2]
                    base = words.offsets[row]
                    out["n_words"].append(last - first)
                    out["hit_starts"].append(begins.tolist())
                    out["hit_ends"].append(ends.tolist())
                    spans = np.empty(2 * len(begins), dtype=np.int64)
                    spans[::2] = words.starts[first + begins] - base
                    spans[1::2] = words.ends[first + ends - 1] - base
                    out["hit_chars"].append(spans.tolist())
                    out["items"].append(sorted(items))
            ints = pa.list_(pa.int32())
            yield with_columns(
                batch,
                n_words=pa.array(out["n_words"], pa.int64()),
                hit_starts=pa.array(out["hit_starts"], ints),
                hit_ends=pa.array(out["hit_ends"], ints),
                hit_chars=pa.array(out["hit_chars"], ints),
                items=pa.array(out["items"], pa.list_(pa.int64())),
            )

    return run


def mark_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` with n_words, hit_starts and hit_ends (word numbers of hit runs), hit_chars
    (begin and end byte of each run, in turn) and items. Columns of these names give way.
    """
    clash = [c for c in docs.columns if c in ("n_words", "hit_starts", "hit_ends", "hit_chars", "items")]
    marked = docs.drop(*clash)
    spark = docs.sparkSession
    windows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _windows(n), "words binary, width int, code bigint, item bigint"
    )
    grouped = materialize(
        windows.groupBy("words", "width", "code").agg(F.sort_array(F.collect_set("item")).alias("items")), "windows"
    )
    # collect_set leaves nulls out; lists are as long as the items that share a window
    size = grouped.agg(F.sum(F.size("items") + 1).alias("n")).first().n or 0
    parts = -(-size // BLOCK_WINDOWS) or 1
    kept = [f for f in marked.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [MARKS])
    for part in range(parts):
        # at most about BLOCK_WINDOWS windows and items, whatever the benchmark
        rows = grouped.where(F.pmod(F.xxhash64("code"), F.lit(parts)) == part).collect()
        marked = marked.mapInArrow(_scan(spark.sparkContext.broadcast(_blocks(rows))), schema)
        if part + 1 < parts:
            marked = materialize(marked, "marked")
    return marked


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their columns."""
    return mark_contamination(docs, benchmark, n).where(F.size("hit_starts") == 0).select(*docs.columns)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        texts = []
        for text, spans in zip(
            batch.column(names.index("text")).to_pylist(), batch.column(names.index("hit_chars")).to_pylist()
        ):
            if text is not None and spans:
                data = text.encode()
                edges = [0, *spans, len(data)]
                text = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
            texts.append(text)
        at = names.index("text")
        columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` with every hit run cut out of its text."""
    marked = mark_contamination(docs, benchmark, n)
    return marked.mapInArrow(_cut, marked.schema).select(*docs.columns)
