"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes ``FEATURES`` shares, means and logarithms of counts. Quantile edges cut
each feature into at most ``BINS`` bins, and the model is a sum of one number a bin and
feature, and one number a cell of some pairs of features. The numbers are learned by
cyclic boosting: in every round each feature in turn gets a tree of at most three leaves
over its own bins, fitted to the log-loss gradient of all that went before and shrunk by
``RATE``; then the pairs whose best quartering would lower the loss most are boosted in the
same way by trees of depth two. A tree only adds to a lookup table, so a score is a sum of
table entries, read for all rows at once.

Bounds: at most about ``SAMPLE`` labelled rows are used, chosen by a hash of the id (all of
them where there are fewer); what is broadcast has ``BINS`` numbers a feature and
``BINS * BINS`` a pair. Features read the whole text; texts beyond ``words.CHUNK_BYTES``
are read in segments, whose counts are added and whose word codes are pooled.

Defined cases: null texts are empty, and empty texts are scored like any other (all
features 0); labels that are null or have no document are not used, repeated labels count
repeatedly; without both classes every score is the smoothed share of label 1; other
columns are kept, one called ``score`` gives way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import with_columns
from ratewright.llm.words import NON_SPACE, byte_class, mix, segments, text_buffers, words_of

SAMPLE = 20_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 40
PAIRS = 10
RATE = 0.1
RIDGE = 1.0
LEAST_WEIGHT = 2.0  # least sum of second derivatives in a leaf

_UPPER, _LOWER, _DIGIT, _HIGH, _SPACE, _LINE, _STOP, _MARK, _SYMBOL = range(9)
_KIND = np.full(256, _SYMBOL, dtype=np.int64)
for _kind, _ranges in (
    (_HIGH, [(0x80, 0xFF)]),
    (_UPPER, [(0x41, 0x5A)]),
    (_LOWER, [(0x61, 0x7A)]),
    (_DIGIT, [(0x30, 0x39)]),
    (_SPACE, [(0x20, 0x20), (0x09, 0x0D)]),
    (_LINE, [(0x0A, 0x0A)]),
    (_STOP, [(ord(c), ord(c)) for c in ".?"]),
    (_MARK, [(ord(c), ord(c)) for c in ",;:'\"()-"]),
):
    _KIND[byte_class(*_ranges)] = _kind
_K = np.uint64(0x9E3779B97F4A7C15)

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "beyond_ascii", "space", "stop", "mark", "symbol",
    "symbol_end", "capital_start", "short_words", "long_words", "symbol_words", "distinct_words", "distinct_pairs",
    "commonest_word", "log_lines", "line_words", "distinct_lines", "stops_a_word",
)


def _distinct(owner: np.ndarray, codes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct codes each row has, and how often its commonest occurs."""
    keys = mix(codes + owner.astype(np.uint64) * _K)
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    most = np.zeros(rows, dtype=np.int64)
    np.maximum.at(most, owner[first], counts)
    return np.bincount(owner[first], minlength=rows), most


def features(column: pa.Array, limit: int | None = None) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    out = np.zeros((len(column), len(FEATURES)))
    held: list = []
    at = 0
    for row, some, whole in segments(column, NON_SPACE, limit):
        if whole and held:
            _finish(held, at, out)
            held = []
        at = row if whole else at
        held.append(some)
    if held:
        _finish(held, at, out)
    return out


def _finish(parts: list[pa.Array], at: int, out: np.ndarray) -> None:
    """Features of some whole rows, or of one row in parts, into ``out`` from row ``at`` on."""
    rows = len(parts[0])
    kinds = np.zeros((rows, 9), dtype=np.int64)
    held, gap = [], True
    for part in parts:
        raw, offsets = text_buffers(part)
        raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
        row_of = np.repeat(np.arange(rows), np.diff(offsets))
        kinds += np.bincount(row_of * 9 + _KIND[raw], minlength=rows * 9).reshape(rows, 9)
        words = words_of(part, NON_SPACE)
        lines = np.concatenate(([0], np.cumsum(raw == 0x0A)))
        if not len(words.starts):
            gap |= bool(lines[-1])
            continue
        owner = np.repeat(np.arange(rows), np.diff(words.first))
        opens = np.empty(len(owner), dtype=bool)
        opens[1:] = (lines[words.starts[1:]] > lines[words.ends[:-1]]) | (owner[1:] != owner[:-1])
        opens[0] = gap or lines[words.starts[0]] > 0
        gap = bool(lines[-1] > lines[words.ends[-1]])
        sizes = words.ends - words.starts
        symbols = np.concatenate(([0], np.cumsum(_KIND[raw] == _SYMBOL)))
        has_symbol = symbols[words.ends] > symbols[words.starts]
        first, last = _KIND[raw[words.starts]], _KIND[raw[words.ends - 1]]
        held.append((owner, words.hashes, opens, sizes, has_symbol, first == _UPPER, last == _SYMBOL))
    total = kinds.sum(axis=1)
    some = np.maximum(total, 1)
    table = {
        "log_bytes": np.log1p(total),
        "upper": kinds[:, _UPPER] / np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER], 1),
        "digit": kinds[:, _DIGIT] / some,
        "beyond_ascii": kinds[:, _HIGH] / some,
        "space": (kinds[:, _SPACE] + kinds[:, _LINE]) / some,
        "stop": kinds[:, _STOP] / some,
        "mark": kinds[:, _MARK] / some,
        "symbol": kinds[:, _SYMBOL] / some,
    }
    if held:
        owner, codes, opens, sizes, has_symbol, capital, end = (np.concatenate(x) for x in zip(*held))
        n = np.bincount(owner, minlength=rows)
        each = np.maximum(n, 1)
        share = lambda mask: np.bincount(owner[mask], minlength=rows) / each
        distinct, most = _distinct(owner, codes, rows)
        same = owner[1:] == owner[:-1]
        pairs, _ = _distinct(owner[1:][same], mix(codes[:-1] * _K + codes[1:])[same], rows)
        starts = np.flatnonzero(opens)
        lines = np.bincount(owner[starts], minlength=rows)
        kept, _ = _distinct(owner[starts], np.add.reduceat(mix(codes), starts), rows)
        table |= {
            "log_words": np.log1p(n),
            "word_bytes": np.bincount(owner, weights=sizes, minlength=rows) / each,
            "symbol_end": share(end),
            "capital_start": share(capital),
            "short_words": share(sizes <= 3),
            "long_words": share(sizes >= 15),
            "symbol_words": share(has_symbol),
            "distinct_words": distinct / each,
            "distinct_pairs": pairs / np.maximum(n - 1, 1),
            "commonest_word": most / each,
            "log_lines": np.log1p(lines),
            "line_words": n / np.maximum(lines, 1),
            "distinct_lines": kept / np.maximum(lines, 1),
            "stops_a_word": kinds[:, _STOP] / each,
        }
    for i, name in enumerate(FEATURES):
        if name in table:
            out[at : at + rows, i] = table[name]


# ---- the model -----------------------------------------------------------------------------


@dataclass
class Model:
    """A number a bin of each feature, a number a cell of each pair, and where the bins begin."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS)))
    pairs: list[tuple[int, int]] = field(default_factory=list)
    cells: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS, BINS)))

    def bins(self, values: np.ndarray) -> np.ndarray:
        binned = np.zeros((len(self.edges), len(values)), dtype=np.int64)
        for i, edges in enumerate(self.edges):
            binned[i] = np.searchsorted(edges, values[:, i], side="right")
        return binned

    def logits(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(binned.shape[1], self.intercept)
        for table, at in zip(self.tables, binned):
            total += table[at]
        for (a, b), cells in zip(self.pairs, self.cells):
            total += cells[binned[a], binned[b]]
        return total

    def score(self, column: pa.Array) -> np.ndarray:
        return _sigmoid(self.logits(self.bins(features(column))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _gain(g, h):
    return np.where(h >= LEAST_WEIGHT, g * g / (h + RIDGE), -np.inf)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of ordered bins into two: what it gains over none, and where the second begins."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = g.sum(), h.sum()
    gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h) - total_g**2 / (total_h + RIDGE)
    if not len(gains) or not np.isfinite(gains).any():
        return -np.inf, 0
    best = int(np.argmax(gains))
    return float(gains[best]), best + 1


def _three_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Steps of a tree over one feature's bins: a cut, and a further cut of the better side."""
    gain, cut = _cut(g, h)
    parts = [(0, len(g))]
    if gain > 0:
        parts = [(0, cut), (cut, len(g))]
        again = [(*_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(again)
        if gain > 0:
            parts = sorted([p for p in parts if p != (a, b)] + [(a, a + at), (a + at, b)])
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return step


def _corners(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the four quarters of a grid for every cut of both sides."""
    c = x.cumsum(axis=0).cumsum(axis=1)
    low = c[:-1, :-1]
    above, left, all_ = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
    return low, above - low, left - low, all_ - above - left + low


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """The best quartering of a grid: what it gains over the best that one side alone could do, and its cut."""
    gains = sum(_gain(x, np.maximum(y, LEAST_WEIGHT)) for x, y in zip(_corners(g), _corners(h)))
    plain = max(0.0, _cut(g.sum(axis=1), h.sum(axis=1))[0], _cut(g.sum(axis=0), h.sum(axis=0))[0])
    best = int(np.argmax(gains))
    i, j = np.unravel_index(best, gains.shape)
    return float(gains[i, j] - g.sum() ** 2 / (h.sum() + RIDGE) - plain), int(i) + 1, int(j) + 1


def _grid(binned, a, b, weights):
    return np.bincount(binned[a] * BINS + binned[b], weights=weights, minlength=BINS * BINS).reshape(BINS, BINS)


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """A model of 0/1 ``labels`` over rows of feature values."""
    n1, n = float(labels.sum()), len(labels)
    model = Model(float(np.log((n1 + 1) / (n - n1 + 1))))
    if n1 in (0.0, float(n)):
        return model
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(values[:, i], cuts)) for i in range(values.shape[1])]
    model.tables = np.zeros((values.shape[1], BINS))
    binned = model.bins(values)
    logits = np.full(n, model.intercept)

    def derivatives():
        p = _sigmoid(logits)
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, at in zip(model.tables, binned):
            g, h = derivatives()
            step = RATE * _three_leaves(*(np.bincount(at, weights=w, minlength=BINS) for w in (g, h)))
            table += step
            logits += step[at]
    g, h = derivatives()
    found = []
    for a in range(len(binned)):
        for b in range(a + 1, len(binned)):
            found.append((_quarters(_grid(binned, a, b, g), _grid(binned, a, b, h))[0], a, b))
    model.pairs = [(a, b) for gain, a, b in sorted(found, reverse=True)[:PAIRS] if gain > 0]
    model.cells = np.zeros((len(model.pairs), BINS, BINS))
    for _ in range(PAIR_ROUNDS):
        for (a, b), cells in zip(model.pairs, model.cells):
            g, h = derivatives()
            grids = _grid(binned, a, b, g), _grid(binned, a, b, h)
            _, i, j = _quarters(*grids)
            step = np.zeros((BINS, BINS))
            for rows in (slice(0, i), slice(i, BINS)):
                for columns in (slice(0, j), slice(j, BINS)):
                    step[rows, columns] = RATE * grids[0][rows, columns].sum() / (grids[1][rows, columns].sum() + RIDGE)
            cells += step
            logits += step[binned[a], binned[b]]
    return model


# ---- on tables -------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """A model of ``labels(doc_id, label)`` over ``docs(doc_id, text)``."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id"), (F.col(label) > 0).cast("int").alias("label")
    )
    share = min(1.0, SAMPLE / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    # about SAMPLE rows of two numbers, so the labels may go to every task
    rows = texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = features(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["label", "features"])

    # about SAMPLE rows of FEATURES numbers
    sample = rows.mapInArrow(measure, "label int, features array<double>").toArrow()
    if not sample.num_rows:
        return Model(0.0)
    values = sample.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(values.reshape(-1, len(FEATURES)), sample.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column score from 0 to 1; a column of that name gives way."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("score")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.names.index("text"))
            yield with_columns(batch, score=pa.array(shared.value.score(text), pa.float64()))

    return rest.mapInArrow(run, schema)


def train_fold(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of the id's text leaves 0, 1 or 3 by 4."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
