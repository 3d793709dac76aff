"""Toxicity: a character n-gram linear classifier scaled by naive Bayes log-count ratios.

Features are the distinct byte n-grams of the lower-cased text with its white space
runs made one space and a space at either end, hashed into ``DIMENSION`` buckets. Over
the labelled rows, Spark counts in how many toxic and in how many other documents each
occurs; the log ratio of the smoothed shares scales the feature. The ``FEATURES`` with
the clearest difference (a two-proportion z value) enter an L2-regularised logistic
regression. Scoring reads each text once and looks features up in a table.

Bounds: at most about ``SAMPLE`` labelled rows are used, chosen by a hash of the id
(all of them where there are fewer); the model has ``FEATURES`` weights.

Defined cases: null or empty texts score by the intercept; labels that are null or
have no document are not used; without both classes every score is 0.0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize, with_columns
from ratewright.llm.words import _BYTE_CODES, NON_SPACE, _LOWER, chunks, rolling, text_buffers

SIZES = (5, 7)
CHUNK = 1 << 19  # bytes of text at once; n-grams take some sixty times as much
DIMENSION_BITS = 20
FEATURES = 2000
SAMPLE = 12_000
SMOOTHING = 1.0
PENALTY = 5e-4
STEPS = 300


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of the rows of ``column``."""
    data, offsets = text_buffers(column)
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    rows = len(offsets) - 1
    # one space for each run of white space and at both ends of every text
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    solid = NON_SPACE[data]
    data = np.where(solid, data, np.uint8(32))
    again = ~solid[1:] & ~solid[:-1] & (row_of[1:] == row_of[:-1])
    keep = np.concatenate(([True], ~again)) if len(data) else np.empty(0, bool)
    data, row_of = data[keep], row_of[keep]
    at = np.searchsorted(row_of, np.arange(rows + 1))
    data = np.insert(data, np.concatenate((at[:-1], at[1:])), np.uint8(32))
    row_of = np.concatenate((np.repeat(np.arange(rows), np.diff(at) + 2), [rows]))
    out_rows, out_codes = [], []
    for size in SIZES:
        codes = rolling(_BYTE_CODES[data], size)
        inside = np.flatnonzero(row_of[: len(codes)] == row_of[size - 1 : size - 1 + len(codes)])
        out_rows.append(row_of[inside])
        out_codes.append((codes[inside] >> np.uint64(64 - DIMENSION_BITS)).astype(np.int64))
    return np.concatenate(out_rows), np.concatenate(out_codes)


def _distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((rows.astype(np.int64) << DIMENSION_BITS) | values)
    return both >> DIMENSION_BITS, both & ((1 << DIMENSION_BITS) - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, other) document counts of a partition of (text, toxic)."""
    totals = np.zeros((2, 1 << DIMENSION_BITS), dtype=np.int32)
    for batch in batches:
        toxic = np.array(batch.column(1).to_pylist(), dtype=np.int64)
        for start, end in chunks(batch.column(0), CHUNK):
            rows, features = _distinct(*grams(batch.column(0).slice(start, end - start)))
            mark = toxic[start + rows]
            for label in (0, 1):
                totals[label] += np.bincount(features[mark == label], minlength=1 << DIMENSION_BITS).astype(np.int32)
    seen = np.flatnonzero(totals.any(axis=0))
    for start in range(0, len(seen), 100_000):
        some = seen[start : start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(totals[1][some]), pa.array(totals[0][some])],
            names=["feature", "toxic", "other"],
        )


@dataclass
class Model:
    """``index`` maps a bucket to 1 + its feature, or 0; ``weights`` includes the ratio."""

    index: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        logits = np.full(len(column), self.intercept)
        for start, end in chunks(column, CHUNK):
            rows, features = self.found(column.slice(start, end - start))
            logits[start:end] += np.bincount(rows, weights=self.weights[features], minlength=end - start)
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))

    def found(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, codes = grams(column)
        features = self.index[codes]
        hit = np.flatnonzero(features)
        rows, features = _distinct(rows[hit], features[hit].astype(np.int64) - 1)
        return rows, features


def _fit(rows: np.ndarray, features: np.ndarray, ratios: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio by accelerated gradient steps."""
    n, k = len(labels), len(ratios)
    values = ratios[features]
    counts = np.bincount(rows, weights=values**2, minlength=n)
    rate = 1.0 / (0.25 * max(1.0, float(counts.max(initial=0.0)) + 1) + PENALTY)
    base = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    weights, intercept = np.zeros(k), base
    ahead, ahead_intercept = weights, intercept
    rate *= min(8.0, np.sqrt(n))
    for step in range(STEPS):
        logits = np.bincount(rows, weights=values * ahead[features], minlength=n) + ahead_intercept
        error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels) / n
        gradient = np.bincount(features, weights=values * error[rows], minlength=k) + PENALTY * ahead
        moved, moved_intercept = ahead - rate * gradient, ahead_intercept - rate * error.sum()
        pull = step / (step + 3)
        ahead = moved + pull * (moved - weights)
        ahead_intercept = moved_intercept + pull * (moved_intercept - intercept)
        weights, intercept = moved, moved_intercept
    return weights * ratios, intercept


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels(doc_id, toxic)`` over ``docs(doc_id, text)``."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("_toxic")
    )
    total = known.count()
    share = min(1.0, SAMPLE / max(1, total))
    chosen = known.where(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000))
    # about SAMPLE rows of two numbers, so the labels may go to every task
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select(
        F.col("text").cast("string").alias("text"), "_toxic"
    )
    rows = materialize(rows, "labelled")
    sizes = {r._toxic: r.n for r in rows.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = Model(np.zeros(1 << DIMENSION_BITS, np.int32), np.zeros(0), -50.0)
    if len(sizes) < 2:
        return empty
    n1, n0 = sizes[1], sizes[0]
    counted = rows.mapInArrow(_counts, "feature int, toxic int, other int").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    p, q = F.col("toxic") / n1, F.col("other") / n0
    pooled = (F.col("toxic") + F.col("other")) / (n1 + n0)
    clearness = F.abs(p - q) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0) + 1e-12)
    best = (
        counted.where("toxic + other > 2")
        .withColumn("z", clearness)
        .orderBy(F.desc("z"), "feature")
        .limit(FEATURES)  # the size of the model
        .collect()
    )
    if not best:
        return empty
    toxic = np.array([r.toxic for r in best], dtype=float) + SMOOTHING
    other = np.array([r.other for r in best], dtype=float) + SMOOTHING
    ratios = np.log((toxic / (n1 + 2 * SMOOTHING)) / (other / (n0 + 2 * SMOOTHING)))
    index = np.zeros(1 << DIMENSION_BITS, dtype=np.int32)
    index[[r.feature for r in best]] = np.arange(1, len(best) + 1)
    model = Model(index, np.zeros(len(best)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in chunks(batch.column(0), CHUNK):
                found, features = shared.value.found(batch.column(0).slice(start, end - start))
                edges = np.searchsorted(found, np.arange(end - start + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(features.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(start, end - start), lists], names=["toxic", "features"]
                )

    # at most about SAMPLE rows of at most FEATURES numbers
    sample = rows.mapInArrow(presence, "toxic int, features array<int>").toArrow()
    lists = sample.column("features").combine_chunks()
    owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    flat = np.asarray(lists.flatten()).astype(np.int64)
    truth = np.asarray(sample.column("toxic")).astype(float)
    model.weights, model.intercept = _fit(owner, flat, ratios, truth)
    shared.unpersist()
    return model


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
    """Labels that may be learned from: crc32 of the id's text is not divisible by 5."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
