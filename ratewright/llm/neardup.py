"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard, components.

Two permutations make the whole signature. A shingle's 64-bit hash places it at one
of ``UNIVERSE`` positions (the first permutation); coordinate ``k`` of a set is the
least value that the second permutation, shifted by ``k`` places, has at its
positions. All coordinates of a shingle are thus one contiguous run of one table.

Candidates share a band. Copies (equal sets) are one class from the start, so they
never form pairs. In each band bucket every class is first checked against the
bucket's least id, which joins large groups in linear work. What is still in
different components of a bucket is then compared in bounded cells, where a longer
sketch screens the pairs and the full sets decide; a cell emits true links only.

Defined cases: null or blank text has an empty set and links with nothing; fewer
words than a shingle form one shingle; rows of equal ``doc_id`` are one document; a
row without ``doc_id`` is its own component (null) and is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize
from ratewright.llm.components import connected_components
from ratewright.llm.words import NON_SPACE, chunks, mix, rolling, words_of

UNIVERSE_BITS = 20
ROWS = 4  # coordinates per band
BANDS = 20  # a pair at 0.85 shares no band with probability (1 - 0.85**4)**20 < 4e-7
SKETCH = 256  # coordinates of the screening sketch, one byte each
SKETCH_SLACK = 0.10  # over four standard deviations of the sketch's estimate at 0.8 and more
CELL_BYTES = 4 << 20  # of shingle sets per salt of a cell


@lru_cache(maxsize=1)
def _shifted() -> np.ndarray:
    """Row ``p`` holds the second permutation's values at ``p``, ``p + 1``, ... (cyclic)."""
    second = np.random.default_rng(11).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[: SKETCH - 1]]), SKETCH)


def signature(shingles: np.ndarray, coordinates: int = SKETCH) -> np.ndarray:
    """Circulant MinHash signature of a non-empty set of 64-bit hashes."""
    table = _shifted()[:, :coordinates]
    places = (shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    least = table[places[:2048]].min(axis=0)
    for start in range(2048, len(places), 2048):
        np.minimum(least, table[places[start : start + 2048]].min(axis=0), out=least)
    return least


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for start, end in chunks(column):
        words = words_of(column.slice(start, end - start), NON_SPACE)
        for row in range(end - start):
            hashes = words.hashes[words.first[row] : words.first[row + 1]]
            yield np.unique(rolling(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_codes = np.random.default_rng(5).integers(1, 1 << 63, (1, ROWS), dtype=np.uint64) | np.uint64(1)
        names = np.arange(BANDS, dtype=np.uint64) << np.uint64(40)
        for batch in batches:
            counts, digests, bands, sketches = [], [], [], []
            for shingles in shingle_sets(batch.column(1), size):
                counts.append(len(shingles))
                if not len(shingles):
                    digests.append(None)
                    bands.append([])
                    sketches.append(None)
                    continue
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                values = signature(shingles)
                rows = values[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
                bands.append(mix(mix((rows * band_codes).sum(axis=1)) + names).view(np.int64))
                sketches.append(values.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for start, end in chunks(column):
                part = column.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array([s.tobytes() for s in shingle_sets(part, size)], pa.binary()),
                    ],
                    names=["id", "shingles"],
                )

    return run


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether 100 * |one & two| >= percent * |one | two| for sorted distinct arrays."""
    small, large = (one, two) if len(one) <= len(two) else (two, one)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ones, twos = batch.column("shingles_a"), batch.column("shingles_b")
            keep = [
                similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                for a, b in zip(ones, twos)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _cells(percent: int):
    """True links between members of different components within each cell row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = int(SKETCH * (percent / 100 - SKETCH_SLACK))
        for batch in batches:
            ones, twos = [], []
            for low, diagonal, members in zip(
                batch.column("low").to_pylist(), batch.column("diagonal").to_pylist(), batch.column("members")
            ):
                rows = members.values
                ids = rows.field("id").to_numpy()
                component = rows.field("component").to_numpy()
                count = rows.field("n").to_numpy()
                size_class = rows.field("size_class").to_numpy()
                salt = rows.field("salt").to_numpy()
                sketch = np.frombuffer(b"".join(rows.field("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
                sets = rows.field("shingles")
                for i in range(len(ids) - 1):
                    # pairs of two upper-class members belong to the next cell; off the
                    # diagonal, only pairs of different salts are this cell's own
                    own = (component[i + 1 :] != component[i]) & (
                        (size_class[i + 1 :] == low) | (size_class[i] == low)
                    )
                    if not diagonal:
                        own &= salt[i + 1 :] != salt[i]
                    shorter = np.minimum(count[i + 1 :], count[i])
                    own &= 100 * shorter >= percent * np.maximum(count[i + 1 :], count[i])
                    others = np.flatnonzero(own) + i + 1
                    if not len(others):
                        continue
                    others = others[(sketch[others] == sketch[i]).sum(axis=1) >= least]
                    if len(others):
                        mine = np.frombuffer(sets[i].as_buffer(), np.uint64)
                    for j in others:
                        if similar(mine, np.frombuffer(sets[int(j)].as_buffer(), np.uint64), percent):
                            ones.append(int(ids[i]))
                            twos.append(int(ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(ones, pa.int64()), pa.array(twos, pa.int64())], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs(doc_id, text)``.

    Documents are linked when their shingle sets have a Jaccard similarity of at
    least ``percent`` hundredths; ``component_id`` is the least id reachable.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(
        texts.mapInArrow(
            _signatures(shingle_words),
            "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch binary",
        ),
        "signatures",
    )
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    heads = usable.join(
        classes.withColumnsRenamed({"digest": "class", "id": "head"}),
        (F.col("digest") == F.col("class")) & (F.col("doc_id") == F.col("head")),
        "left_semi",
    )
    slots = heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    buckets = slots.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    seats = materialize(
        slots.join(buckets.where("leader < last").drop("last"), "bucket").select("bucket", "id", "leader"), "seats"
    )

    needed = seats.select("id").distinct()
    sets = materialize(
        texts.join(needed, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(
            _sets(shingle_words), "id bigint, shingles binary"
        ),
        "shingle_sets",
    )
    pairs = seats.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = materialize(
        pairs.join(sets.toDF("a", "shingles_a"), "a")
        .join(sets.toDF("b", "shingles_b"), "b")
        .mapInArrow(_verify(percent), "a bigint, b bigint"),
        "leader_links",
    )
    groups = connected_components(links)
    across = materialize(_links_across(seats, heads, sets, groups, percent), "cell_links")
    if across.limit(1).count():
        groups = connected_components(links.union(across).distinct())

    named = (
        classes.join(groups.withColumnRenamed("component", "of_group"), "id", "left")
        .select("digest", F.coalesce("of_group", "id").alias("of_class"))
    )
    return (
        signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", F.coalesce("of_class", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links_across(seats: DataFrame, heads: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links between classes that share a bucket but were left in different components.

    A member stands in the cell of its size class and in the one below, as similar
    sets are in equal or neighbouring classes. A bucket with many shingles has its
    cells cut into pairs of salts, so a cell holds at most about two CELL_BYTES.
    """
    features = (
        heads.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
        .dropDuplicates(["id"])
        .join(sets.dropDuplicates(["id"]), "id")
    )
    placed = seats.join(groups, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("one"), F.max("component").alias("other"), F.count(F.lit(1)).alias("seated"))
        .where("one < other")
        .select("bucket", "seated")
    )
    width = float(np.log(100 / percent)) if percent < 100 else 1e-3
    members = (
        placed.join(mixed, "bucket")
        .join(features, "id")
        .withColumn("size_class", F.floor(F.log(F.col("n").cast("double")) / width + 1e-9))
        .withColumn("salts", F.ceil(F.col("seated") * F.col("n") * 8 / F.lit(CELL_BYTES) / 4).cast("int"))
    )
    # neighbours in size must agree on the number of salts, so it comes from the bucket
    salts = members.groupBy("bucket").agg(F.max("salts").alias("salts"))
    members = (
        members.drop("salts")
        .join(salts, "bucket")
        .withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int"))
        .select(
            "bucket",
            F.struct("id", "component", "n", "size_class", "salt", "sketch", "shingles").alias("member"),
            F.explode(
                F.expr(
                    "flatten(transform(sequence(0, salts - 1), t -> array("
                    "named_struct('low', size_class, 'first', least(t, salt), 'second', greatest(t, salt)),"
                    "named_struct('low', size_class - 1, 'first', least(t, salt), 'second', greatest(t, salt)))))"
                )
            ).alias("cell"),
        )
    )
    cells = (
        members.groupBy("bucket", "cell")
        .agg(
            F.collect_list("member").alias("members"),
            F.min("member.component").alias("one"),
            F.max("member.component").alias("other"),
            F.min("member.size_class").alias("smallest"),
        )
        .where("one < other AND smallest = cell.low")
        .select(
            F.col("cell.low").alias("low"), (F.col("cell.first") == F.col("cell.second")).alias("diagonal"), "members"
        )
    )
    return cells.mapInArrow(_cells(percent), "a bigint, b bigint").distinct()
