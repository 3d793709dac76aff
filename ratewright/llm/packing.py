"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut into full pieces; the first piece takes the
rest. Pieces are dealt evenly by hash into blocks of about ``BLOCK`` pieces. For every
block several islands evolve groupings of the pieces into bins: crossover injects the
well-filled bins of one parent into another, takes out bins with pieces placed twice,
and puts the displaced pieces back best-fit decreasing; mutation dissolves the
emptiest bins. After each epoch an island's best grouping migrates to the next
island of its block. A block whose bins reach the lower bound (total length over
capacity) is finished. A last level gathers the slack bins of all blocks into new
blocks, starting from their present grouping, so it can only save sequences.

Defined cases: null text is empty (its only token is the end id); repeated rows and
null ids are pieces of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize
from ratewright.llm.tokens import AT_ONCE, CACHE_UNITS, SPACED, encoder
from ratewright.llm.words import chunks

BLOCK = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 12
POPULATION = 4
SLACK = 0.97  # bins filled less go to the last level

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(path: str, units: str, capacity: int, end_id: int, with_ids: bool, cache_units: int, at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, units, cache_units)
        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 40
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for first, last in chunks(batch.column(1), at_once):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                ids = batch.column(0).slice(first, last - first).to_pylist()
                out: list[tuple] = []
                for doc_id, data in zip(ids, own.encode([t or "" for t in texts])):
                    data += end
                    count = len(data) // 4
                    start, number = 0, 0
                    while start < count:
                        length = (count - start) % capacity or capacity
                        part = data[4 * start : 4 * (start + length)]
                        out.append((doc_id, number, start, length, zlib.crc32(part), row, part if with_ids else None))
                        start += length
                        number += 1
                        row += 1
                columns = list(zip(*out)) if out else [[]] * 7
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "row", "ids"]
                count = 7 if with_ids else 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns[:count], kinds)], names=names[:count]
                )

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    units: str = SPACED,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    cache_units: int = CACHE_UNITS,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document, with a row number unique in the table."""
    schema = f"{PIECE}, row bigint" + (", ids binary" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = _pieces(tokenizer_path, units, capacity, end_id, with_ids, cache_units, at_once)
    return texts.mapInArrow(pieces, schema)


class Grouping:
    """Bins of pieces: lists of piece numbers, and their fills."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.fills: list[int] = []
        self._fitness: tuple[int, float] | None = None

    @classmethod
    def of(cls, sizes: list[int], capacity: int, places: list[int]) -> Grouping:
        out = cls(sizes, capacity)
        by_bin: dict[int, list[int]] = {}
        for item, place in enumerate(places):
            by_bin.setdefault(place, []).append(item)
        for group in by_bin.values():
            out.add_bin(group, out.fill(group))
        return out

    def fill(self, group: list[int]) -> int:
        return sum(map(self.sizes.__getitem__, group))

    def add_bin(self, group: list[int], fill: int) -> None:
        self.bins.append(group)
        self.fills.append(fill)
        self._fitness = None

    def by_fill(self, reverse: bool = False) -> list[int]:
        """Bin numbers, emptiest first, or fullest first."""
        return sorted(range(len(self.bins)), key=self.fills.__getitem__, reverse=reverse)

    def add_best_fit(self, items: list[int], shuffle: random.Random | None = None) -> None:
        """Place items, longest first, each where the least room stays."""
        sizes, capacity, bins, fills = self.sizes, self.capacity, self.bins, self.fills
        open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        rooms = 0  # bit r is set when a bin with r free tokens exists
        for place, fill in enumerate(fills):
            open_bins[capacity - fill].append(place)
            rooms |= 1 << (capacity - fill)
        if shuffle:
            order = sorted(items, key=lambda i: sizes[i] * (0.9 + 0.2 * shuffle.random()), reverse=True)
        else:
            order = sorted(items, key=sizes.__getitem__, reverse=True)
        for item in order:
            size = sizes[item]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                place = open_bins[room].pop()
                if not open_bins[room]:
                    rooms &= ~(1 << room)
                bins[place].append(item)
                fills[place] += size
            else:
                place, room = len(bins), capacity
                bins.append([item])
                fills.append(size)
            open_bins[room - size].append(place)
            rooms |= 1 << (room - size)
        self._fitness = None

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then more unequal fills."""
        if self._fitness is None:
            self._fitness = -len(self.bins), sum((fill / self.capacity) ** 2 for fill in self.fills)
        return self._fitness

    def places(self) -> list[int]:
        out = [0] * len(self.sizes)
        for place, group in enumerate(self.bins):
            for item in group:
                out[item] = place
        return out


def crossover(one: Grouping, two: Grouping, rng: random.Random) -> Grouping:
    """``one`` with well-filled bins of ``two`` injected; displaced pieces go in best-fit."""
    child = Grouping(one.sizes, one.capacity)
    full = two.by_fill(reverse=True)
    injected = full[: max(1, int(len(full) * rng.uniform(0.2, 0.7)))]
    taken = {i for place in injected for i in two.bins[place]}
    displaced: list[int] = []
    for group, fill in zip(one.bins, one.fills):
        if taken.isdisjoint(group):
            child.add_bin(list(group), fill)
        else:
            displaced.extend(i for i in group if i not in taken)
    for place in injected:
        child.add_bin(list(two.bins[place]), two.fills[place])
    child.add_best_fit(displaced)
    return child


def mutate(one: Grouping, rng: random.Random) -> Grouping:
    """The emptiest bins and some others dissolved and filled anew."""
    child = Grouping(one.sizes, one.capacity)
    order = one.by_fill()
    count = max(2, len(order) // 20)
    gone = order[:count] + rng.sample(order[count:], min(count, len(order) - count))
    chosen = set(gone)
    for place, group in enumerate(one.bins):
        if place not in chosen:
            child.add_bin(list(group), one.fills[place])
    child.add_best_fit([i for place in gone for i in one.bins[place]], rng)
    return child


def evolve(
    sizes: list[int], capacity: int, known: list[list[int]], seed: int, generations: int = GENERATIONS
) -> list[int]:
    """Bin number of every piece: the best grouping found from the ``known`` ones."""
    rng = random.Random(seed)
    bound = -(-sum(sizes) // capacity)
    start = Grouping(sizes, capacity)
    start.add_best_fit(list(range(len(sizes))))
    people = [start, *(Grouping.of(sizes, capacity, places) for places in known)]
    people.sort(key=Grouping.fitness, reverse=True)
    if len(people[0].bins) <= bound or len(sizes) < 3:
        return people[0].places()
    while len(people) < POPULATION:
        people.append(mutate(people[0], rng))
    for _ in range(generations):
        people.sort(key=Grouping.fitness, reverse=True)
        if len(people[0].bins) <= bound:
            break
        one, two = rng.sample(people[:POPULATION], 2)
        people = [*people[: POPULATION - 2], crossover(one, two, rng), mutate(people[0], rng)]
    return max(people, key=Grouping.fitness).places()


STATE = "block bigint, island int, sizes array<int>, best array<int>, bins int, bound int"


def _epoch(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                known = [p for p in (row["best"], row["guest"]) if p]
                sizes = row["sizes"]
                best = evolve(sizes, capacity, known, hash((row["block"], row["island"], epoch)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["island"]], pa.int32()),
                        pa.array([sizes], pa.list_(pa.int32())),
                        pa.array([best], pa.list_(pa.int32())),
                        pa.array([max(best) + 1], pa.int32()),
                        pa.array([-(-sum(sizes) // capacity)], pa.int32()),
                    ],
                    names=["block", "island", "sizes", "best", "bins", "bound"],
                )

    return run


def _evolved(blocks: DataFrame, capacity: int) -> DataFrame:
    """(block, best) of blocks (block, sizes, first: a known grouping or null)."""
    state = blocks.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        "sizes",
        F.col("first").alias("best"),
        F.lit(None).cast("array<int>").alias("guest"),
    )
    # an island's first epoch may already reach the bound: the islands then agree
    state = materialize(state.mapInArrow(_epoch(capacity, 0), STATE), "islands")
    done = state.groupBy("block").agg(F.min("bins").alias("least"), F.min("bound").alias("bound"))
    finished = [state]
    for epoch in range(1, EPOCHS):
        open_blocks = done.where("least > bound").select("block")
        going = state.join(open_blocks, "block", "left_semi")
        elites = going.select(
            "block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("best").alias("guest")
        )
        state = materialize(
            going.join(elites, ["block", "island"])
            .select("block", "island", "sizes", "best", "guest")
            .mapInArrow(_epoch(capacity, epoch), STATE),
            "islands",
        )
        done = state.groupBy("block").agg(F.min("bins").alias("least"), F.min("bound").alias("bound"))
        finished.append(state)
    every = finished[0]
    for more in finished[1:]:
        every = every.unionByName(more)
    return every.groupBy("block").agg(F.min_by("best", F.struct("bins", "island")).alias("best"))


def _bins(capacity: int):
    """One row per bin of each block row (block, items, best), with its pieces in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("items").type
            for row in range(batch.num_rows):
                items = batch.column("items")[row].values
                best = np.array(batch.column("best")[row].values)
                order = np.argsort(best, kind="stable")
                edges = np.concatenate(([0], np.flatnonzero(np.diff(best[order])) + 1, [len(order)]))
                grouped = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), items.take(pa.array(order)))
                lengths = np.array(items.field("length"))[order]
                fills = np.add.reduceat(lengths, edges[:-1])
                block = batch.column("block")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block * (1 << 24) + best[order][edges[:-1]].astype(np.int64), pa.int64()),
                        pa.array(fills, pa.int64()),
                        grouped.cast(kind),
                    ],
                    names=["sequence_id", "fill", "items"],
                )

    return run


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` with sequence_id and offset; sequences hold at most ``capacity`` tokens.

    ``pieces`` needs length and a unique row; it is read several times, so it should be a stored table.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    item = F.struct(*names)
    full = pieces.where(F.col("length") >= capacity)
    part = pieces.where(F.col("length") < capacity)
    blocks_of = lambda n: max(1, -(-n // BLOCK))
    n_blocks = blocks_of(part.count())

    blocks = materialize(
        part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
        .groupBy("block")
        .agg(F.collect_list(item).alias("items")),
        "blocks",
    )
    bin_type = f"sequence_id bigint, fill bigint, items {blocks.schema['items'].dataType.simpleString()}"
    sized = blocks.select(
        "block",
        F.transform("items", lambda i: i["length"].cast("int")).alias("sizes"),
        F.lit(None).cast("array<int>").alias("first"),
    )
    bins = materialize(
        blocks.join(_evolved(sized, capacity), "block").mapInArrow(_bins(capacity), bin_type), "bins"
    )

    slack = bins.where(F.col("fill") < SLACK * capacity)
    slack_items = slack.agg(F.sum(F.size("items")).alias("n")).first().n or 0
    rest = bins.where(F.col("fill") >= SLACK * capacity)
    if slack_items:
        n_slack = blocks_of(slack_items)
        numbered = slack.withColumn("block", F.pmod(F.xxhash64("sequence_id"), F.lit(n_slack))).groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("sequence_id", "items"))).alias("bins")
        )
        again = materialize(
            numbered.select(
                "block",
                F.flatten(F.col("bins.items")).alias("items"),
                F.expr("flatten(transform(bins, (b, n) -> array_repeat(n, size(b.items))))").alias("first"),
            ),
            "slack_blocks",
        )
        resized = again.select(
            "block", F.transform("items", lambda i: i["length"].cast("int")).alias("sizes"), "first"
        )
        repacked = (
            again.drop("first")
            .join(_evolved(resized, capacity), "block")
            .withColumn("block", F.col("block") + n_blocks)
            .mapInArrow(_bins(capacity), bin_type)
        )
        rest = rest.unionByName(repacked)
    offsets = F.expr(
        "slice(aggregate(items, array(0L), (a, i) -> array_append(a, element_at(a, -1) + i.length)), 1, size(items))"
    )
    placed = rest.select("sequence_id", F.explode(F.arrays_zip("items", offsets.alias("offsets"))).alias("p")).select(
        *[F.col(f"p.items.{c}").alias(c) for c in names], "sequence_id", F.col("p.offsets").alias("offset")
    )
    own = full.select(*names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(own)
