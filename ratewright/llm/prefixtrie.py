"""Conversation prefix trie: node intervals from sorted LCPs by range-minimum search.

Every conversation becomes one sequence of 16-byte turn digests. Spark sorts the
sequences over range partitions ("blocks"); in that order the members of a trie node
are neighbours. Each block keeps the longest common prefix (LCP) of each sequence with
the one before it, in turns, and a sparse table of range minima over these. A candidate
prefix is a (sequence, depth) pair: every sequence's own end and every LCP between
neighbours. Each candidate searches its left and its right extent by itself, by halving
steps through the sparse table; no stack and no order among candidates is needed.
Depths at which nothing branches or ends share the interval of the next candidate below.

A node that crosses the edge between two blocks is handled by the edge: at an edge with
LCP ``c`` exactly one node of each depth 0..c crosses. The block of its first member finds
the left extent, the block of its last member the right one, and a second sparse table
over one minimum per block (at most ``MAX_BLOCKS`` numbers) says which blocks belong
together. So no task ever holds more than a block, however common a prefix is.

Counts, leaves and saved bytes of an interval are differences of prefix sums; the least
conversation id is a range minimum. Hashes of ending members are made where the node
lies; those of crossing nodes stream the blocks' joined id lists in order through one
task, so a common conversation costs one row a block there.

Defined cases: turns are ordered by number, null first, equal numbers by digest of role
and text, so repeated rows are repeated turns; null role or text is empty; rows without
conversation id belong to none and are left out; ``c % 5`` has the sign of c; an empty
table gives no nodes (the root would have no member to name it); other columns are not
read. Texts are read once, where their digest is made, and never shuffled, so their
length does not matter; one conversation is one row of 24 bytes a turn in a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize

BLOCK_TURNS = 16_384  # turns a block holds on average
MAX_BLOCKS = 1 << 20  # bound of what is broadcast: a few numbers a block
DIGEST = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max


# ---- sequences -------------------------------------------------------------------


def conversation_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, path): the digest and text bytes of each turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("bytes")
        ).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select(
        "conv_id", F.transform("ts", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("path")
    )


def share_heads(paths: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of ``c - c % group``.

    ``h`` is crc32 of c's decimal text modulo ``most``; the other conversation gives all
    turns if it has fewer, and none if it does not exist.
    """
    heads = paths.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("donor"), F.slice("path", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = paths.select("conv_id", "path", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("donor"))
    given = F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("path", 1, 0)).otherwise(F.expr("slice(head, 1, h)"))
    return own.join(heads, "donor", "left").select(
        "conv_id",
        F.concat(given, F.expr("IF(size(path) > h, slice(path, h + 1, size(path) - h), slice(path, 1, 0))")).alias("path"),
    )


# ---- arrays of a block -------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level j holds the minimum of each run of 2**j values."""
    table, width = [values], 1
    while 2 * width <= len(values):
        last = table[-1]
        table.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return table


def range_min(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low..high]``, both included; low <= high."""
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    out = np.empty(len(low), dtype=np.int64)
    for j in np.unique(level):
        at = np.flatnonzero(level == j)
        out[at] = np.minimum(table[j][low[at]], table[j][high[at] - (1 << int(j)) + 1])
    return out


def search_left(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last position p <= at with value < depth, or -1: halving steps through the table."""
    end = at + 1  # every value in [end, at] is >= depth
    for j in reversed(range(len(table))):
        low = end - (1 << j)
        fits = np.flatnonzero(low >= 0)
        fits = fits[table[j][low[fits]] >= depth[fits]]
        end[fits] = low[fits]
    return end - 1


def search_right(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first position p >= at with value < depth, or the number of values."""
    n = len(table[0])
    start = at.copy()
    for j in reversed(range(len(table))):
        fits = np.flatnonzero(start + (1 << j) <= n)
        fits = fits[table[j][start[fits]] >= depth[fits]]
        start[fits] += 1 << j
    return start


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests as pairs of 64-bit numbers, and the row offsets in them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return np.ascontiguousarray(data).view(np.uint64).reshape(-1, 2), (offsets - offsets[0]) // DIGEST


def neighbour_lcp(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """LCP in turns of each row with the row before it; -1 for the first."""
    lengths = np.diff(offsets)
    both = np.minimum(lengths[1:], lengths[:-1])
    edges = np.concatenate(([0], np.cumsum(both)))
    row = np.repeat(np.arange(len(both)), both)
    step = np.arange(edges[-1]) - edges[row]
    here, before = offsets[1:-1][row] + step, offsets[:-2][row] + step
    differs = np.flatnonzero((digests[here] != digests[before]).any(axis=1))
    lcp = both.copy()
    rows, first = np.unique(row[differs], return_index=True)
    lcp[rows] = step[differs[first]]
    return np.concatenate(([-1], lcp))


_RANKED = "block int, idx int, conv_id bigint, lcp int, following int, cum array<bigint>, edge binary"


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted partition: LCPs within it, cumulative text bytes, and its two edge sequences."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    whole = pa.Table.from_batches(rows).combine_chunks()
    sequence = whole.column("key").chunk(0)
    digests, offsets = _binary(sequence)
    lcp = neighbour_lcp(digests, offsets)
    sizes = whole.column("sizes").chunk(0)
    values = np.concatenate(([0], np.cumsum(sizes.flatten().to_numpy(zero_copy_only=False))))
    # every row gets 0 and its running byte counts
    starts = np.concatenate(([0], np.cumsum(np.diff(offsets) + 1)))
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], np.diff(starts)) + np.repeat(offsets[:-1], np.diff(starts))
    cum = values[at] - np.repeat(values[offsets[:-1]], np.diff(starts))
    n = len(lcp)
    block = whole.column("block")[0].as_py()
    following = pa.array(np.append(lcp[1:], 0).astype(np.int32), mask=np.arange(n) == n - 1)
    edge = [None] * n
    edge[0], edge[-1] = sequence[0].as_py(), sequence[n - 1].as_py()
    for low in range(0, n, 10_000):
        high = min(n, low + 10_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(high - low, block, np.int32)),
                pa.array(np.arange(low, high, dtype=np.int32)),
                whole.column("conv_id").chunk(0).slice(low, high - low),
                pa.array(lcp[low:high].astype(np.int32)),
                following.slice(low, high - low),
                pa.ListArray.from_arrays(
                    pa.array((starts[low : high + 1] - starts[low]).astype(np.int32)), pa.array(cum[starts[low] : starts[high]])
                ),
                pa.array(edge[low:high], pa.binary()),
            ],
            names=["block", "idx", "conv_id", "lcp", "following", "cum", "edge"],
        )


def _edge_lcp(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for first, last in zip(batch.column("first").to_pylist(), batch.column("last").to_pylist()):
            digests, offsets = _binary(pa.array([last, first], pa.binary()))
            out.append(int(neighbour_lcp(digests, offsets)[1]))
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.int32())], names=["block", "lcp"])


# ---- blocks ------------------------------------------------------------------------


@dataclass
class Layout:
    """A few numbers for each block that has rows, in order; ``edge[k]`` is the LCP before block k."""

    blocks: np.ndarray
    rows: np.ndarray
    edge: np.ndarray  # one more than blocks; -1 at both ends
    least: np.ndarray  # least LCP of the block, the edge before it included
    conv_id: np.ndarray
    shared: np.ndarray  # sum of bytes that a row shares with the row before it
    leaves: np.ndarray

    def position(self, block: int) -> int:
        return int(np.searchsorted(self.blocks, block))

    def tables(self):
        return sparse_table(self.least), sparse_table(self.conv_id)


def _layout(ranked: DataFrame) -> Layout:
    shared = F.when(F.col("idx") > 0, F.element_at("cum", F.col("lcp") + 1)).otherwise(0)
    found = (
        ranked.groupBy("block")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(F.when(F.col("idx") > 0, F.col("lcp"))).alias("least"),
            F.min("conv_id").alias("conv_id"),
            F.sum(shared).alias("shared"),
            # a row ends a leaf where the next row does not have all of it as a prefix
            F.sum(F.expr("IF(following < size(cum) - 1, 1, 0)")).alias("leaves"),
        )
        .orderBy("block")
        .toArrow()  # MAX_BLOCKS rows at most
    )
    blocks = found.column("block").to_numpy()
    rows = found.column("rows").to_numpy()
    if not len(blocks):
        empty = np.empty(0, np.int64)
        return Layout(empty, empty, empty, empty, empty, empty, empty)
    spark = ranked.sparkSession
    order = spark.createDataFrame(
        [(int(b), int(p), int(n) - 1) for b, p, n in zip(blocks[1:], blocks[:-1], rows[:-1])], "block int, previous int, tail int"
    )
    ends = ranked.where("edge IS NOT NULL").select("block", "idx", "edge")
    pairs = (
        order.join(ends.where("idx = 0").select("block", F.col("edge").alias("first")), "block")
        .join(ends.select(F.col("block").alias("previous"), F.col("idx").alias("tail"), F.col("edge").alias("last")), ["previous", "tail"])
        .select("block", "first", "last")
    )
    across = pairs.mapInArrow(_edge_lcp, "block int, lcp int").toArrow()
    edge = np.full(len(blocks) + 1, -1, dtype=np.int64)
    edge[np.searchsorted(blocks, across.column("block").to_numpy())] = across.column("lcp").to_numpy()
    # with the edges known: what a first row shares, and whether a last row ends a leaf
    edges = spark.createDataFrame(
        [(int(b), int(n) - 1, int(x), int(y)) for b, n, x, y in zip(blocks, rows, edge[:-1], edge[1:])],
        "block int, tail int, before int, after int",
    )
    rim = (
        ranked.where("idx = 0 OR following IS NULL")
        .select("block", "idx", "cum")
        .join(edges, "block")
        .groupBy("block")
        .agg(
            F.sum(F.expr("IF(idx = 0 AND before > 0, element_at(cum, before + 1), 0)")).alias("shared"),
            F.sum(F.expr("IF(idx = tail AND after < size(cum) - 1, 1, 0)")).alias("leaves"),
        )
        .toArrow()
    )
    at = np.searchsorted(blocks, rim.column("block").to_numpy())
    more, last = np.zeros(len(blocks), dtype=np.int64), np.zeros(len(blocks), dtype=np.int64)
    more[at], last[at] = rim.column("shared").to_numpy(), rim.column("leaves").to_numpy()
    inner = np.array([_FAR if v is None else v for v in found.column("least").to_pylist()], dtype=np.int64)
    return Layout(
        blocks.astype(np.int64),
        rows.astype(np.int64),
        edge,
        np.minimum(inner, edge[:-1]),
        found.column("conv_id").to_numpy().astype(np.int64),
        found.column("shared").to_numpy().astype(np.int64) + more,
        found.column("leaves").to_numpy().astype(np.int64) + last,
    )


# ---- nodes of a block ---------------------------------------------------------------

_PARTS = (
    "kind string, home int, depth int, block int, conv_id bigint, parent_conv_id bigint, parent_home int, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, bytes_before bigint, ends string, target int"
)
_FIELDS = [f.strip().rsplit(" ", 1)[0] for f in _PARTS.split(",")]
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
_ARROW = [_TYPES[f.strip().rsplit(" ", 1)[1]] for f in _PARTS.split(",")]


def _batches(n: int, **columns) -> Iterator[pa.RecordBatch]:
    arrays = []
    for name, kind in zip(_FIELDS, _ARROW):
        value = columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, kind))
        elif isinstance(value, pa.Array):
            arrays.append(value.cast(kind))
        else:
            arrays.append(pa.array([value] * n if np.isscalar(value) else value, kind))
    whole = pa.RecordBatch.from_arrays(arrays, names=_FIELDS)
    for low in range(0, n, 10_000):
        yield whole.slice(low, 10_000)


class _Block:
    """Arrays of one block and the nodes that lie or begin or end in it."""

    def __init__(self, layout: Layout, tables, block: int, table: pa.Table):
        self.layout, (self.least, self.conv_of) = layout, tables
        self.block, self.k = block, layout.position(block)
        self.conv = table.column("conv_id").to_numpy()
        lists = table.column("cum").chunk(0)
        self.cum = lists.flatten().to_numpy(zero_copy_only=False)
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        self.first, self.len = first[:-1].astype(np.int64), np.diff(first).astype(np.int64) - 1
        self.n = len(self.conv)
        self.before, self.after = int(layout.edge[self.k]), int(layout.edge[self.k + 1])
        self.lcp = table.column("lcp").to_numpy().astype(np.int64)
        self.lcp[0] = self.before
        self.next = np.concatenate((self.lcp[1:], [self.after]))
        self.table = sparse_table(self.lcp)
        self.convs = sparse_table(self.conv)
        had = np.where(self.lcp > 0, self.cum[self.first + np.maximum(self.lcp, 0)], 0)
        self.shared = np.concatenate(([0], np.cumsum(had)))
        self.leaf = np.concatenate(([0], np.cumsum(self.next < self.len)))

    def bytes_before(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Text bytes of the turns of a row before its turn ``depth``."""
        return self.cum[self.first[rows] + np.maximum(depth - 1, 0)]

    def home(self, edge: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The block in which the node of ``depth`` that crosses the end of block ``edge`` begins."""
        return np.maximum(search_left(self.least, edge, depth), 0)

    def extents(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row or -1 where the node begins earlier; last row or n where it ends later.

        The two searches know nothing of each other.
        """
        left = search_left(self.table, at, depth)
        right = np.where(at + 1 < self.n, search_right(self.table, np.minimum(at + 1, self.n - 1), depth), self.n) - 1
        return left, np.where((right == self.n - 1) & (self.after >= depth), self.n, right)

    def crossing(self, left: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Home of a node that leaves the block: through its front, else through its end."""
        edge = np.where(left < 0, self.k - 1, self.k)
        return self.home(edge, depth)

    def parts(self) -> Iterator[pa.RecordBatch]:
        rows = np.arange(self.n)
        branch = np.flatnonzero(self.lcp >= 0)
        at = np.concatenate((rows, branch))
        depth = np.concatenate((self.len, self.lcp[branch]))
        opens = np.concatenate((np.zeros(self.n, bool), self.len[branch] > self.lcp[branch]))
        left, right = self.extents(at, depth)
        inside = (left >= 0) & (right < self.n)
        yield from self.local(at[inside], depth[inside], opens[inside], left[inside], right[inside])
        yield from self.ending(left, right, depth, inside)
        yield from self.edges()

    def ending(self, left, right, depth, inside) -> Iterator[pa.RecordBatch]:
        """Joined ids of the rows that end at a node that leaves the block."""
        out = np.flatnonzero(~inside[: self.n])
        home, deep = self.crossing(left[out], depth[out]), depth[out]
        order = np.lexsort((out, deep, home))
        out, home, deep = out[order], home[order], deep[order]
        cut = np.flatnonzero(np.concatenate(([True], (home[1:] != home[:-1]) | (deep[1:] != deep[:-1])))) if len(out) else out
        texts = [",".join(map(str, self.conv[some].tolist())) for some in np.split(out, cut[1:])] if len(out) else []
        yield from _batches(len(cut), kind="ends", home=home[cut], depth=deep[cut], block=self.k, ends=texts)

    def local(self, at, depth, opens, left, right) -> Iterator[pa.RecordBatch]:
        """Whole nodes, each with the chain of depths above it that has the same members."""
        if not len(at):
            return
        order = np.lexsort((depth, left))
        at, depth, opens, left, right = (x[order] for x in (at, depth, opens, left, right))
        cut = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (depth[1:] != depth[:-1]))))
        branches = np.add.reduceat(opens.astype(np.int64), cut)
        depth, left, right = depth[cut], left[cut], right[cut]
        children = branches + (self.len[left] > depth)
        n_convs = right - left + 1
        conv = range_min(self.convs, left, right)
        leaves = self.leaf[right + 1] - self.leaf[left]
        shared = self.shared[right + 1] - self.shared[left + 1]
        above = np.maximum(self.lcp[left], self.next[right])
        # the parent is the node of depth ``above`` around the row on the closer side
        closer = np.where(self.lcp[left] >= self.next[right], left, np.minimum(right + 1, self.n - 1))
        has = above >= 0
        p_left, p_right = self.extents(closer, above)
        whole = has & (p_left >= 0) & (p_right < self.n)
        leaves_block = has & ~whole
        parent = np.zeros(len(at[cut]), dtype=np.int64)
        parent[whole] = range_min(self.convs, p_left[whole], p_right[whole])
        home = np.full(len(parent), -1, dtype=np.int64)
        home[leaves_block] = self.crossing(p_left[leaves_block], above[leaves_block])
        yield from self.counts(home[leaves_block], above[leaves_block])
        # digests of the members that end here
        ends = np.full(len(depth), EMPTY_SHA256, dtype=object)
        run = np.flatnonzero(self.len[left] == depth)
        stop = self._end_of_run(left[run], right[run], depth[run])
        for node, low, high in zip(run.tolist(), left[run].tolist(), stop.tolist()):
            ends[node] = hashlib.sha256(",".join(map(str, self.conv[low:high].tolist())).encode()).hexdigest()
        # one row for each depth above+1 .. depth
        chain = depth - above
        node = np.repeat(np.arange(len(depth)), chain)
        level = np.arange(len(node)) - np.repeat(np.cumsum(chain) - chain, chain) + above[node] + 1
        top, bottom = level == above[node] + 1, level == depth[node]
        saved = shared[node] - (n_convs[node] - 1) * self.bytes_before(left[node], level)
        yield from _batches(
            len(node),
            kind="node",
            depth=level,
            block=self.k,
            conv_id=conv[node],
            parent_conv_id=pa.array(
                np.where(top, parent[node], conv[node]), pa.int64(), mask=(level == 0) | (top & (home[node] >= 0))
            ),
            parent_home=pa.array(home[node], pa.int64(), mask=~top | (home[node] < 0)),
            n_convs=n_convs[node],
            n_children=np.where(bottom, children[node], 1),
            n_leaves=leaves[node],
            saved_tokens=saved,
            ends=np.where(bottom, ends[node], EMPTY_SHA256),
        )

    def _end_of_run(self, left, right, depth) -> np.ndarray:
        """End of the rows from ``left`` on that are no longer than ``depth``: they sort first."""
        same = (self.len[1:] == self.len[:-1]) & (self.lcp[1:] == self.len[1:])
        breaks = np.concatenate((np.flatnonzero(~same) + 1, [self.n]))
        return np.minimum(breaks[np.searchsorted(breaks, left, side="right")], right + 1)

    def counts(self, home: np.ndarray, depth: np.ndarray) -> Iterator[pa.RecordBatch]:
        """How many nodes of this block have each crossing node as their parent."""
        if len(home):
            pairs, n = np.unique(np.stack((home, depth)), axis=1, return_counts=True)
            yield from _batches(len(n), kind="children", home=pairs[0], depth=pairs[1], block=self.k, n_children=n)

    def edges(self) -> Iterator[pa.RecordBatch]:
        """First and last parts of the nodes that cross the edges of the block."""
        last, zero = self.n - 1, np.zeros(0, dtype=np.int64)
        # nodes of depth 0..after cross the end; those that begin here have their left extent here
        depth = np.arange(self.after + 1)
        left = search_left(self.table, np.full(len(depth), last), depth)
        depth, left = depth[left >= 0], left[left >= 0]
        if len(depth):
            stop = search_right(self.least, np.full(len(depth), self.k + 1), depth)
            # where the edge before that block ends the node, its last member is in the block before
            target = stop - (self.layout.edge[stop] < depth)
            # blocks strictly between
            rows, shared, leaves = (
                np.concatenate(([0], np.cumsum(x))) for x in (self.layout.rows, self.layout.shared, self.layout.leaves)
            )
            least = range_min(self.convs, left, np.full(len(left), last))
            between = np.flatnonzero(target - 1 > self.k)
            if len(between):
                inner = range_min(self.conv_of, np.full(len(between), self.k + 1), target[between] - 1)
                least[between] = np.minimum(least[between], inner)
            span = lambda sums: sums[target] - sums[self.k + 1]
            yield from _batches(
                len(depth),
                kind="left",
                home=self.k,
                depth=depth,
                block=self.k,
                target=target,
                conv_id=least,
                parent_home=np.where(depth > 0, self.home(np.full(len(depth), self.k), depth - 1), -1),
                n_convs=last - left + 1 + span(rows),
                n_leaves=self.leaf[last + 1] - self.leaf[left] + span(leaves),
                # bytes shared by the later members, from which (members - 1) times the bytes before are taken
                saved_tokens=self.shared[last + 1] - self.shared[left + 1] + span(shared),
                bytes_before=self.bytes_before(left, depth),
            )
        depth = np.arange(self.before + 1)
        right = search_right(self.table, zero if not len(depth) else np.zeros(len(depth), np.int64), depth)
        ends = (right < self.n) | (self.after < depth)
        depth, right = depth[ends], right[ends]
        if len(depth):
            yield from _batches(
                len(depth),
                kind="right",
                target=np.full(len(depth), self.k),
                depth=depth,
                block=self.k,
                conv_id=range_min(self.convs, np.zeros(len(right), np.int64), right - 1),
                n_convs=right,
                n_leaves=self.leaf[right],
                saved_tokens=self.shared[right],
            )


def _search_blocks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        tables = layout.tables()
        held: list[pa.RecordBatch] = []
        block = None
        for batch in batches:
            ids = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))).tolist() if len(ids) else []
            for low, high in zip(cuts, [*cuts[1:], len(ids)]):
                if held and int(ids[low]) != block:
                    yield from _Block(layout, tables, block, pa.Table.from_batches(held).combine_chunks()).parts()
                    held = []
                block = int(ids[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from _Block(layout, tables, block, pa.Table.from_batches(held).combine_chunks()).parts()

    return run


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each (home, depth) of joined id lists in order."""
    present, digest = None, None
    for batch in batches:
        done = []
        for home, depth, text in zip(*(batch.column(c).to_pylist() for c in ("home", "depth", "ends"))):
            if (home, depth) != present:
                if present is not None:
                    done.append((*present, digest.hexdigest()))
                present, digest = (home, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if done:
            yield _digests(done)
    if present is not None:
        yield _digests([(*present, digest.hexdigest())])


def _digests(rows) -> pa.RecordBatch:
    home, depth, text = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(home, pa.int32()), pa.array(depth, pa.int32()), pa.array(text)], names=["home", "depth", "ends_sha256"]
    )


# ---- the operator --------------------------------------------------------------------


def prefix_trie(paths: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each node of the trie of ``paths(conv_id, path array<struct<digest, bytes>>)``."""
    spark = paths.sparkSession
    rows = materialize(
        paths.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("path", lambda t: t["digest"]), "")).alias("key"),
            F.transform("path", lambda t: t["bytes"]).alias("sizes"),
        ),
        "sequences",
    )
    size = rows.agg(F.sum(F.size("sizes") + 1).alias("turns")).first().turns or 0
    blocks = min(MAX_BLOCKS, max(1, -(-size // block_turns)))
    ordered = rows.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    ranked = materialize(
        ordered.select("key", "sizes", "conv_id", F.spark_partition_id().alias("block")).mapInArrow(_rank, _RANKED), "ranked"
    )
    layout = spark.sparkContext.broadcast(_layout(ranked))
    parts = materialize(
        ranked.select("block", "idx", "conv_id", "lcp", "cum")
        .repartition(blocks, "block")
        .sortWithinPartitions("block", "idx")
        .mapInArrow(_search_blocks(layout), _PARTS),
        "trie_parts",
    )
    left = parts.where("kind = 'left'").select(
        "home", "depth", "target", "conv_id", "parent_home", "n_convs", "n_leaves", "saved_tokens", "bytes_before"
    )
    right = parts.where("kind = 'right'").select(
        "target", "depth", *(F.col(c).alias(f"r_{c}") for c in ("conv_id", "n_convs", "n_leaves", "saved_tokens"))
    )
    n_convs = F.col("n_convs") + F.col("r_n_convs")
    wide = materialize(
        left.join(right, ["target", "depth"]).select(
            "home",
            "depth",
            "parent_home",
            F.least("conv_id", "r_conv_id").alias("conv_id"),
            n_convs.alias("n_convs"),
            (F.col("n_leaves") + F.col("r_n_leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + F.col("r_saved_tokens") - (n_convs - 1) * F.col("bytes_before")).alias("saved_tokens"),
        ),
        "crossing_nodes",
    )
    # children of crossing nodes: nodes that lie in blocks, already counted there, and crossing nodes
    below = parts.where("kind = 'children'").select("block", "home", "depth", "n_children")
    crossing_below = wide.where("depth > 0").select(
        F.col("parent_home").alias("home"), (F.col("depth") - 1).alias("depth"), F.lit(1).cast("bigint").alias("n_children")
    )
    children = below.drop("block").unionByName(crossing_below).groupBy("home", "depth").agg(F.sum("n_children").alias("below"))
    ended = (
        parts.where("kind = 'ends'")
        .select("home", "depth", "block", "ends")
        .repartition("home", "depth")
        .sortWithinPartitions("home", "depth", "block")
        .mapInArrow(_hash_pieces, "home int, depth int, ends_sha256 string")
    )
    named = wide.select("home", "depth", F.col("conv_id").alias("crossing_id"))
    parents = named.select(F.col("home").alias("parent_home"), (F.col("depth") + 1).alias("depth"), "crossing_id")
    crossing = (
        wide.join(children, ["home", "depth"], "left")
        .join(ended, ["home", "depth"], "left")
        .join(parents, ["parent_home", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            F.col("crossing_id").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("below", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
    # a node of a block looks its crossing parent up under its own block, so a common parent is no hot key
    around = below.join(named, ["home", "depth"]).select(
        "block", F.col("home").alias("parent_home"), (F.col("depth") + 1).alias("depth"), "crossing_id"
    )
    nodes = parts.where("kind = 'node'")
    own = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    settled = nodes.where("parent_home IS NULL").select(own)
    looked = (
        nodes.where("parent_home IS NOT NULL")
        .drop("parent_conv_id")
        .join(around.withColumnRenamed("crossing_id", "parent_conv_id"), ["block", "parent_home", "depth"])
        .select(own)
    )
    longs = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return settled.unionByName(looked).unionByName(crossing).select(
        *(F.col(c).cast("bigint").alias(c) for c in longs), "ends_sha256"
    )


def conversation_trie(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of ``turns(conv_id, turn, role, text)`` with heads shared within groups of five ids."""
    # both sides of the head join read it, and the texts are to be read once
    paths = materialize(conversation_turns(turns), "conversation_paths")
    return prefix_trie(share_heads(paths), block_turns)
