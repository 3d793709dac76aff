"""Token-id files: fixed-size id blocks, transposed into byte or bit planes, zstandard per plane.

A file is one segment of documents in ascending id order:

    magic | chunk planes ... | footer | footer length (8 bytes) | magic

Ids run through the segment without gaps and are cut every ``CHUNK_IDS`` ids, so a
document may lie in several chunks. Each plane of a chunk is a zstandard frame; a
plane of zeros costs a few bytes. The footer, a zstandard frame too, holds the chunk
index (place and size of every plane, ids per chunk) and the documents with their
numbers of ids. Files are written by Spark's own file writer, so they can lie in any
store it knows and a lost task leaves nothing behind.

Defined cases: null text is empty (its only id is the end id); repeated and null ids
are documents of their own, null first; an empty table has no documents.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewright.llm.common import materialize
from ratewright.llm.tokens import AT_ONCE, PLAIN, encoder
from ratewright.llm.words import chunks

MAGIC = b"IDPLANE1"
CHUNK_IDS = 1 << 16
SEGMENT_IDS = 4 << 20  # a segment ends with the document that reaches this many ids
LEVEL = 1


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of unsigned 32-bit ids."""
    if bits:
        return [np.packbits((ids >> np.uint32(k)) & np.uint32(1)).tobytes() for k in range(32)]
    columns = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [columns[k].tobytes() for k in range(4)]


def join_planes(planes: list[bytes], count: int) -> np.ndarray:
    ids = np.zeros(count, dtype="<u4")
    if len(planes) == 32:
        for k, plane in enumerate(planes):
            ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count).astype(np.uint32) << np.uint32(k)
        return ids
    columns = ids.view(np.uint8).reshape(-1, 4)
    for k, plane in enumerate(planes):
        columns[:, k] = np.frombuffer(plane, np.uint8)
    return ids


def encode_segment(ids: bytes, documents: list[tuple[int | None, int]], order: tuple[int, int], bits: bool) -> bytes:
    """A file of the documents (id, number of token ids) whose ids are ``ids``."""
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    values = np.frombuffer(ids, dtype="<u4")
    parts, index, at = [MAGIC], [], len(MAGIC)
    for start in range(0, len(values), CHUNK_IDS):
        some = values[start : start + CHUNK_IDS]
        planes = [compressor.compress(p) for p in split_planes(some, bits)]
        index.append([at, len(some), [len(p) for p in planes]])
        parts.extend(planes)
        at += sum(map(len, planes))
    footer = {"order": order, "chunks": index, "documents": documents}
    packed = compressor.compress(json.dumps(footer, separators=(",", ":")).encode())
    return b"".join([*parts, packed, len(packed).to_bytes(8, "little"), MAGIC])


def read_footer(data: memoryview) -> dict:
    end = len(data) - len(MAGIC)
    if data[end:] != MAGIC or data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token-id file")
    size = int.from_bytes(data[end - 8 : end], "little")
    return json.loads(zstandard.ZstdDecompressor().decompress(data[end - 8 - size : end - 8]))


def read_chunks(data: memoryview, footer: dict) -> Iterator[np.ndarray]:
    decompressor = zstandard.ZstdDecompressor()
    for at, count, sizes in footer["chunks"]:
        planes = []
        for size in sizes:
            planes.append(decompressor.decompress(data[at : at + size]))
            at += size
        yield join_planes(planes, count)


def _segments(path: str, units: str, end_id: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, units)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        end = np.array([end_id], dtype="<u4").tobytes()
        ids, documents, size, number = [], [], 0, 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(b"".join(ids), documents, (part, number), bits)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["segment"])

        for batch in batches:
            for first, last in chunks(batch.column(1), AT_ONCE):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                names = batch.column(0).slice(first, last - first).to_pylist()
                for doc_id, data in zip(names, own.encode([t or "" for t in texts])):
                    ids += (data, end)
                    count = len(data) // 4 + 1
                    documents.append((doc_id, count))
                    size += count
                    if size >= SEGMENT_IDS:
                        yield segment()
                        ids, documents, size, number = [], [], 0, number + 1
        if documents:
            yield segment()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, units: str = PLAIN, end_id: int = 2, bits: bool = False
) -> None:
    """Token ids of ``docs(doc_id, text)`` as files below ``path``, in ascending id order."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    segments = ordered.mapInArrow(_segments(tokenizer_path, units, end_id, bits), "segment binary")
    # the text writer puts the bytes down as they are, and one line feed after each segment
    segments.select(F.col("segment").cast("string")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", 1
    ).text(path)


def _documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                data = memoryview(value.as_buffer())
                if not len(data):
                    continue
                data = data[:-1]  # the line feed
                footer = read_footer(data)
                part, number = footer["order"]
                names, starts, counts, sums, all_ids = [], [], [], [], []
                wanted = iter(footer["documents"])
                held, place, need = b"", 0, 0
                doc_id, need = next(wanted, (None, None))
                for ids in read_chunks(data, footer):
                    held += ids.tobytes()
                    while need is not None and len(held) >= 4 * need:
                        own, held = held[: 4 * need], held[4 * need :]
                        names.append(doc_id)
                        starts.append(place)
                        counts.append(need)
                        sums.append(zlib.crc32(own))
                        all_ids.append(own)
                        place += need
                        doc_id, need = next(wanted, (None, None))
                columns = [
                    pa.array([part] * len(names), pa.int64()),
                    pa.array([number] * len(names), pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                labels = ["part", "number", "doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.binary()))
                    labels.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=labels)

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and number of ids of each file, from its footer alone."""
    for batch in batches:
        rows = []
        for value in batch.column(0):
            data = memoryview(value.as_buffer())
            if len(data):
                footer = read_footer(data[:-1])
                rows.append((*footer["order"], sum(count for _, count, _ in footer["chunks"])))
        part, number, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (part, number, n)], names=["part", "number", "n"])


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of the files below ``path``."""
    schema = "part bigint, number bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(_documents(with_ids), schema + (", ids binary" if with_ids else ""))
    # ids before each segment: within its part, and before the part; a row per part meets in one task
    # and the files are read for it once, not for both sums
    sizes = materialize(files.mapInArrow(_sizes, "part bigint, number bigint, n bigint"), "segment_sizes")
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before_part = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before_part"))
    before = (
        sizes.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(before_part, "part")
        .select("part", "number", (F.col("before") + F.col("before_part")).alias("before"))
    )
    rest = ["n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return found.join(before, ["part", "number"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), *rest
    )
