"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical after replacing each run of ASCII white space by one
space. The text is read once: normalising it needs every character, so the three
keys come from that one read as a narrow table, and each level keeps only the rows
whose key is shared before it looks at the longer key. Groups are counted by
aggregation and joined back, so a key that holds a third of all rows is summed
before the shuffle and its join partition can be split.

Defined cases: null text equals empty text; of a group the least ``doc_id`` stays,
and null ids only when the group has no other; repeated rows of the staying id all
count as kept here, and ``drop_exact_duplicates`` leaves one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import materialize

PREFIX_CHARS = 64


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _signed(docs: DataFrame) -> DataFrame:
    text = normalized(F.col("text"))
    return materialize(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.length(text).alias("size"),
            F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
            F.sha2(text, 256).alias("text_sha256"),
        ),
        "text_keys",
    )


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys occur in more than one row."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(counts, list(keys), "left_semi")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs(doc_id, text)``."""
    signed = _signed(docs)
    suspects = materialize(_shared(_shared(signed, "size"), "size", "prefix"), "suspects")
    groups = (
        suspects.groupBy("size", "prefix", "text_sha256")
        .agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("text_sha256", "keep", "n")
    )
    return signed.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.when(F.col("n").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the later copies; all columns stay."""
    marks = materialize(exact_duplicates(docs).where("group_size > 1"), "duplicates")
    dropped = marks.where("NOT kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")
    ).distinct()
    keyed = docs.withColumn("_sha256", F.sha2(normalized(F.col("text")), 256))
    alike = keyed["doc_id"].eqNullSafe(dropped["_id"]) & (keyed["_sha256"] == dropped["_sha"])
    rest = keyed.join(dropped, alike, "left_anti")
    repeated = marks.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    if repeated.limit(1).count():
        rest = rest.dropDuplicates(["doc_id", "_sha256"])
    return rest.drop("_sha256")
