"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet
and read back as the next stage's documents. The filtering stages keep all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm import decontaminate, exactdup, neardup, packing, toxicity
from ratewright.llm.common import materialize, table
from ratewright.llm.queries import importable, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CACHE_UNITS = 200_000  # the workers keep what other stages need as well
AT_ONCE = 1 << 20  # bytes of text they encode at once
TOXIC_FROM = 0.5  # a document with at least this score is rejected


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    labels = toxicity.train_fold(table(spark, sf_dir, "labels"))
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < TOXIC_FROM).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return exactdup.drop_exact_duplicates(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 stays: the one of least id."""
    importable(spark)
    groups = neardup.near_duplicates(docs, shingle_words=5, percent=80)
    dropped = materialize(groups.where("NOT kept").select("doc_id").distinct(), "near_copies")
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), n=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    tokens = packing.token_pieces(docs, tokenizer("byte_bpe_50k.json"), cache_units=CACHE_UNITS, at_once=AT_ONCE)
    pieces = materialize(tokens, "pieces")
    return packing.pack(pieces).drop("row")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: tokenizing and the trained classifier are not expressible
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
