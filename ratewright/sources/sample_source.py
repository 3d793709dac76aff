"""One lookup for every input table of the test book."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ratewright.params import Params
from ratewright.plans.book import Book
from ratewright.session import PARTITION_BYTES, SHUFFLE_BYTES, partitions_for
from ratewright.sources import rest, schemas
from ratewright.sources.sample_assumptions import SampleAssumptions
from ratewright.sources.sample_tables import SAMPLE_PARAMS, SampleBook


@cache
def _raw_tables(spark: SparkSession, sf_dir: str, params: Params) -> SampleBook:
    """The raw tables as plans; nothing is computed or held."""
    return SampleBook(spark, sf_dir, params)


INPUTS = ("customer", "part", "orders", "lineitem")
LEAST_BUCKETS = 8


def sample_partitions(spark: SparkSession, sf_dir: str, size: int = PARTITION_BYTES) -> int:
    """The partitions that the order tables of a directory are worth."""
    return partitions_for(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in INPUTS], size)


def sample_shuffles(spark: SparkSession, sf_dir: str) -> int:
    """The shuffle partitions that the order tables of a directory are worth."""
    return sample_partitions(spark, sf_dir, SHUFFLE_BYTES)


def write_sample(
    spark: SparkSession, sf_dir: str, root: str, params: Params = SAMPLE_PARAMS, buckets: int | None = None
) -> None:
    """Derive every input table of the test book once and write it at rest below ``root``.

    A bucket is read by one task, so their number grows with the order tables unless it is given.
    """
    buckets = buckets or max(LEAST_BUCKETS, sample_partitions(spark, sf_dir))
    raw = SampleBook(spark, sf_dir, params, keep=True, buckets=buckets)
    book = _book_over(raw)
    for name in (*schemas.RAW, *schemas.ASSUMPTIONS, "development_pool_mapping"):
        by_key = {key: rest.conformed(df, name) for key, df in raw.lying_by(name).items()}
        rest.write_at_rest(root, name, rest.conformed(book.source(name), name), buckets, by_key)


def resting_sample(spark: SparkSession, sf_dir: str, root: str, params: Params = SAMPLE_PARAMS) -> Book:
    """The test book over tables that ``write_sample`` wrote."""
    book = Book.at_rest(spark, root, params)
    book.sample_assumptions = SampleAssumptions(_raw_tables(spark, sf_dir, params))
    return book


def sample_book(spark: SparkSession, sf_dir: str, params: Params = SAMPLE_PARAMS) -> Book:
    """The pricing lineage over one directory of test tables."""
    return _book_over(_raw_tables(spark, sf_dir, params))


def _book_over(raw: SampleBook) -> Book:
    assumptions = SampleAssumptions(raw)
    known: dict[str, DataFrame] = {}

    def source(name: str) -> DataFrame:
        if name not in known:
            owner = raw if name.startswith("raw_") else assumptions
            known[name] = getattr(owner, name)()
        return known[name]

    book = Book(raw.spark, source, raw.params)
    book.sample_raw, book.sample_assumptions = raw, assumptions
    return book
