"""Property and casualty pricing analytics on Spark DataFrames."""

from ratewright.params import Params
from ratewright.plans.book import Book

__all__ = ["Book", "Params"]
