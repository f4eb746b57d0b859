"""Arrow-backed functions that are made when they are first used, so modules can be imported before there is a session."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def arrow(kind: str) -> Callable:
    """Decorator: a function of pandas series as a function of columns with results of that kind."""

    def named(f: Callable) -> Callable:
        @functools.wraps(f)
        def call(*columns):
            return F.pandas_udf(f, kind)(*columns)

        return call

    return named


def bounded_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Arrow batches that go to Python are at most so large (one row at least), whatever number of rows that is."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
