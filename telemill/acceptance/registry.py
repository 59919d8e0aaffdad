"""The named queries with their SQL equivalents."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def with_shared_folder(function: Query) -> Query:
    """The query with a shared folder set where a session of this machine alone has none.

    The library itself sets none; on a cluster without one, it raises.
    """

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        local = spark.sparkContext.master.split("[")[0] == "local"
        if local and not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="telemill-"))
        return function(spark, sf_dir)

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without `sql` there is no SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = with_shared_folder(function)
        if sql is not None:
            SQL[name] = sql
        return function

    return register
