"""Registered queries: one per operator, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.checks.views import Views, duck
from lendreach.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PLAIN: dict[str, str] = {}      # the SQL without its views, to build on


def tidy(df: DataFrame) -> DataFrame:
    """Money as double, so both engines print it alike."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema])


def query(name: str, views: str, sql: str):
    """Register a function of :class:`Views` with its SQL over the named views."""
    def wrap(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(Views(configure(spark), sf_dir)))
        QUERIES[name] = run
        ORACLES[name] = duck(views, sql)
        PLAIN[name] = sql
        return fn
    return wrap


def dbl(cols: str) -> str:
    """``CAST(c AS DOUBLE) AS c`` for each name."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols.split())


def big(cols: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols.split())
