"""Reading: logical names to tables or paths, imports of hand-made lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Catalog:
    """Maps logical names to a path (parquet) or, without a slash, to a metastore table."""

    def __init__(self, spark: SparkSession, locations: Mapping[str, str]):
        self.spark = spark
        self.locations = dict(locations)

    def read(self, name: str, cols: Sequence[str] | None = None) -> DataFrame:
        """Scan with column pruning; column names come out in snake case."""
        where = self.locations[name]
        df = self.spark.read.parquet(where) if "/" in where else self.spark.table(where)
        df = snake_case(df)
        return df.select(*cols) if cols else df


def snake_name(name: str) -> str:
    """``1st/Payment Date#`` -> ``c_1st_payment_date``."""
    out = re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
    return f"c_{out}" if out[:1].isdigit() else out


def snake_case(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(snake_name(c)) for c in df.columns])


def lower_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Normalise columns that are compared without regard to case."""
    return df.withColumns({c: F.lower(F.col(c)) for c in cols})


def read_import(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A hand-made list saved as CSV with a header; a row that does not fit fails the read."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")
