"""Helpers that several operators share: tables, held-out folds, distributed numbering."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context; Spark's file server carries it."""
    if spark.sparkContext in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    if root.parent.is_dir() and any(root.glob("*.py")):
        handle, name = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
        with os.fdopen(handle, "wb") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(name)
    _SHIPPED.add(spark.sparkContext)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def carried(docs: DataFrame, keep: tuple[str, ...], text: str) -> tuple[DataFrame, str]:
    """Columns ``keep`` and the text, sent once; the name under which the text goes."""
    if text in keep:
        return docs.select(*keep), text
    return docs.select(*keep, F.col(text).alias("__text")), "__text"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """Fold of a row: CRC-32 of the key's decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def spread(key: Column) -> Column:
    """Three hexadecimal digits of the key's MD5: 4096 even buckets; a null key is the text ``null``."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, 3)


def numbered(df: DataFrame, group: Column, key: Column, out: str) -> DataFrame:
    """Gapless numbers from 0 within ``group``, in the order of (``spread(key)``, ``key``).

    No task holds a whole group: rows are ranked inside (group, bucket) and shifted by the counts of the
    buckets before, a table of at most 4096 rows a group. Rows equal in ``key`` take their numbers in any order.
    """
    g, b, k = "__group", "__bucket", "__key"
    rows = df.withColumns({g: F.coalesce(group.cast("string"), F.lit("\0null")), b: spread(key), k: key})
    before = (rows.groupBy(g, b).count()
              .withColumn("__before", F.coalesce(
                  F.sum("count").over(W.partitionBy(g).orderBy(b).rowsBetween(W.unboundedPreceding, -1)),
                  F.lit(0)))
              .drop("count"))
    ranked = rows.withColumn("__rank", F.row_number().over(W.partitionBy(g, b).orderBy(k)))
    return (ranked.join(before, [g, b])
            .withColumn(out, F.col("__before") + F.col("__rank") - 1)
            .drop(g, b, k, "__before", "__rank"))
