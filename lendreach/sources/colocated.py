"""Tables stored in buckets of a key, so that joins and groups on that key read them without a shuffle.

A bucket is one task's work, and nothing splits it at run time. A key with many rows would make one long task, so
the rows of such keys are stored apart and unbucketed: there Spark shuffles as usual and splits what is skewed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendreach.session import FREE_SHUFFLES, cut_lean, cut_lineage, fresh_path, lean_writer, settings

# joins on more columns than the bucket key keep the buckets
KEEP_BUCKETS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@dataclass(frozen=True)
class Split:
    """One table in two parts: ``even`` in buckets, ``heavy`` with all rows of the heavy keys."""
    even: DataFrame
    heavy: DataFrame

    def all(self) -> DataFrame:
        return self.even.unionByName(self.heavy)


class CoLocated:
    """A set of tables in the same number of buckets of one key.

    ``share`` is the part of an even bucket that one key may hold, ``least`` the rows below which a key is never
    heavy. A table of n rows has fewer than ``buckets / share`` heavy keys, whatever its size.
    """

    def __init__(self, spark: SparkSession, buckets: int, share: float = 0.5, least: int = 100_000):
        if buckets < 1 or share <= 0:
            raise ValueError("buckets and share must be positive")
        self.spark, self.buckets, self.share, self.least = spark, buckets, share, least

    def heavy_keys(self, tables: Sequence[tuple[DataFrame, str]]) -> DataFrame:
        """The keys that are heavy in any of the tables, as a stored table of one column ``heavy_key``.

        Null counts as a key: rows without one would share a bucket.
        """
        found = None
        for df, key in tables:
            counts = cut_lean(df.groupBy(F.col(key).alias("heavy_key")).agg(F.count("*").alias("n")), "key-counts")
            total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            limit = max(self.least, int(total * self.share / self.buckets))
            heavy = counts.filter(F.col("n") > limit).select("heavy_key")
            found = heavy if found is None else found.unionByName(heavy)
        return cut_lineage(found.distinct(), "heavy-keys")

    def write(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Store ``df`` in buckets of ``key``, one sorted file a bucket, and read it back.

        The rows go to the shared folder; the catalog of the session holds the table's name and its buckets.
        """
        table = f"colocated_{name.replace('-', '_')}_{uuid.uuid4().hex}"
        with settings(self.spark, FREE_SHUFFLES):
            (lean_writer(df.repartition(self.buckets, key)).mode("overwrite").format("parquet")
             .option("path", fresh_path(self.spark, name)).bucketBy(self.buckets, key).sortBy(key).saveAsTable(table))
        return self.spark.table(table)

    def split(self, df: DataFrame, name: str, key: str, heavy: DataFrame) -> Split:
        """Both parts of a table; every row is in exactly one of them."""
        same = df[key].eqNullSafe(heavy["heavy_key"])
        return Split(self.write(df.join(heavy, same, "left_anti"), name, key),
                     cut_lean(df.join(heavy, same, "left_semi"), f"{name}-heavy"))
