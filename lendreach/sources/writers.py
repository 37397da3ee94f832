"""Writing lists and tables as parquet, partitioned by business date and list module."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIST_PARTITIONS = ("business_date", "list_module")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in schema order; unknown ones fail, missing ones are null."""
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns outside the target schema: {sorted(unknown)}")
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                       .alias(f.name) for f in schema])


def gathered(df: DataFrame, parts: Sequence[str] = LIST_PARTITIONS) -> DataFrame:
    """Bring the rows of a partition value together, so that a write makes few files; Spark splits
    values that are too large for one task by their measured size and merges small ones."""
    return df.hint("rebalance", *[F.col(p) for p in parts])


def append_history(df: DataFrame, path: str, parts: Sequence[str] = LIST_PARTITIONS) -> None:
    df.write.mode("append").partitionBy(*parts).parquet(path)


def replace_run(df: DataFrame, path: str, parts: Sequence[str] = LIST_PARTITIONS,
                runs: Sequence[Sequence] = ()) -> None:
    """Replace the partitions present in ``df``, then empty those of ``runs`` that the write left as they were.

    ``runs`` are the partition values that this run stands for, in the order of ``parts``: where the run
    has no row any more, its earlier rows go. Rows are written before anything is emptied, so a run that is lost
    between the steps leaves a partition with its old rows or its new ones, never without any. Both steps can be
    repeated; running a list again changes nothing else.
    """
    spark = df.sparkSession
    before = _files(spark, path, parts, runs)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    if before:
        _clear(df, path, parts, before, _files(spark, path, parts, list(before)))


def _clear(df: DataFrame, path: str, parts: Sequence[str], before: dict, after: dict) -> None:
    """Empty the partitions that still hold a file from before the write."""
    for run, files in before.items():
        if files & after.get(run, set()):
            folder = "/".join([path.rstrip("/"), *(f"{p}={_folder(v)}" for p, v in zip(parts, run, strict=True))])
            df.filter(F.lit(False)).drop(*parts).write.mode("overwrite").parquet(folder)


def _folder(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" +-_.,;()@&!~")


def _files(spark: SparkSession, path: str, parts: Sequence[str], runs: Sequence[Sequence]) -> dict[tuple, set[str]]:
    """The files of those of ``runs`` that the table at ``path`` holds; none where there is no table yet.

    The wanted values prune the folders, so nothing else of the history is listed into the scan.
    """
    if not runs:
        return {}
    try:
        have = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise
    wanted = F.lit(False)
    for run in runs:
        one = F.lit(True)
        for p, v in zip(parts, run, strict=True):
            one = one & F.col(p).cast("string").eqNullSafe(F.lit(None if v is None else str(v)))
        wanted = wanted | one
    found = have.filter(wanted).select(*[F.col(p).cast("string").alias(p) for p in parts],
                                       F.col("_metadata.file_path").alias("file")).distinct()
    out: dict[tuple, set[str]] = {}
    for *run, file in found.collect():
        out.setdefault(tuple(run), set()).add(file)
    return out


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_segment(df: DataFrame, cols: Sequence[str], path: str) -> None:
    """Projected extract for the mailing tool."""
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
