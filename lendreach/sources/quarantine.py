"""Imports of hand-made lists in which some rows are broken: good rows are loaded, bad ones put apart with reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.context import RunContext
from lendreach.operators.history import AUDIT_SCHEMA

BROKEN = "_broken_line"


@dataclass(frozen=True)
class ImportRule:
    """What a column must satisfy beyond its type; a value that is not there passes unless it is required."""
    column: str
    required: bool = False
    lowest: float | None = None
    highest: float | None = None
    allowed: tuple = ()


@dataclass(frozen=True)
class Loaded:
    """Good rows in their types, bad rows as text with ``reasons`` and the file they came from, the audit row."""
    good: DataFrame
    bad: DataFrame
    audit: DataFrame


def _reasons(field: T.StructField, rule: ImportRule | None) -> list[Column]:
    text, kind = F.col(f"_raw.{field.name}"), field.dataType.simpleString()
    empty = text.isNull() | (F.trim(text) == "")
    value = F.expr(f"try_cast(trim(_raw.`{field.name}`) AS {kind})")
    out = []
    if rule and rule.required:
        out.append(F.when(empty, f"{field.name}: missing"))
    if not isinstance(field.dataType, T.StringType):
        out.append(F.when(~empty & value.isNull(), f"{field.name}: not a {kind}"))
    if rule and rule.lowest is not None:
        out.append(F.when(value < F.lit(rule.lowest), f"{field.name}: under {rule.lowest}"))
    if rule and rule.highest is not None:
        out.append(F.when(value > F.lit(rule.highest), f"{field.name}: over {rule.highest}"))
    if rule and rule.allowed:
        out.append(F.when(~empty & ~value.isin(list(rule.allowed)), f"{field.name}: unknown value"))
    return out


def read_lines(spark: SparkSession, path: str, schema: T.StructType, rules: Sequence[ImportRule] = ()) -> DataFrame:
    """(columns as text, reasons, file) of a CSV with a header, read once and never failing on a row.

    A line with too few or too many fields is a reason of its own and carries the line; every other reason names its
    column, so a row may have several.
    """
    by = {r.column: r for r in rules}
    unknown = set(by) - set(schema.names)
    if unknown:
        raise ValueError(f"rules for columns outside the schema: {sorted(unknown)}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in schema.names] + [T.StructField(BROKEN, T.StringType())])
    raw = spark.read.csv(path, schema=text, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    rows = raw.select(F.struct(*raw.columns).alias("_raw"), F.col("_metadata.file_path").alias("file"))
    found = [F.when(F.col(f"_raw.{BROKEN}").isNotNull(), F.concat(F.lit("line: not the expected fields: "), f"_raw.{BROKEN}"))]
    for f in schema:
        found += _reasons(f, by.get(f.name))
    return rows.select("_raw.*", F.array_compact(F.array(*found)).alias("reasons"), "file").drop(BROKEN)


def load_import(spark: SparkSession, path: str, schema: T.StructType, target: str, ctx: RunContext, process: str,
                rules: Sequence[ImportRule] = ()) -> Loaded:
    """Load a hand-made list to the folder ``target`` and count good and bad rows in an audit row.

    The file is parsed once: rows are written apart by whether they have a reason, then good ones are read back in
    their types. The load does not stop at a bad row; a load that runs again replaces its rows.
    """
    lines = read_lines(spark, path, schema, rules)
    staged = f"{target.rstrip('/')}/parsed"
    lines.withColumn("is_bad", F.size("reasons") > 0).write.mode("overwrite").partitionBy("is_bad").parquet(staged)
    back = spark.read.schema(T.StructType([*lines.schema, T.StructField("is_bad", T.BooleanType())])).parquet(staged)
    good = back.filter(~F.col("is_bad")).select(*[
        F.expr(f"try_cast(trim(`{f.name}`) AS {f.dataType.simpleString()})").alias(f.name)
        if not isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema])
    bad = back.filter("is_bad").drop("is_bad")
    n = {r["is_bad"]: r["count"] for r in back.groupBy("is_bad").count().collect()}
    message = f"Insert succeeded, total row count = {n.get(False, 0)}, quarantined = {n.get(True, 0)}"
    audit = spark.createDataFrame([(ctx.run_date, process, f"import {process}", "Insert", message, 1)], AUDIT_SCHEMA)
    return Loaded(good, bad, audit)
