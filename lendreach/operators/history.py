"""List history: keyed replace, updates, purges, staging maps, seed rows, audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendreach.context import RunContext
from lendreach.sources.schemas import TABLES
from lendreach.sources.writers import conform

AUDIT_SCHEMA = T.StructType([
    T.StructField("valuation_date", T.DateType()),
    T.StructField("process_name", T.StringType()),
    T.StructField("process_label", T.StringType()),
    T.StructField("process_type", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("status_flag", T.IntegerType()),
])


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is absent from staging, plus all of staging."""
    kept = target.join(staging.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(staging.select(*target.columns))


def update_from(target: DataFrame, src: DataFrame, on: Sequence[str], set_cols: Sequence[str],
                where: Column) -> DataFrame:
    """Set columns from a matching source row where ``where`` holds; all other rows stay.

    ``src`` has one row per key (aggregate it first).
    """
    s = src.select(*on, *[F.col(c).alias(f"_new_{c}") for c in set_cols],
                   F.lit(True).alias("_hit"))
    joined = target.withColumn("_where", where).join(s, list(on), "left")
    hit = F.col("_hit") & F.col("_where")
    for c in set_cols:
        joined = joined.withColumn(c, F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)))
    return joined.select(*target.columns)


def purge(target: DataFrame, bad: DataFrame, on: Sequence[str]) -> DataFrame:
    return target.join(bad.select(*on).distinct(), list(on), "left_anti").select(*target.columns)


def null_where(df: DataFrame, column: str, pred: Column) -> DataFrame:
    return df.withColumn(column, F.when(F.coalesce(pred, F.lit(False)), None)
                         .otherwise(F.col(column)))


def map_load(df: DataFrame, mapping: Mapping[str, Column | str | None],
             schema: T.StructType) -> DataFrame:
    """Shape staging rows to a target schema: a name, an expression or None for null."""
    unknown = set(mapping) - set(schema.names)
    if unknown:
        raise ValueError(f"columns outside the target schema: {sorted(unknown)}")
    out = []
    for f in schema:
        src = mapping.get(f.name)
        c = F.lit(None) if src is None else F.col(src) if isinstance(src, str) else src
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def to_history(lst: DataFrame, ctx: RunContext, target: str, channel: str, list_name: str,
               frequency: str) -> DataFrame:
    """A built list as rows of its history table: channel, name, frequency and the instant of the run are
    added, the columns put in the table's order and types. A column the table does not know fails."""
    shaped = lst.withColumns({"channel": F.lit(channel), "list_name": F.lit(list_name),
                              "list_frq": F.lit(frequency), "list_generation_time": ctx.ts()})
    return conform(shaped, TABLES[target])


def with_seed_rows(lst: DataFrame, seeds: DataFrame, fixed: Mapping[str, object]) -> DataFrame:
    """Append internal tester rows: ids -9, texts 'test', own mail and names."""
    sentinel = {"lms_customer_id": -9, "lms_application_id": -9, "loan_sequence": -9,
                "lms_code": "test", "state": "test", "product": "test"}
    own = {"email": "email_address", "customer_firstname": "first_name",
           "customer_lastname": "last_name", "requested_amount": "request_loan_amount",
           "approved_amount": "approved_amount", "comments": "comments"}
    out = []
    for f in lst.schema:
        if f.name in fixed:
            c = F.lit(fixed[f.name])
        elif f.name in sentinel:
            c = F.lit(sentinel[f.name])
        elif f.name in own:
            c = F.col(own[f.name])
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return lst.unionByName(seeds.filter("is_active = 1").select(*out))


def audited(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by the step's own write; no second pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def audit_row(df: DataFrame, ctx: RunContext, process: str, label: str, kind: str,
              rows: int | None, error: str | None = None) -> DataFrame:
    """One log row for a finished step: its row count, or its error text."""
    msg = (f"{kind} failed, error message = {error}" if error
           else f"{kind} succeeded, total row count = {rows}")
    return df.sparkSession.createDataFrame(
        [(ctx.run_date, process, label, kind, msg, 0 if error else 1)], AUDIT_SCHEMA)
