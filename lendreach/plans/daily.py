"""The daily chain: each list is built once, shaped, seeded, written to its history and logged; a step that fails is
logged and does not stop the others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendreach.context import RunContext
from lendreach.operators import history as hist
from lendreach.session import cut_lineage
from lendreach.sources.stored import StoredTable


@dataclass(frozen=True)
class ListStep:
    """A list of the day: how it is built and under which name it goes into its history."""
    module: str
    label: str
    frequency: str
    build: Callable[[], DataFrame]
    channel: str = "email"


def run_step(name: str, kind: str, ctx: RunContext, spark, work: Callable[[], int]) -> DataFrame:
    """Do one step and return its audit row: its row count, or the error it ended with."""
    try:
        rows, error = work(), None
    except Exception as e:  # logged and passed over: a broken list must not keep the others from going out
        rows, error = None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    return hist.audit_row(spark.range(1), ctx, "daily lists", name, kind, rows, error)


def write_list(step: ListStep, table: StoredTable, target: str, seeds: DataFrame, ctx: RunContext,
               grain: str = "month") -> int:
    """Build one list, put it in the shape of its history with the seed rows of the run date, and replace its
    partitions (``business_period``, list module); the run's own one is emptied where the list has no row. A run
    must bring all rows of its periods. Returns the rows written."""
    rows = hist.to_history(step.build(), ctx, target, step.channel, step.label, step.frequency)
    fixed = {"business_date": ctx.run_date, "list_module": step.module, "channel": step.channel,
             "list_name": step.label, "list_frq": step.frequency, "list_generation_time": ctx.run_ts}
    rows = hist.with_seed_rows(rows, seeds, fixed).withColumn("business_period", F.trunc("business_date", grain))
    rows = cut_lineage(rows, f"list-{step.module.lower()}")         # built once, counted and written from there
    start = ctx.run_date.replace(day=1) if grain == "month" else ctx.run_date.replace(month=1, day=1)
    table.replace(rows, [(start, step.module)])
    return rows.count()


def run_lists(steps: Sequence[ListStep], table: StoredTable, target: str, seeds: DataFrame, ctx: RunContext,
              grain: str = "month") -> DataFrame:
    """Write the lists of a run one after the other; the audit rows, one a step in their order."""
    spark, out = table.spark, None
    for s in steps:
        row = run_step(f"populate {s.module}", "Insert", ctx, spark, lambda s=s: write_list(s, table, target, seeds, ctx, grain))
        out = row if out is None else out.unionByName(row)
    return out


def hand_off(history: DataFrame, day: dt.date | None, module: str, cols: Sequence[str]) -> DataFrame:
    """Rows of one list for the mailing tool, of one day or of all; equal rows once."""
    rows = history.filter(F.col("list_module") == module)
    rows = rows if day is None else rows.filter(F.col("business_date") == F.lit(day))
    return rows.select(*cols).distinct()
