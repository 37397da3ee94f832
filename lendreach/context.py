"""Run parameters. Nothing in the library reads the wall clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """The instant a job runs for, the brand it runs for, and named options."""

    run_ts: dt.datetime
    brand: str = "main"
    params: dict = field(default_factory=dict)

    @property
    def run_date(self) -> dt.date:
        return self.run_ts.date()

    @property
    def weekday(self) -> int:
        """Monday is 0."""
        return self.run_ts.weekday()

    def option(self, name: str, default=None):
        return self.params.get(name, default)

    def shifted(self, days: int) -> "RunContext":
        """The same run, back-dated or post-dated by whole days."""
        return RunContext(self.run_ts + dt.timedelta(days=days), self.brand, self.params)

    def lookback_days(self, in_hours: int = 10, off_hours: int = 60) -> int:
        """Fact refresh look-back: short during the day (06h to 18h), long otherwise."""
        return off_hours if self.run_ts.hour < 6 or self.run_ts.hour > 18 else in_hours

    def ts(self) -> Column:
        return F.lit(self.run_ts).cast("timestamp_ntz")

    def date(self) -> Column:
        return F.lit(self.run_date)

    def run_dates(self, spark: SparkSession) -> DataFrame:
        """One row holding the run date; list builders join on it."""
        return spark.range(1).select(self.date().alias("run_date"))
