"""The reporting clock. ``as_of`` replaces the wall clock everywhere."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """Reporting date and the month boundaries derived from it.

    ``eopm``  last day of the previous month,
    ``sopm``  first day of the previous month,
    ``month_start`` first day of the reporting month.
    All are plain Python dates, so Spark folds them into literals.
    """

    day: dt.date

    @classmethod
    def of(cls, value: "AsOf | dt.date | str") -> "AsOf":
        if isinstance(value, AsOf):
            return value
        if isinstance(value, str):
            value = dt.date.fromisoformat(value)
        return cls(value)

    @property
    def month_start(self) -> dt.date:
        return self.day.replace(day=1)

    @property
    def eopm(self) -> dt.date:
        return self.month_start - dt.timedelta(days=1)

    @property
    def sopm(self) -> dt.date:
        return self.eopm.replace(day=1)

    # column forms
    def lit(self) -> Column:
        return F.lit(self.day)

    def with_load_date(self, df):
        """``df`` with the load stamp column ``load_date`` = ``as_of``."""
        return df.withColumn("load_date", F.lit(self.day))

    def load_date(self) -> Column:
        return F.lit(self.day).alias("load_date")

    def eopm_lit(self) -> Column:
        return F.lit(self.eopm)

    def sopm_lit(self) -> Column:
        return F.lit(self.sopm)

    def month_start_lit(self) -> Column:
        return F.lit(self.month_start)


# Reporting date used by the fixtures and the oracle checks.
FIXTURE_AS_OF = AsOf(dt.date(2021, 2, 15))


def with_load_date(df, as_of):
    """``df`` stamped with ``load_date`` = the reporting date."""
    return AsOf.of(as_of).with_load_date(df)
