"""The reference instant of a run, in place of the engine's current time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class AsOf:
    """``AsOf("2024-01-30 12:00:00")`` pins now and today; ``AsOf()`` uses the clock.

    Everything is built from literals, so Catalyst folds it to constants and the
    predicates reach the scan.
    """

    instant: str | None = None

    @property
    def now(self) -> Column:
        if self.instant is None:
            return F.current_timestamp()
        return F.lit(self.instant).cast("timestamp")

    @property
    def today(self) -> Column:
        return F.to_date(self.now)

    def days_before_now(self, days: int) -> Column:
        return self.now - F.expr(f"INTERVAL {int(days)} DAYS")

    def hours_before_now(self, hours: int) -> Column:
        return self.now - F.expr(f"INTERVAL {int(hours)} HOURS")

    def days_before_today(self, days: int) -> Column:
        return F.date_sub(self.today, days)
