"""Column names and the open-version sentinel of one SCD2 replica."""

from __future__ import annotations

from calendar import monthrange
from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class ScdSpec:
    """Names the entity key, the validity dates and the two partition columns.

    The replica is partitioned by the month ends of the validity dates,
    ``part_to`` first. A version is open while its ``part_to`` is the month of
    ``open_date``.
    """

    key: str = "id"
    eff_from: str = "eff_from_dt"
    eff_to: str = "eff_to_dt"
    part_to: str = "eff_to_month"
    part_from: str = "eff_from_month"
    open_date: date = date(5999, 12, 31)

    @property
    def open_month_start(self) -> date:
        return self.open_date.replace(day=1)

    @property
    def open_month(self) -> date:
        last = monthrange(self.open_date.year, self.open_date.month)[1]
        return self.open_date.replace(day=last)

    @property
    def partitioning(self) -> tuple[str, str]:
        return (self.part_to, self.part_from)


DEFAULT = ScdSpec()
