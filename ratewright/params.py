"""Run parameters shared by every operator."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date


def is_month_end(day: date) -> bool:
    return day.day == calendar.monthrange(day.year, day.month)[1]


@dataclass(frozen=True)
class Params:
    """Point-in-time cut, calendar range and segmentation of one run.

    ``calendar_end`` is exclusive. ``as_of`` must be a month end, because every
    valuation is a month end and a mid-month cut would hide the last one.
    """

    as_of: date = date(2023, 12, 31)
    calendar_start: date = date(2010, 1, 1)
    calendar_end: date = date(2031, 1, 1)
    segmentation_version: str = "v3"
    tail_factor: float | None = None
    baseline_loss_method: str = "Chain_ladder"
    baseline_count_method: str = "Chain_ladder"
    pricing_version: str | None = None

    def __post_init__(self) -> None:
        if not is_month_end(self.as_of):
            raise ValueError(f"as_of must be a month end, got {self.as_of.isoformat()}")
        if self.calendar_start >= self.calendar_end:
            raise ValueError("calendar_start must precede calendar_end")
        if self.as_of >= self.calendar_end:
            raise ValueError("as_of must lie in the calendar: its months would be cut off")
