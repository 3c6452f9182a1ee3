"""Run parameters: one month plus the thresholds the monthly scripts use."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


def month_start(d: _dt.date | str) -> _dt.date:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d[:10])
    return d.replace(day=1)


def add_months(d: _dt.date, n: int) -> _dt.date:
    """Calendar month shift with end-of-month clamping (as SQL intervals)."""
    y, m = divmod(d.month - 1 + n, 12)
    year, month = d.year + y, m + 1
    last = (_dt.date(year + (month == 12), month % 12 + 1, 1) - _dt.timedelta(days=1)).day
    return _dt.date(year, month, min(d.day, last))


@dataclass(frozen=True)
class RunParams:
    """Parameters of one monthly run.

    ``month`` is normalised to the first of the month. ``overdue_days`` is the
    hard-disconnect threshold (85). ``mrc_rate_switch`` is the month from which
    the closing mobile MRC is read from the run month instead of the previous
    one. ``tenure_early``/``tenure_mid`` are the tenure band limits in days.
    ``install_org`` is the operator's organisation code on install orders; it
    has no default, and a run that needs it without having it fails.
    """

    month: _dt.date
    overdue_days: int = 85
    mrc_rate_switch: _dt.date = _dt.date(2023, 4, 1)
    tenure_early: int = 180
    tenure_mid: int = 360
    mobile_lookback_months: int = 6
    early_ticket_weeks: int = 7
    slow_install_days: int = 6
    payment_windows: tuple = (30, 60, 85)
    payment_lookback_days: int = 50
    install_org: str | None = None
    install_country: str = "PR"
    funnel_day1: int = 30
    funnel_soft: int = 50
    # Reference quirks reproduced by default; each can be switched off.
    dedupe_mobile_churners: bool = False
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "month", month_start(self.month))
        object.__setattr__(self, "payment_windows", tuple(self.payment_windows))

    @property
    def payment_days(self) -> int:
        """Days after the first bill whose payments count: the longest window."""
        return max(self.payment_windows)

    @property
    def prev_month(self) -> _dt.date:
        return add_months(self.month, -1)

    @property
    def next_month(self) -> _dt.date:
        return add_months(self.month, 1)

    @property
    def month_end(self) -> _dt.date:
        return self.next_month - _dt.timedelta(days=1)

    @property
    def snapshot_window(self) -> tuple[_dt.date, _dt.date]:
        """Daily-snapshot range the fixed scripts read: from (month end − 2
        months), clamped, to the first day of the next month."""
        return add_months(self.month_end, -2), self.next_month

    def at(self, month: _dt.date | str) -> RunParams:
        """The same parameters for another month."""
        return replace(self, month=month)

    def shift(self, n: int) -> _dt.date:
        return add_months(self.month, n)
