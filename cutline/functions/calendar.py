"""Calendar offsets, the last cutoff and the cutoff schedule (driver-side date arithmetic)."""

from __future__ import annotations

import calendar as _cal
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS_PER_UNIT = {"years": 12, "months": 1}
FIXED_UNITS = ("weeks", "days", "hours", "minutes", "seconds")


@dataclass(frozen=True)
class Offset:
    """A length of calendar time, for example ``Offset(12, "months")``."""

    n: int
    unit: str = "months"

    def __post_init__(self):
        unit = self.unit if self.unit.endswith("s") else self.unit + "s"
        if unit not in MONTHS_PER_UNIT and unit not in FIXED_UNITS:
            raise ValueError(f"unknown calendar unit: {self.unit!r}")
        object.__setattr__(self, "unit", unit)
        object.__setattr__(self, "n", int(self.n))

    def after(self, moment: datetime) -> datetime:
        return self._shift(moment, self.n)

    def before(self, moment: datetime) -> datetime:
        return self._shift(moment, -self.n)

    def _shift(self, moment: datetime, n: int) -> datetime:
        if self.unit in FIXED_UNITS:
            return moment + timedelta(**{self.unit: n})
        year, month0 = divmod(moment.year * 12 + moment.month - 1 + n * MONTHS_PER_UNIT[self.unit], 12)
        return on_day(moment.replace(year=year, month=month0 + 1, day=1), moment.day)

    def interval(self) -> Column:
        """The same length as an interval column; month steps clamp to the month end."""
        if self.unit in MONTHS_PER_UNIT:
            return F.make_ym_interval(F.lit(0), F.lit(self.n * MONTHS_PER_UNIT[self.unit]))
        per_day = {"weeks": 7, "days": 1}
        if self.unit in per_day:
            return F.make_dt_interval(F.lit(self.n * per_day[self.unit]))
        parts = {"hours": 0, "minutes": 0, "seconds": 0, self.unit: self.n}
        return F.make_dt_interval(
            F.lit(0), F.lit(parts["hours"]), F.lit(parts["minutes"]), F.lit(parts["seconds"]))


def on_day(moment: datetime, day: int) -> datetime:
    """``moment`` moved to ``day`` of its month, or to the last day of a shorter month."""
    return moment.replace(day=min(day, _cal.monthrange(moment.year, moment.month)[1]))


def as_datetime(value) -> datetime | None:
    if value is None or isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime.combine(value, time())
    return datetime.fromisoformat(str(value))


def last_cutoff(
    max_time: datetime,
    lead: Offset,
    prediction: Offset,
    cutoff_day: int = 1,
    given=None,
    mode: str = "train",
    truncate: bool = True,
) -> datetime:
    """Latest observation point the data allows for ``mode`` train, retrain or predict."""
    if mode not in ("train", "retrain", "predict"):
        raise ValueError(f"unknown mode: {mode!r}")
    given = as_datetime(given)
    if mode == "predict":
        chosen = max_time if given is None else min(given, max_time)
    else:
        limit = lead.before(prediction.before(max_time))
        chosen = given if mode == "train" and given is not None and given <= limit else limit
    if truncate:
        chosen = datetime.combine(chosen.date(), time())
    if chosen.day < cutoff_day:
        chosen = Offset(1).before(chosen.replace(day=1))
    return on_day(chosen, cutoff_day)


def cutoff_schedule(last: datetime, n: int | None, gap: Offset = Offset(1)) -> list[datetime]:
    """``n`` cutoffs going back from ``last``; each step starts from the previous cutoff."""
    schedule = [last]
    for _ in range((n or 1) - 1):
        schedule.append(gap.before(schedule[-1]))
    return schedule


def micros_between(earlier, later) -> Column:
    """Microseconds from one timestamp to another, without a time zone conversion."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def seconds_between(earlier, later) -> Column:
    return micros_between(earlier, later) / F.lit(1e6)


def ntz_text(moment: datetime) -> str:
    """The moment as a SQL literal."""
    return f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}'"


def ntz(moment: datetime) -> Column:
    return F.expr(ntz_text(moment))
