"""Aggregation and transform primitives for generated features."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from cutline.functions.calendar import seconds_between
from cutline.functions.moments import (
    adjusted_skew, comoments, merged_comoments, merged_moments, moments, slope, variance)

DAY_SECONDS = 86400.0
TREND_ORIGIN = "timestamp_ntz'2000-01-01 00:00:00'"


@dataclass(frozen=True)
class Partial:
    """An aggregate over the rows of one time bucket and how such results are merged.

    ``build(x, t, row)`` gets the column, the row's time and a marker that is NULL for rows a
    where-clause excludes; ``x`` and ``t`` are NULL for those rows too.
    """

    build: Callable[[Column, Column, Column], Column]
    merge: str


PARTIALS: dict[str, Partial] = {
    "rows": Partial(lambda x, t, row: F.count(row), "sum"),
    "cnt": Partial(lambda x, t, row: F.count(x), "sum"),
    "sum": Partial(lambda x, t, row: F.sum(x), "sum"),
    "min": Partial(lambda x, t, row: F.min(x), "min"),
    "max": Partial(lambda x, t, row: F.max(x), "max"),
    "tcnt": Partial(lambda x, t, row: F.count(t), "sum"),
    "tmin": Partial(lambda x, t, row: F.min(t), "min"),
    "tmax": Partial(lambda x, t, row: F.max(t), "max"),
    "ntrue": Partial(lambda x, t, row: F.count_if(x), "sum"),
    "moments": Partial(lambda x, t, row: moments(x), "moments"),
    "comoments": Partial(
        lambda x, t, row: comoments(x, seconds_between(F.expr(TREND_ORIGIN), t) / DAY_SECONDS), "comoments"),
}

MERGES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "min": F.min, "max": F.max, "moments": merged_moments, "comoments": merged_comoments,
}


@dataclass(frozen=True)
class Aggregate:
    """An aggregation primitive.

    ``route`` says how it is computed: ``merge`` from partials per time bucket, ``order`` from the
    first or last row, ``values`` from counts per distinct value, ``median`` from ranked values,
    ``pairs`` from ``expr(x, t, time)`` over all rows of a (key, cutoff).
    ``takes`` is rows, numeric, discrete, boolean, any or time; ``gives`` a kind or ``same``.
    """

    name: str
    takes: str
    gives: str = "numeric"
    route: str = "merge"
    needs: tuple[str, ...] = ()
    finish: Callable[[dict[str, Column], Column], Column] | None = None
    expr: Callable[[Column, Column, Column], Column] | None = None
    default: Any = None


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


AGGREGATES: dict[str, Aggregate] = {a.name: a for a in [
    Aggregate("count", "rows", needs=("rows",), finish=lambda p, time: p["rows"], default=0),
    Aggregate("sum", "numeric", needs=("sum",), finish=lambda p, time: p["sum"], default=0),
    Aggregate("mean", "numeric", needs=("sum", "cnt"), finish=lambda p, time: _ratio(p["sum"], p["cnt"])),
    Aggregate("max", "numeric", needs=("max",), finish=lambda p, time: p["max"]),
    Aggregate("min", "numeric", needs=("min",), finish=lambda p, time: p["min"]),
    Aggregate("median", "numeric", route="median"),
    Aggregate("std", "numeric", needs=("moments",),
              finish=lambda p, time: F.sqrt(variance(p["moments"]))),
    Aggregate("skew", "numeric", needs=("moments",),
              finish=lambda p, time: adjusted_skew(p["moments"])),
    Aggregate("first", "any", gives="same", route="order"),
    Aggregate("last", "any", gives="same", route="order"),
    Aggregate("mode", "discrete", gives="same", route="values"),
    Aggregate("n_most_common", "discrete", gives="list", route="values"),
    Aggregate("num_unique", "discrete", route="values", default=0),
    Aggregate("entropy", "discrete", route="values"),
    Aggregate("num_true", "boolean", needs=("ntrue",), finish=lambda p, time: p["ntrue"], default=0),
    Aggregate("percent_true", "boolean", needs=("ntrue", "rows"),
              finish=lambda p, time: _ratio(p["ntrue"], p["rows"]), default=0),
    Aggregate("all", "boolean", gives="boolean", needs=("min",), finish=lambda p, time: p["min"]),
    Aggregate("any", "boolean", gives="boolean", needs=("max",), finish=lambda p, time: p["max"]),
    Aggregate("avg_time_between", "time", needs=("tmin", "tmax", "tcnt"),
              finish=lambda p, time: _ratio(seconds_between(p["tmin"], p["tmax"]), p["tcnt"] - 1)),
    Aggregate("time_since_first", "time", needs=("tmin",),
              finish=lambda p, time: seconds_between(p["tmin"], time)),
    Aggregate("time_since_last", "time", needs=("tmax",),
              finish=lambda p, time: seconds_between(p["tmax"], time)),
    Aggregate("days_since_last", "time", needs=("tmax",),
              finish=lambda p, time: F.floor(seconds_between(p["tmax"], time) / DAY_SECONDS)),
    Aggregate("trend", "numeric", needs=("comoments",),
              finish=lambda p, time: slope(p["comoments"])),
]}
MONTH_OF_CUTOFF = "month_of_cutoff_point"
BUILT_IN, BUILT_IN_PARTIALS = frozenset(AGGREGATES), frozenset(PARTIALS)


@dataclass(frozen=True)
class Transform:
    """A row transform. ``kind`` tells what it needs beside its column: nothing (``row``), the
    cutoff (``cutoff``), the key's previous row (``previous``) or the whole entity (``entity``)."""

    name: str
    takes: str
    gives: str
    kind: str = "row"
    build: Callable[..., Column] | None = None


TRANSFORMS: dict[str, Transform] = {t.name: t for t in [
    Transform("absolute", "numeric", "numeric", build=lambda x: F.abs(x)),
    Transform("percentile", "numeric", "numeric", kind="entity"),
    Transform("time_since", "datetime", "numeric", kind="cutoff",
              build=lambda x, time: seconds_between(x, time)),
    Transform("second", "datetime", "discrete", build=lambda x: F.second(x)),
    Transform("minute", "datetime", "discrete", build=lambda x: F.minute(x)),
    Transform("weekday", "datetime", "discrete", build=lambda x: F.weekday(x)),
    Transform("is_weekend", "datetime", "boolean", build=lambda x: F.weekday(x) >= 5),
    Transform("hour", "datetime", "discrete", build=lambda x: F.hour(x)),
    Transform("day", "datetime", "discrete", build=lambda x: F.dayofmonth(x)),
    Transform("week", "datetime", "discrete", build=lambda x: F.weekofyear(x)),
    Transform("month", "datetime", "discrete", build=lambda x: F.month(x)),
    Transform("year", "datetime", "discrete", build=lambda x: F.year(x)),
    Transform("diff", "numeric", "numeric", kind="previous", build=lambda x, before: x - before),
    Transform("time_since_previous", "time", "numeric", kind="previous",
              build=lambda x, before: seconds_between(before, x)),
]}

DEFAULT_AGGREGATES = ("count", "last", "max", "mean", "min", "mode", "num_true", "num_unique",
                      "percent_true", "sum", "time_since_last", MONTH_OF_CUTOFF)
DEFAULT_TRANSFORMS = ("month", "year", "diff")
DEFAULT_WHERE = ("count", "sum")


def primitive_name(name: str) -> str:
    """``NumUnique`` and ``num_unique`` both name the same primitive."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def aggregate(name: str) -> Aggregate:
    try:
        return AGGREGATES[primitive_name(name)]
    except KeyError:
        raise ValueError(f"unknown aggregation primitive: {name!r}") from None


def transform(name: str) -> Transform:
    try:
        return TRANSFORMS[primitive_name(name)]
    except KeyError:
        raise ValueError(f"unknown transform primitive: {name!r}") from None


def register_aggregate(primitive: Aggregate) -> None:
    """Add a user-defined aggregate; ``merge`` and ``pairs`` routes are open to users."""
    if primitive.route not in ("merge", "pairs"):
        raise ValueError("a user-defined aggregate uses the route merge or pairs")
    if primitive.name in BUILT_IN:
        raise ValueError(f"{primitive.name!r} is a built-in aggregate")
    AGGREGATES[primitive.name] = primitive


def register_partial(name: str, partial: Partial) -> None:
    if name in BUILT_IN_PARTIALS:
        raise ValueError(f"{name!r} is a built-in partial aggregate")
    PARTIALS[name] = partial
