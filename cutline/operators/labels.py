"""Point-in-time labels: churn, purchase, purchase by product, value, and user-defined ones."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutline.functions.actions import action_predicate
from cutline.functions.calendar import Offset, as_datetime, cutoff_schedule, last_cutoff
from cutline.functions.moments import aligned, merged_moments, moments, variance
from cutline.operators.ranking import Slots, exact_quantiles
from cutline.operators.skew import split_hot
from cutline.operators.windows import BUCKET, Buckets, RoleWindow, interval_join
from cutline.session import checkpointed

ACTION = "__action"
PRODUCTS_PER_MASK = 62


@dataclass(frozen=True)
class LabelSpec:
    """Which label to compute, at which cutoffs, over which windows."""

    problem: str
    sample: Offset = Offset(12)
    lead: Offset = Offset(0, "days")
    prediction: Offset = Offset(1)
    cutoff_day: int = 1
    cutoff_num: int | None = 12
    last_cutoff: Any = None
    gap: Offset = Offset(1)
    truncate_cutoff: bool = True
    actions: Sequence[dict] = ()
    ignore_missing: bool = False
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class LabelFunction:
    """A label in three steps, so that it can be computed from partial results.

    ``partials(spec, t)`` are aggregates over the events of one (key, time bucket); the boolean
    column ``__action`` tells which events pass the action filter. ``merges(spec)`` are
    aggregates over those partials per (key, cutoff) and may use ``in_sample``, ``in_lead`` and
    ``in_pred``. ``finish(spec)`` gives the label columns from the merged values and ``time``.
    """

    partials: Callable[[LabelSpec, Column], dict[str, Column]]
    merges: Callable[[LabelSpec], dict[str, Column]]
    finish: Callable[[LabelSpec], dict[str, Column]]


def _acted(c: Column | None = None) -> Column:
    return F.when(F.col(ACTION), F.lit(1) if c is None else c)


def _in_pred(name: str) -> Column:
    return F.when(F.col("in_pred"), F.col(name))


PURCHASE = LabelFunction(
    partials=lambda spec, t: {"acted": F.max(_acted())},
    merges=lambda spec: {"acted": F.max(_in_pred("acted"))},
    finish=lambda spec: {"purchase": F.coalesce(F.col("acted"), F.lit(0))},
)


def _churn_finish(spec: LabelSpec) -> dict[str, Column]:
    window = Offset(spec.params["churn_window"], spec.params["churn_window_unit"])
    due = F.col("last_seen") + window.interval()
    window_end = F.col("time") + spec.lead.interval() + spec.prediction.interval()
    return {"churn": F.when(due > window_end, 0).when(F.col("first_back") < due, 0).otherwise(1)}


CHURN = LabelFunction(
    partials=lambda spec, t: {"t_max": F.max(t), "t_min_acted": F.min(_acted(t))},
    merges=lambda spec: {
        "last_seen": F.max(F.when(F.col("in_sample") | F.col("in_lead"), F.col("t_max"))),
        "first_back": F.min(_in_pred("t_min_acted")),
    },
    finish=_churn_finish,
)


def listed_products(spec: LabelSpec) -> list:
    return [p for p in dict.fromkeys(spec.params["product_list"]) if p is not None]


def _masks(products: list) -> list[list]:
    return [products[i:i + PRODUCTS_PER_MASK] for i in range(0, len(products), PRODUCTS_PER_MASK)]


def _bought(spec: LabelSpec) -> list[tuple[Any, Column]]:
    """(product, was it bought) for each listed product, read from the merged bit masks."""
    return [
        (p, F.coalesce(F.getbit(F.col(f"mask{i}"), F.lit(bit)), F.lit(0)).cast("int"))
        for i, part in enumerate(_masks(listed_products(spec))) for bit, p in enumerate(part)
    ]


def _product_partials(spec: LabelSpec, t: Column) -> dict[str, Column]:
    product = F.col(spec.params["product_column"])
    out = {}
    for i, part in enumerate(_masks(listed_products(spec))):
        bit = reduce(lambda acc, e: acc.when(product == e[1], F.lit(1 << e[0]).cast("bigint")),
                     list(enumerate(part))[1:],
                     F.when(product == part[0], F.lit(1).cast("bigint")))
        out[f"mask{i}"] = F.bit_or(_acted(bit))
    return out


PRODUCT_PURCHASE = LabelFunction(
    partials=_product_partials,
    merges=lambda spec: {f"mask{i}": F.bit_or(_in_pred(f"mask{i}"))
                         for i in range(len(_masks(listed_products(spec))))},
    finish=lambda spec: {"__products": F.array(*[
        F.struct(F.lit(p).alias("product"), got.alias("product_purchase")) for p, got in _bought(spec)])},
)

VALUE_SUMS = ("sum", "mean", "count", "min", "max", "std", "var")
VALUE_DISTINCT = ("median", "nunique")


def _value_partials(spec: LabelSpec, t: Column) -> dict[str, Column]:
    v = _acted(F.col(spec.params["value_column"]))
    out = {"v_cnt": F.count(v), "v_sum": F.sum(v), "v_min": F.min(v), "v_max": F.max(v)}
    if spec.params["value_agg"] in ("std", "var"):
        out["v_moments"] = moments(v)
    return out


def _value_merges(spec: LabelSpec) -> dict[str, Column]:
    out = {
        "v_cnt": F.sum(_in_pred("v_cnt")), "v_sum": F.sum(_in_pred("v_sum")),
        "v_min": F.min(_in_pred("v_min")), "v_max": F.max(_in_pred("v_max")),
    }
    if spec.params["value_agg"] in ("std", "var"):
        out["v_moments"] = merged_moments(_in_pred("v_moments"))
    return out


def _value_finish(spec: LabelSpec) -> dict[str, Column]:
    how, n = spec.params["value_agg"], F.coalesce(F.col("v_cnt"), F.lit(0))
    if how in ("std", "var"):
        spread = variance(F.col("v_moments"))
        got = F.sqrt(spread) if how == "std" else spread
    else:
        got = {
            "sum": F.col("v_sum"), "mean": F.col("v_sum") / F.nullif(n, F.lit(0)), "count": n,
            "min": F.col("v_min"), "max": F.col("v_max"),
        }[how]
    return {"value": F.when(n > 0, got.cast("double")).otherwise(F.lit(0.0))}


VALUE = LabelFunction(_value_partials, _value_merges, _value_finish)

LABELS: dict[str, LabelFunction] = {
    "purchase": PURCHASE, "churn": CHURN, "product_purchase": PRODUCT_PURCHASE, "value": VALUE,
}


BUILT_IN_LABELS = frozenset(LABELS)


def register_label(name: str, function: LabelFunction) -> None:
    if name in BUILT_IN_LABELS:
        raise ValueError(f"{name!r} is a built-in label")
    LABELS[name] = function


def label_cutoffs(events: DataFrame, time: str, spec: LabelSpec, mode: str = "train") -> list[datetime]:
    """Cutoffs for the spec; reads the latest event time (one small job)."""
    newest = events.agg(F.max(time)).first()[0]
    if newest is None:
        return []
    last = last_cutoff(as_datetime(newest), spec.lead, spec.prediction, spec.cutoff_day,
                       spec.last_cutoff, mode, spec.truncate_cutoff)
    return cutoff_schedule(last, 1 if mode == "predict" else spec.cutoff_num, spec.gap)


def label_windows(spec: LabelSpec, cutoffs: Sequence[datetime]) -> Buckets:
    windows = []
    for c in cutoffs:
        lead_end = spec.lead.after(c)
        windows += [
            RoleWindow(c, "sample", spec.sample.before(c), c),
            RoleWindow(c, "lead", c, lead_end),
            RoleWindow(c, "pred", lead_end, spec.prediction.after(lead_end)),
        ]
    return Buckets(windows)


def _with_action(events: DataFrame, key: str, time: str, spec: LabelSpec) -> DataFrame:
    rows = events.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return rows.withColumn(ACTION, action_predicate(events.columns, spec.actions, spec.ignore_missing))


def _flags(df: DataFrame, spec: LabelSpec) -> DataFrame:
    """The bucket table only has roles that occur; a zero lead has no window of its own."""
    missing = [r for r in ("in_sample", "in_lead", "in_pred") if r not in df.columns]
    return df.withColumns({r: F.lit(False) for r in missing})


def make_labels(
    events: DataFrame,
    key: str,
    time: str,
    spec: LabelSpec,
    mode: str = "train",
    cutoffs: Sequence[datetime] | None = None,
    form: str = "bucketed",
) -> DataFrame:
    """(key, time, label) for every key that was active in the sample window of a cutoff.

    ``bucketed`` reduces events per (key, time bucket) first, so what is shuffled does not grow
    with the number of cutoffs. ``direct`` pairs each event with its cutoffs and aggregates once;
    it exists for comparison.
    """
    function = LABELS.get(spec.problem)
    if function is None:
        raise ValueError(f"unknown problem type: {spec.problem!r}")
    cutoffs = list(cutoffs) if cutoffs is not None else label_cutoffs(events, time, spec, mode)
    if not cutoffs:
        # no event time at all: an empty table with the right columns
        events, cutoffs = events.limit(0), [datetime(2000, 1, 1)]
    how = spec.params.get("value_agg") if spec.problem == "value" else None
    if how is not None and how not in VALUE_SUMS + VALUE_DISTINCT:
        raise ValueError(f"unknown value aggregate: {how!r}")
    if spec.problem == "product_purchase" and None in spec.params["product_list"]:
        warnings.warn("empty entries of the product list are left out", stacklevel=2)
    buckets = label_windows(spec, cutoffs)
    rows = _with_action(events, key, time, spec)
    if how in VALUE_DISTINCT:
        return _value_by_distinct(rows, key, time, spec, buckets, how, form)
    merged = _merged(rows, key, time, spec, function, buckets, form)
    result = merged.select(key, "time", *[c.alias(n) for n, c in function.finish(spec).items()])
    if spec.problem == "product_purchase":
        result = result.select(key, "time", F.inline("__products"))
    return result


def _merged(rows, key, time, spec, function, buckets: Buckets, form: str) -> DataFrame:
    partials = {"__rows": F.count(F.lit(1)), **function.partials(spec, F.col(time))}
    merges = {"__active": F.max(F.when(F.col("in_sample"), F.col("__rows"))), **function.merges(spec)}
    spreads = [n for n in partials if n.endswith("moments")]
    if form == "bucketed":
        reduced = (buckets.assign(rows, time).groupBy(key, BUCKET)
                   .agg(*[c.alias(n) for n, c in partials.items()]))
        # all later steps group by the key, so the reduced rows move once more and then stay
        wide = buckets.expand(aligned(reduced.repartition(key), key, spreads, []))
    elif form == "direct":
        flagged = _flags(interval_join(rows, time, buckets), spec)
        wide = aligned(flagged.groupBy(key, "time", "in_sample", "in_lead", "in_pred").agg(
            *[c.alias(n) for n, c in partials.items()]), key, spreads, [])
    else:
        raise ValueError(f"unknown form: {form!r}")
    merged = _flags(wide, spec).groupBy(key, "time").agg(*[c.alias(n) for n, c in merges.items()])
    return merged.where(F.col("__active") > 0)


def _value_by_distinct(rows, key, time, spec, buckets, how, form) -> DataFrame:
    """Median and distinct count need the single values of the prediction window."""
    only_active = LabelFunction(lambda s, t: {}, lambda s: {}, lambda s: {})
    active = _merged(rows, key, time, spec, only_active, buckets, form).select(key, "time")
    pred = Buckets([w for w in buckets.windows if w.role == "pred"])
    value = spec.params["value_column"]
    bought = pred.assign(rows.where(F.col(ACTION) & F.col(value).isNotNull()), time).select(key, BUCKET, value)
    cold, hot = split_hot(bought, key, len({w.cutoff for w in pred.windows}))
    measure = F.median(value) if how == "median" else F.count_distinct(value)
    got = pred.expand(cold.repartition(key)).groupBy(key, "time").agg(measure.cast("double").alias("value"))
    if hot is not None:
        # a key too frequent for one task: count equal values first, then rank by value ranges
        counts = hot.groupBy(key, BUCKET, value).agg(F.count(F.lit(1)).alias("__n")).repartition(key, value)
        counts = pred.expand(counts).groupBy(key, "time", value).agg(F.sum("__n").alias("__n"))
        if how == "nunique":
            part = counts.groupBy(key, "time").agg(F.count(F.lit(1)).cast("double").alias("value"))
        else:
            part = exact_quantiles(counts, value, {"value": 0.5}, [key, "time"], weight="__n",
                                   slots=Slots.of(hot, value)).select(key, "time", F.col("value").cast("double"))
        got = got.unionByName(part)
    return active.join(got, [key, "time"], "left").select(
        key, "time", F.coalesce("value", F.lit(0.0)).alias("value"))


def wide_products(labels: DataFrame, key: str, products: Sequence, sep: str = "@") -> DataFrame:
    """One ``product_purchase@<product>`` column per product."""
    picks = [F.max(F.when(F.col("product") == p, F.col("product_purchase"))).alias(f"product_purchase{sep}{p}")
             for p in products]
    return labels.groupBy(key, "time").agg(*picks)


def product_labels(labels: DataFrame, key: str, product) -> DataFrame:
    """The label table of one product."""
    return labels.where(F.col("product") == product).select("time", key, "product_purchase")


def with_action_rows(events: DataFrame, action_rows: DataFrame, flag: str = "is_action") -> DataFrame:
    """Sample rows plus target rows marked by ``flag``; use an action ``flag == 1`` with it."""
    return events.withColumn(flag, F.lit(0)).unionByName(
        action_rows.withColumn(flag, F.lit(1)), allowMissingColumns=True)


def _time_or_all() -> Column:
    return F.when(F.grouping("time") == 1, F.lit("All")).otherwise(F.date_format("time", "yyyy-MM-dd")).alias("time")


def label_stats(labels: DataFrame, label: str, kind: str = "classifier", pretty: bool = False) -> DataFrame:
    """Per cutoff and over all: count and share of 0 and 1, or count, mean and median."""
    if kind == "classifier":
        share = [F.avg((F.col(label) == v).cast("int")).alias(f"share_{v}") for v in (0, 1)]
        stats = labels.rollup("time").agg(_time_or_all().alias("label_time"), F.count(label).alias("n"), *share)
        stats = stats.select(F.col("label_time").alias("time"), "n", "share_0", "share_1")
        if pretty:
            stats = stats.withColumns({c: F.format_string("%.4f%%", F.col(c) * 100) for c in ("share_0", "share_1")})
        return stats
    if kind != "regression":
        raise ValueError(f"unknown kind of label: {kind!r}")
    labels = checkpointed(labels.select("time", label))
    stats = labels.rollup("time").agg(_time_or_all().alias("label_time"),
                                      F.count(label).alias("n"), F.avg(label).alias("mean"))
    stats = stats.select(F.col("label_time").alias("time"), "n", "mean")
    day = labels.select(F.date_format("time", "yyyy-MM-dd").alias("time"), label)
    middle = exact_quantiles(day, label, {"median": 0.5}, ["time"]).select("time", "median").unionByName(
        exact_quantiles(day, label, {"median": 0.5}).select(F.lit("All").alias("time"), "median"))
    return stats.join(middle, "time", "left")
