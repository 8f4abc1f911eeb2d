"""Exact ranks, running totals, quantiles and lags that never sort one global or one hot group in a task.

The common idea has two levels. Approximate quantiles give split points, so each row gets a
slot number that is monotone in the order wanted. Slots are counted (a small table), the
counts become offsets, and rows are sorted only inside their slot. The result is exact for
any split points; they only decide how even the slots are. A value that fills several
quantiles by itself is split further by its tie-breaker.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.functions.calendar import micros_between
from cutline.operators.skew import split_hot
from cutline.session import default_slots

SLOT, TIE_SLOT, GROUP = "__slot", "__tie_slot", "__group"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def position_of(df: DataFrame, name: str) -> Column:
    """A double that grows with the column (numbers and timestamps)."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return micros_between(F.expr(EPOCH), F.col(name).cast("timestamp_ntz")).cast("double")
    return F.col(name).cast("double")


def bucketize(df: DataFrame, position: Column, splits: Sequence[float], out: str) -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0))
    edges = [-math.inf, *splits, math.inf]
    sizer = Bucketizer(splits=edges, inputCol=out + "_in", outputCol=out, handleInvalid="keep")
    return (sizer.transform(df.withColumn(out + "_in", position))
            .withColumn(out, F.col(out).cast("int")).drop(out + "_in"))


@dataclass
class Slots:
    """Split points of an order column and of its tie-breaker.

    ``parts`` says into how many tie ranges a slot is divided further: as many as the quantiles
    its one value fills, 0 for slots of ordinary values. All slots and parts together stay
    within a few times ``n``, whatever the data look like.
    """

    order: str
    splits: list[float]
    parts: list[int]
    tie: str | None
    tie_splits: list[float] | None
    n: int

    @classmethod
    def of(cls, df: DataFrame, order: str, tie: str | None = None, n: int | None = None) -> "Slots":
        n = n or default_slots(df.sparkSession)
        probs = [i / n for i in range(1, n)]
        numeric_tie = tie is not None and _is_number(df, tie)
        columns = [position_of(df, order).alias("order")]
        if numeric_tie:
            columns.append(position_of(df, tie).alias("tie"))
        found = df.select(*columns).approxQuantile(
            ["order", "tie"][: len(columns)], probs, 0.5 / n)
        points = [p for p in found[0] if math.isfinite(p)] if found and found[0] else []
        repeated = {p: k for p, k in Counter(points).items() if k > 1}
        splits = sorted({*points, *[math.nextafter(p, math.inf) for p in repeated]} - {math.inf})
        parts = [0] * (len(splits) + 2)
        for p, k in repeated.items():
            parts[bisect_right(splits, p)] = k
        tie_splits = sorted({p for p in found[1] if math.isfinite(p)}) if numeric_tie else None
        return cls(order, splits, parts, tie, tie_splits, n)

    def assign(self, df: DataFrame) -> DataFrame:
        df = bucketize(df, position_of(df, self.order), self.splits, SLOT)
        if self.tie is None or not any(self.parts):
            return df.withColumn(TIE_SLOT, F.lit(0))
        parts = F.get(F.lit(self.parts), F.col(SLOT))
        if self.tie_splits is not None:
            df = bucketize(df, position_of(df, self.tie), self.tie_splits, TIE_SLOT)
            share = F.col(TIE_SLOT) / F.lit(float(len(self.tie_splits) + 2))
        else:
            share = F.xxhash64(self.tie).cast("double") / F.lit(2.0**64) + F.lit(0.5)
        return df.withColumn(TIE_SLOT, F.floor(share * parts).cast("int"))

    def tie_order(self) -> list[Column]:
        if self.tie is None:
            return []
        if self.tie_splits is not None:
            return [F.col(self.tie)]
        return [F.xxhash64(self.tie), F.col(self.tie)]


def running_totals(
    df: DataFrame,
    order: str,
    sums: Mapping[str, Column],
    tie: str | Sequence[str] | None = None,
    descending: bool = False,
    slots: int | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Add an inclusive running total and ``<name>_total`` for each entry of ``sums``, of each ``group`` if it is named.

    Rows are ordered by (order, tie columns); NULL in the order column drops the row. Order and
    ties together must be distinct for a result that does not depend on the order of the rows.
    A string in the first tie is ordered by its hash. Groups share the slots, so a large group is
    spread over them; NULL is a group of its own.
    """
    df = df.where(F.col(order).isNotNull())
    ties = [tie] if isinstance(tie, str) else list(tie or ())
    plan = Slots.of(df, order, ties[0] if ties else None, slots)
    rows = plan.assign(df.select("*", *[c.alias(f"__in_{name}") for name, c in sums.items()]))
    # as a struct, groups with NULLs are equal too
    whole = [GROUP] if group else []
    rows = rows.withColumn(GROUP, F.struct(*group)) if group else rows
    by = [*whole, SLOT, TIE_SLOT]
    slot_order = [F.desc(SLOT) if descending else F.asc(SLOT), F.asc(TIE_SLOT)]
    earlier = Window.partitionBy(*whole).orderBy(*slot_order).rowsBetween(Window.unboundedPreceding, -1)
    per_slot = rows.groupBy(*by).agg(*[F.sum(f"__in_{name}").alias(f"__sum_{name}") for name in sums])
    # one row per slot, so the window sees a bounded table for each group
    offsets = per_slot.select(*by, *[
        F.coalesce(F.sum(f"__sum_{name}").over(earlier), F.lit(0)).alias(f"__before_{name}")
        for name in sums
    ], *[F.sum(f"__sum_{name}").over(Window.partitionBy(*whole)).alias(f"{name}_total") for name in sums])
    order_col = F.desc(order) if descending else F.asc(order)
    inside = (Window.partitionBy(*by).orderBy(order_col, *plan.tie_order(), *ties[1:])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.join(offsets if group else F.broadcast(offsets), by)
    out = out.select(*df.columns, *[f"{name}_total" for name in sums], *[
        (F.col(f"__before_{name}") + F.sum(f"__in_{name}").over(inside)).alias(name) for name in sums])
    return out


def with_rank(df: DataFrame, order: str, tie: str | Sequence[str], descending: bool = False, slots: int | None = None) -> DataFrame:
    """Ordinal rank 1…n in a total order, with the row count as ``rank_total``."""
    return running_totals(df, order, {"rank": F.lit(1).cast("bigint")}, tie, descending, slots)


def with_deciles(df: DataFrame, score: str, tie: str | Sequence[str], out: str = "decile") -> DataFrame:
    """Ten equal-width rank bins; 0.1 holds the highest scores, 1.0 the lowest."""
    ranked = with_rank(df, score, tie)
    width = F.greatest(F.col("rank_total") - 1, F.lit(1))
    bin_no = F.greatest(F.lit(1), F.ceil((F.col("rank") - 1) * 10 / width))
    return ranked.withColumn(out, ((11 - bin_no) / 10).cast("double")).drop("rank", "rank_total")


def quantile_rows(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    group: Sequence[str] = (),
    method: str = "linear",
    weight: str | None = None,
    slots: Slots | int | None = None,
) -> DataFrame:
    """Exact quantiles per group (or over all rows), one row per quantile.

    Columns: the group, ``position`` in ``probs``, ``quantile``, ``n`` (rows of the group) and
    ``upto``, the number of rows at or below the value (``linear``: below the lower neighbour).
    ``linear`` interpolates, ``higher`` takes the next value up. Only rows in slots that hold a
    wanted rank are sorted. ``weight`` counts a row several times. ``slots`` may be split points
    taken from cheaper rows with a similar spread of values.
    """
    if method not in ("linear", "higher"):
        raise ValueError(f"unknown method: {method!r}")
    group = list(group)
    df = df.where(F.col(value).isNotNull())
    plan = slots if isinstance(slots, Slots) else Slots.of(df, value, n=slots)
    rows = plan.assign(df).drop(TIE_SLOT)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    running = Window.partitionBy(*group).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    per_slot = rows.groupBy(*group, SLOT).agg(size.alias("__n")).select(
        *group, SLOT, "__n", F.sum("__n").over(running).alias("__upto"),
        F.sum("__n").over(Window.partitionBy(*group)).alias("__total"))

    # ranks to look up per group; the slack keeps a product such as 0.7 * 10 on its integer rank
    wanted = ", ".join(f"{float(p)!r}D" for p in probs)
    low = "floor(p * (__total - 1) + 1e-9D)" if method == "linear" else "ceil(p * (__total - 1) - 1e-9D)"
    spots = F.expr(f"""transform(array({wanted}), (p, i) -> named_struct(
        'i', i, 'low', {low}, 'high', ceil(p * (__total - 1) - 1e-9D),
        'part', greatest(p * (__total - 1) - {low}, 0D)))""").alias("__spots")
    # the rows counted by __n up to __upto include a rank
    holds = "(__upto - __n <= s.{0} AND s.{0} < __upto)"
    near = per_slot.select("*", spots).where(f"exists(__spots, s -> {holds.format('low')} OR {holds.format('high')})")
    targets = near.select(*group, SLOT, (F.col("__upto") - F.col("__n")).alias("__before"), "__total")
    # a value that very many rows share is one row per task before anything moves
    if group:
        values = rows.groupBy(*group, SLOT, value).agg(size.alias("__n"))
        counted = values.join(targets, [*group, SLOT])
    else:
        counted = (rows.join(F.broadcast(targets), SLOT)
                   .groupBy(SLOT, "__before", "__total", value).agg(size.alias("__n")))
    inside = (Window.partitionBy(*group, SLOT).orderBy(value)
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("__upto", F.col("__before") + F.sum("__n").over(inside)).select("*", spots)
    ends = " , ".join(
        f"transform(filter(__spots, s -> {holds.format(end)}), s -> named_struct('position', s.i, 'is_low', "
        f"{'true' if end == 'low' else 'false'}, 'part', s.part))" for end in ("low", "high"))
    hits = placed.select(*group, "__total", "__upto", F.col(value).alias("__v"), F.expr(f"inline(concat({ends}))"))
    found = hits.groupBy(*group, "position").agg(
        F.expr("max(if(is_low, __v, null)) AS __lo"), F.expr("max(if(is_low, null, __v)) AS __hi"),
        F.expr("max(if(is_low, __upto, null)) AS upto"), F.expr("max(part) AS __part"), F.expr("max(__total) AS n"))
    quantile = "__hi" if method == "higher" else (
        "CASE WHEN __lo = __hi THEN CAST(__lo AS DOUBLE) ELSE (1 - __part) * __lo + __part * __hi END")
    return found.select(*group, "position", F.expr(quantile).alias("quantile"), "upto", "n")


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], group: Sequence[str] = (), **settings
) -> DataFrame:
    """``quantile_rows`` with one column per named quantile, ``<name>_upto`` columns and ``n``.

    Without a group there is always one row.
    """
    found = quantile_rows(df, value, list(probs.values()), group, **settings)

    picks = [F.expr(f"max(if(position = {i}, {column}, null))").alias(name + end)
             for column, end in (("quantile", ""), ("upto", "_upto")) for i, name in enumerate(probs)]
    return found.groupBy(*group).agg(F.max("n").alias("n"), *picks)


def previous_row(
    df: DataFrame,
    key: str,
    time: str,
    tie: Sequence[str],
    columns: Mapping[str, str],
    slots: int | None = None,
) -> DataFrame:
    """Add ``out = previous value of column`` per key in (time, tie) order; NULL on a key's first row.

    Rows without a key or a time have no previous row and are none: they stay, with NULL. Keys with
    very many rows are split by time range, and inside one time by range of a numeric first tie;
    only the first row of each range needs a value from an earlier range, and that comes from the
    last row per (key, range).
    """
    absent = df.where(F.col(time).isNull() | F.col(key).isNull())
    done = absent.select(*df.columns, *[F.lit(None).cast(df.schema[c].dataType).alias(out) for out, c in columns.items()])
    df = df.where(F.col(time).isNotNull() & F.col(key).isNotNull())
    order = [F.col(time), *[F.col(c) for c in tie]]
    cold, hot = split_hot(df, key)
    of_key = Window.partitionBy(key).orderBy(*order)
    done = done.unionByName(cold.select(*df.columns, *[F.lag(c).over(of_key).alias(out) for out, c in columns.items()]))
    if hot is None:
        return done
    splits_ties = bool(tie) and _is_number(df, tie[0])
    rows = Slots.of(hot, time, tie[0] if splits_ties else None, slots).assign(hot)
    at = [SLOT, TIE_SLOT]
    inside = Window.partitionBy(key, *at).orderBy(*order)
    lagged = rows.select(
        "*", F.row_number().over(inside).alias("__pos"),
        *[F.lag(c).over(inside).alias(f"__lag_{out}") for out, c in columns.items()])
    last = rows.groupBy(key, *at).agg(
        F.max(F.struct(*order, *[F.col(c).alias(f"__v_{out}") for out, c in columns.items()])).alias("__last"))
    carry = last.select(
        F.col(key), *at, F.lag("__last").over(Window.partitionBy(key).orderBy(*at)).alias("__carry"))
    joined = lagged.join(carry, [key, *at], "left")
    return done.unionByName(joined.select(*df.columns, *[
        F.when(F.col("__pos") == 1, F.col(f"__carry.__v_{out}")).otherwise(F.col(f"__lag_{out}")).alias(out)
        for out in columns]))


def percentile_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Average rank divided by the number of non-null rows, like a ranking with averaged ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    placed = running_totals(counts, value, {"__upto": F.col("__n")})
    share = (F.col("__upto") - F.col("__n") + (F.col("__n") + 1) / 2) / F.col("__upto_total")
    return df.join(placed.select(value, share.alias(out)), value, "left")
