"""Evaluates planned features for (key, time) instances, using only rows before each cutoff."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.functions.calendar import as_datetime, ntz, seconds_between
from cutline.functions.moments import aligned
from cutline.functions.primitives import BUILT_IN, MERGES, PARTIALS, TREND_ORIGIN, aggregate, transform
from cutline.operators.entities import Entity, EntitySet
from cutline.operators.ranking import Slots, bucketize, exact_quantiles, percentile_rank, position_of, previous_row
from cutline.operators.skew import split_hot
from cutline.operators.windows import BUCKET, Buckets, RoleWindow, interval_join
from cutline.plans.feature_plan import Feature, FeatureSpec, Source, plan_features
from cutline.session import checkpointed

FIRST_MOMENT = datetime(1, 1, 1)
MAX_TIMES = 1000
EXPRESSIONS_PER_PASS = 120
# cutoff minus event time: which partials of the event time give a partial of the difference
# two partials that may be NULL, merged
PAIRWISE = {"sum": lambda a, b: F.coalesce(a + b, a, b), "min": F.least, "max": F.greatest}
ENDS_AT_CUTOFF = ("time_since_first", "time_since_last", "days_since_last")  # change with every cutoff
AGE_NEEDS = {"rows": ("rows",), "cnt": ("cnt",), "sum": ("sum", "cnt"), "min": ("max",), "max": ("min",)}
KEY, TIME, AT, TIE, PART = "__key", "__time", "__at", "__tie", "__part"


@dataclass
class _Window:
    """How rows of a child meet the instances: a few known cutoffs, or any number of them."""

    buckets: Buckets | None
    instances: DataFrame
    spec: FeatureSpec

    def pairs(self, rows: DataFrame) -> DataFrame:
        """Rows with every cutoff (``__time``) they count for."""
        if self.buckets is not None:
            return interval_join(rows, AT, self.buckets, TIME).drop("in_past")
        upper = F.col(AT) <= F.col(TIME) if self.spec.include_cutoff else F.col(AT) < F.col(TIME)
        within = rows.join(self.instances.select(KEY, TIME).distinct(), KEY).where(upper)
        if self.spec.training_window is not None:
            within = within.where(F.col(AT) >= F.col(TIME) - self.spec.training_window.interval())
        return within


def past_windows(times: Sequence[datetime], spec: FeatureSpec) -> Buckets:
    width, step = spec.training_window, timedelta(microseconds=1 if spec.include_cutoff else 0)
    return Buckets([RoleWindow(t, "past", width.before(t) if width else FIRST_MOMENT, t + step) for t in times])


def make_features(
    es: EntitySet,
    spec: FeatureSpec,
    instances: DataFrame,
    times: Sequence[datetime] | None = None,
    features: Sequence[Feature] | None = None,
) -> DataFrame:
    """(key, time, one column per feature) with the rows of ``instances``.

    Instances before the target's own time are left out; a NULL cutoff has rows with empty features. ``instances`` has the target's key and ``time``. ``times`` are its distinct cutoffs, if known;
    otherwise they are read with one small job. Up to a thousand cutoffs are served by time
    buckets; with more, merged features come from the state of each key as of each instance, others join on key and time range.
    """
    target = es[spec.target]
    features = list(features) if features is not None else plan_features(es, spec)
    base = instances.select(F.col(target.key).alias(KEY), F.col("time").cast("timestamp_ntz").alias(TIME))
    if times is None:
        seen = base.select(TIME).where(F.col(TIME).isNotNull()).distinct().limit(MAX_TIMES + 1).collect()
        times = [r[0] for r in seen]
    buckets = past_windows([as_datetime(t) for t in times], spec) if 0 < len(times) <= MAX_TIMES else None
    window = _Window(buckets, base, spec)
    ids = {f.name: f"f{i}" for i, f in enumerate(features)}

    out = _target_features(es, target, base, [f for f in features if f.how != "aggregate"], ids)
    for child, column in es.children(target.name):
        mine = [f for f in features if f.how == "aggregate" and f.entity == child.name]
        if mine:
            for part, on in _child_features(es, child, column, mine, ids, window):
                out = out.join(part, on, "left")
    return out.select(F.col(KEY).alias(target.key), F.col(TIME).alias("time"), *[
        _filled(f, ids[f.name]).alias(f.name) for f in features])


def _filled(f: Feature, column: str) -> Column:
    default = aggregate(f.primitive).default if f.how == "aggregate" else None
    return F.col(column) if default is None else F.coalesce(F.col(column), F.lit(default))


def _target_features(es, target: Entity, base: DataFrame, features: Sequence[Feature], ids) -> DataFrame:
    own = [f for f in features if f.how == "target"]
    rows, names = _prepare(es, target, target.key, [f.source for f in own])
    joined = base.join(rows.drop(TIE), KEY, "left")
    if target.time:
        joined = joined.where(F.col(AT).isNull() | (F.col(AT) <= F.col(TIME)))
    picks = []
    for f in own:
        t = transform(f.source.transform) if f.source.how == "transform" else None
        value = F.col(names[f.source])
        picks.append((t.build(value, F.col(TIME)) if t and t.kind == "cutoff" else value).alias(ids[f.name]))
    picks += [F.month(TIME).alias(ids[f.name]) for f in features if f.how == "cutoff"]
    return joined.select(KEY, TIME, *picks)


def _prepare(
    es: EntitySet, entity: Entity, key: str, sources: Sequence[Source]
) -> tuple[DataFrame, dict[Source, str]]:
    """Rows of an entity as (__key, __at, __tie, s0, s1, …), one ``s`` column per source.

    Sources that need the cutoff or a child aggregate keep their input column here.
    """
    sources = [s for s in dict.fromkeys(sources) if s is not None]
    df = entity.df.where(F.col(key).isNotNull())
    if entity.time:
        df = df.withColumn(entity.time, F.col(entity.time).cast("timestamp_ntz"))
    lagged = {s: f"__lag{i}" for i, s in enumerate(sources)
              if s.how == "transform" and transform(s.transform).kind == "previous"}
    if lagged:
        group = key if key != entity.key else _first_parent(entity)
        df = previous_row(df, group, entity.time, entity.tie_columns(), {lagged[s]: s.column for s in lagged})
    ranked = {s: f"__rank{i}" for i, s in enumerate(sources)
              if s.how == "transform" and transform(s.transform).kind == "entity"}
    for s, out in ranked.items():
        df = percentile_rank(df, s.column, out)
    for p in entity.parents:
        wanted = sorted({s.column for s in sources if s.how == "parent" and s.parent == p.name})
        if wanted:
            parent = es[p.name]
            side = parent.df.select(F.col(parent.key).alias("__pk"), *[
                F.col(c).alias(f"__{p.name}.{c}") for c in wanted])
            df = df.join(side, F.col(p.column) == F.col("__pk"), "left").drop("__pk")

    def value(s: Source) -> Column:
        if s.how == "parent":
            return F.col(f"`__{s.parent}.{s.column}`")
        if s in lagged:
            return transform(s.transform).build(F.col(s.column), F.col(lagged[s]))
        if s in ranked:
            return F.col(ranked[s])
        if s.how == "transform" and transform(s.transform).kind == "row":
            return transform(s.transform).build(F.col(s.column))
        return F.col(s.column)

    names = {s: f"s{i}" for i, s in enumerate(sources)}
    at = F.col(entity.time) if entity.time else F.lit(None).cast("timestamp_ntz")
    row_id = [F.col(entity.key).alias("__row")] if any(s.how == "inner" for s in sources) else []
    rows = df.select(F.col(key).alias(KEY), at.alias(AT), F.struct(*entity.tie_columns()).alias(TIE), *row_id, *[
        value(s).alias(names[s]) for s in sources if s.how != "inner"])
    return rows, names


def _first_parent(entity: Entity) -> str:
    if not entity.parents:
        raise ValueError(f"{entity.name}: a previous row needs a parent key to group by")
    return entity.parents[0].column


def _is_age(s: Source | None) -> bool:
    """Does the source depend on the cutoff, as the time since an event does?"""
    return s is not None and s.how == "transform" and transform(s.transform).kind == "cutoff"


def _route(f: Feature) -> str:
    s = f.source
    if s is not None and s.how == "inner":
        return "inner"
    if _is_age(s):
        prim = aggregate(f.primitive)
        return "merge" if prim.route == "merge" and set(prim.needs) <= set(AGE_NEEDS) else "pairs"
    return aggregate(f.primitive).route


def _child_features(es, child: Entity, column: str, features, ids, window: _Window):
    """(result, join columns) pairs; each result has one row per (key, cutoff) or per key."""
    wheres = [f.where[0] for f in features if f.where]
    rows, names = _prepare(es, child, column, [*[f.source for f in features], *wheres])
    timed = child.time is not None
    on = [KEY, TIME] if timed else [KEY]
    routes: dict[str, list[Feature]] = {}
    for f in features:
        routes.setdefault(_route(f), []).append(f)
    plain = [f for r in ("merge", "order") for f in routes.get(r, [])]
    for chunk in _chunks(plain, EXPRESSIONS_PER_PASS):
        yield _merged(rows, names, chunk, ids, window, on), on
    if "values" in routes:
        yield _by_value(rows, names, routes["values"], ids, window, on), on
    if "median" in routes:
        yield _median(rows, names, routes["median"], ids, window, on), on
    if "pairs" in routes:
        yield _paired(window.pairs(rows) if timed else rows, names, routes["pairs"], ids, on), on
    if "inner" in routes:
        for part in _inner(es, child, rows, names, routes["inner"], ids, window):
            yield part, on


def _chunks(items: Sequence, size: int):
    for i in range(0, len(items), size):
        yield items[i:i + size]


def _keep(f: Feature, names) -> Column | None:
    if f.where is None:
        return None
    source, value = f.where
    return F.col(names[source]) == F.lit(value)


def _masked(c: Column, keep: Column | None) -> Column:
    return c if keep is None else F.when(keep, c)


def _value_of(f: Feature, names) -> Column:
    """The feature's input on rows that know their cutoff."""
    s = f.source
    if s is None:
        return F.col(AT)
    x = F.col(names[s])
    if s.how == "transform" and transform(s.transform).kind == "cutoff":
        return transform(s.transform).build(x, F.col(TIME))
    return x


class _Partials:
    """The distinct partial aggregates a list of features needs, each computed once."""

    def __init__(self, features: Sequence[Feature], names, ages: bool = False):
        self.ages = ages
        self.columns: dict[str, Column] = {}
        self.merges: dict[str, str] = {}
        self.uses: dict[str, dict[str, str]] = {}
        ends: dict[tuple, list[Feature]] = {}
        slots: dict[tuple, str] = {}
        for f in features:
            prim = aggregate(f.primitive)
            keep = _keep(f, names)
            if prim.route == "order":
                ends.setdefault((prim.name, f.where), []).append(f)
                continue
            self.uses[f.name] = {}
            needs = prim.needs
            if ages and _is_age(f.source):
                needs = dict.fromkeys(n for need in needs for n in AGE_NEEDS[need])
            for need in needs:
                kind = PARTIALS[need]
                slot = (need, f.where, None if need == "rows" or prim.takes == "time" else f.source)
                if slot not in slots:
                    slots[slot] = f"p{len(slots)}"
                    value = _moment(names, f.source) if ages and _is_age(f.source) else _value_of(f, names)
                    x = _masked(value, keep)
                    self.columns[slots[slot]] = kind.build(
                        x, _masked(F.col(AT), keep), _masked(F.lit(1), keep))
                    self.merges[slots[slot]] = kind.merge
                self.uses[f.name][need] = slots[slot]
        for i, ((end, _), members) in enumerate(ends.items()):
            row = F.struct(F.col(AT), F.col(TIE), *[
                _value_of(f, names).alias(f"v{j}") for j, f in enumerate(members)])
            pick = F.min if end == "first" else F.max
            self.columns[f"e{i}"] = pick(_masked(row, _keep(members[0], names)))
            self.merges[f"e{i}"] = "min" if end == "first" else "max"
            for j, f in enumerate(members):
                self.uses[f.name] = {"end": f"e{i}", "field": f"v{j}"}

    def aligned(self, df: DataFrame) -> DataFrame:
        of_kind = {k: [n for n, how in self.merges.items() if how == k] for k in ("moments", "comoments")}
        return aligned(df, KEY, of_kind["moments"], of_kind["comoments"])

    def finish(self, f: Feature) -> Column:
        use = self.uses[f.name]
        if "end" in use:
            return F.col(use["end"])[use["field"]]
        parts = {need: F.col(slot) for need, slot in use.items()}
        if self.ages and _is_age(f.source):
            now = seconds_between(F.expr(TREND_ORIGIN), F.col(TIME))
            made = {
                "rows": lambda: parts["rows"], "cnt": lambda: parts["cnt"], "sum": lambda: parts["cnt"] * now - parts["sum"],
                "min": lambda: now - parts["max"], "max": lambda: now - parts["min"]}
            parts = {need: made[need]() for need in aggregate(f.primitive).needs}
        return aggregate(f.primitive).finish(parts, F.col(TIME))


def _moment(names, source: Source) -> Column:
    """Seconds from a fixed origin to the source's time."""
    return seconds_between(F.expr(TREND_ORIGIN), F.col(names[source]))


def _merged(rows, names, features, ids, window: _Window, on) -> DataFrame:
    partials = _Partials(features, names, ages=True)
    first = [c.alias(n) for n, c in partials.columns.items()]
    if TIME in on and window.buckets is None and window.spec.training_window is None:
        late = [f for f in features if any(PARTIALS[need].merge not in PAIRWISE for need in aggregate(f.primitive).needs)]
        early = [f for f in features if f not in late]
        if early:
            done = _as_of(rows, names, early, ids, window)
            return done.join(_merged_pairs(rows, names, late, ids, window), on, "left") if late else done
    if TIME in on and window.buckets is not None:
        cutoffs = _Cutoffs.of(window.buckets, len(partials.columns) + 1)
        reduced = window.buckets.assign(rows, AT).groupBy(KEY, BUCKET).agg(*first)
        placed = cutoffs.placed(partials.aligned(reduced.repartition(KEY)))
        picks = {f"v{i}_{n}": MERGES[how](F.when(cutoffs.holds(i), F.col(n))) for i in range(cutoffs.width) for n, how in partials.merges.items()}
        picks |= {f"v{i}_rows": F.count(F.when(cutoffs.holds(i), 1)) for i in range(cutoffs.width)}
        wide = placed.groupBy(KEY, PART).agg(*[value.alias(n) for n, value in picks.items()])
        groups = [[f"v{i}_{n}" for n in [*partials.merges, "rows"]] for i in range(cutoffs.width)]
        done = cutoffs.spread(wide, groups, [*partials.merges, "__rows"]).where("__rows > 0")
    else:
        pairs = window.pairs(rows) if TIME in on else rows
        done = pairs.groupBy(*on).agg(*first)
    return done.select(*on, *[partials.finish(f).alias(ids[f.name]) for f in features])


def _merged_pairs(rows, names, features, ids, window: _Window) -> DataFrame:
    partials = _Partials(features, names, ages=True)
    done = window.pairs(rows).groupBy(KEY, TIME).agg(*[c.alias(n) for n, c in partials.columns.items()])
    return done.select(KEY, TIME, *[partials.finish(f).alias(ids[f.name]) for f in features])


def _as_of(rows, names, features, ids, window: _Window) -> DataFrame:
    """Merged features at any number of cutoffs: the state of each key as of each instance, without pairs.

    Time is cut into ranges of about as many rows each. A key's rows are reduced to one state per range, whose running merge
    has a row per range at most; inside a range rows and instances are sorted together and merged once more. So a key with a
    large part of all rows is spread over the ranges, and each row is moved once, whatever the number of cutoffs.
    """
    partials = _Partials(features, names, ages=True)
    held = list(partials.columns)
    merged = {n: MERGES[how] for n, how in partials.merges.items()}
    events = rows.where(F.col(AT).isNotNull())
    slots = Slots.of(events, AT)
    by_time = bucketize(events, position_of(events, AT), slots.splits, "__range").groupBy(KEY, "__range", F.col(AT).alias("__t")).agg(
        *[c.alias(n) for n, c in partials.columns.items()])
    asked = window.instances.select(KEY, TIME).where(F.col(TIME).isNotNull()).distinct()
    asked = bucketize(asked, position_of(asked, TIME), slots.splits, "__range").select(KEY, "__range", F.col(TIME).alias("__t"))
    asked = asked.select("*", *[F.lit(None).cast(by_time.schema[n].dataType).alias(n) for n in held])
    per_range = by_time.drop("__t").unionByName(asked.drop("__t")).groupBy(KEY, "__range").agg(*[m(F.col(n)).alias(n) for n, m in merged.items()])
    before = Window.partitionBy(KEY).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_range.select(KEY, "__range", *[m(F.col(n)).over(before).alias(f"__before_{n}") for n, m in merged.items()])
    first, second = (0, 1) if window.spec.include_cutoff else (1, 0)
    both = by_time.withColumn("__asks", F.lit(first)).unionByName(asked.withColumn("__asks", F.lit(second)))
    inside = Window.partitionBy(KEY, "__range").orderBy("__t", "__asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = both.select(KEY, "__range", "__t", "__asks", *[m(F.col(n)).over(inside).alias(n) for n, m in merged.items()])
    state = state.where(F.col("__asks") == second).join(earlier, [KEY, "__range"])
    done = state.select(KEY, F.col("__t").alias(TIME), *[
        PAIRWISE[how](F.col(n), F.col(f"__before_{n}")).alias(n) for n, how in partials.merges.items()])
    return done.select(KEY, TIME, *[partials.finish(f).alias(ids[f.name]) for f in features])


def _value_slot(f: Feature, rows: DataFrame, names) -> str:
    """Values are counted in a column of their kind, so that ties fall to the smallest value of the kind:
    vl (integers, booleans), vd (doubles), vn (decimals), vt (times and dates), vs (text)."""
    dtype = rows.schema[names[f.source]].dataType
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return "vl"
    if isinstance(dtype, T.DecimalType):
        return "vn"
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return "vt"
    return "vd" if isinstance(dtype, (T.DoubleType, T.FloatType)) else "vs"


def _value_counts(rows, cells: Column, columns, window: _Window, on) -> DataFrame:
    """Counts per (key, cutoff, cell) without time buckets."""
    pairs = window.pairs(rows) if TIME in on else rows
    return _exploded(pairs, cells, columns, *on).groupBy(*on, *columns).agg(F.count(F.lit(1)).alias("n"))


def _exploded(df: DataFrame, cells: Column, columns, *keep: str) -> DataFrame:
    flat = df.select(*keep, F.inline(cells))
    return flat.where(F.coalesce(*[F.col(c).cast("string") for c in columns if c != "cell"]).isNotNull())


@dataclass
class _Cutoffs:
    """Known cutoffs in parts of ``width``: what is aggregated has one row per part, with columns for its cutoffs."""

    buckets: Buckets
    width: int

    @classmethod
    def of(cls, buckets: Buckets, columns: int) -> _Cutoffs:
        """Parts that take about ``EXPRESSIONS_PER_PASS`` columns, if a cutoff takes ``columns``."""
        return cls(buckets, max(1, min(len({w.cutoff for w in buckets.windows}), EXPRESSIONS_PER_PASS // columns)))

    def __post_init__(self):
        self.times = sorted({w.cutoff for w in self.buckets.windows})
        self.counts = [f"__n{i}" for i in range(self.width)]

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows that have a bucket, once for each part of cutoffs that it counts for."""
        # both ends of the windows rise with the cutoff, so a bucket counts for a run of cutoffs
        edges, at, first, last = self.buckets.edges, {t: i for i, t in enumerate(self.times)}, {}, {}
        for w in self.buckets.windows:
            for b in range(bisect_left(edges, w.begin), bisect_left(edges, w.end)):
                first[b] = min(at[w.cutoff], first.get(b, at[w.cutoff]))
                last[b] = max(at[w.cutoff], last.get(b, at[w.cutoff]))

        def known(run: dict[int, int]) -> Column:
            return F.get(F.array(*[F.lit(run.get(b)).cast("int") for b in range(len(edges) - 1)]), F.col(BUCKET))

        spans = rows.withColumns({"__first": known(first), "__last": known(last)}).drop(BUCKET).where("__first is not null")
        if self.width == len(self.times):
            return spans.withColumn(PART, F.lit(0))
        return spans.withColumn(PART, F.explode(F.sequence(F.expr(f"__first div {self.width}"), F.expr(f"__last div {self.width}"))))

    def holds(self, i: int) -> Column:
        """Does a placed row count for the i-th cutoff of its part?"""
        number = F.col(PART) * self.width + i
        return (F.col("__first") <= number) & (number <= F.col("__last"))

    def counted(self, rows: DataFrame, columns) -> DataFrame:
        """(key, part, columns, counts) of rows with a bucket. Rows are counted before they move, by key and value."""
        return self.placed(rows).groupBy(KEY, PART, *columns).agg(*[
            F.count(F.when(self.holds(i), 1)).alias(n) for i, n in enumerate(self.counts)])

    def spread(self, wide: DataFrame, groups: Sequence[Sequence[str]], out: Sequence[str]) -> DataFrame:
        """(other columns, time, out) from the columns ``groups[i]`` for the i-th cutoff of each part."""
        times, held = F.array(*[ntz(t) for t in self.times]), {PART, *self.counts, *[c for group in groups for c in group]}
        cells = F.array(*[F.struct(F.get(times, F.col(PART) * self.width + i).alias(TIME), *[
            F.col(c).alias(o) for c, o in zip(group, out)]) for i, group in enumerate(groups)])
        return wide.select(*[c for c in wide.columns if c not in held], F.inline(cells)).where(F.col(TIME).isNotNull())


def _by_value(rows, names, features, ids, window: _Window, on) -> DataFrame:
    cell_of: dict[tuple, int] = {}
    slot_of: dict[tuple, str] = {}
    for f in features:
        cell_of.setdefault((f.source, f.where), len(cell_of))
        slot_of[(f.source, f.where)] = _value_slot(f, rows, names)
    slots = sorted(set(slot_of.values()))
    types = {"vl": "bigint", "vd": "double", "vn": "decimal(38,10)", "vt": "timestamp_ntz", "vs": "string"}

    def cell(source: Source, where) -> Column:
        probe = Feature("", "", "", "", source, None, where)
        x = _masked(F.col(names[source]), _keep(probe, names))
        return F.struct(F.lit(cell_of[(source, where)]).alias("cell"), *[
            (x.cast(types[s]) if s == slot_of[(source, where)] else F.lit(None).cast(types[s])).alias(s)
            for s in slots])

    columns = ["cell", *slots]
    cells = F.array(*[cell(*k) for k in cell_of])

    def pick(f: Feature, n: Column) -> Column:
        """The feature from rows (cell, value) with the count ``n``, NULL or positive."""
        here = F.col("cell") == cell_of[(f.source, f.where)]
        if f.primitive == "num_unique":
            return F.count(F.when(here, n))
        if f.primitive == "entropy":
            size = F.when(here, n.cast("double"))
            return F.ln(F.sum(size)) - F.sum(size * F.ln(size)) / F.sum(size)
        value = F.col(slot_of[(f.source, f.where)])
        return F.min(F.when(here & n.isNotNull(), F.struct((-n).alias("n"), value.alias("v"))))["v"].cast(rows.schema[names[f.source]].dataType)

    single = [f for f in features if f.primitive != "n_most_common"]
    common = [f for f in features if f.primitive == "n_most_common"]
    if TIME in on and window.buckets is not None:
        cutoffs, outs = _Cutoffs.of(window.buckets, len(single) + 1), []
        cold, hot = split_hot(window.buckets.assign(rows, AT), KEY)
        for some, by_key in ((cold, True), (hot, False)):
            if some is not None:
                counted = cutoffs.counted(_exploded(some, cells, columns, KEY, BUCKET), columns)
                outs.append((_single_values(counted, cutoffs, single, ids, pick, by_key) if single else None,
                             cutoffs.spread(counted, [[n] for n in cutoffs.counts], ["n"]).where("n > 0") if common else None))
        out, counts = (reduce(DataFrame.unionByName, sides) if sides[0] is not None else None for sides in zip(*outs))
    else:
        counts = _value_counts(rows, cells, columns, window, on)
        out = counts.groupBy(*on).agg(*[pick(f, F.col("n")).alias(ids[f.name]) for f in single]) if single else None
    if common:
        best = Window.partitionBy(*on, "cell").orderBy(F.desc("n"), *slots)
        top = counts.withColumn("pos", F.row_number().over(best)).where(F.col("pos") <= 3)
        lists = []
        for f in common:
            here = F.col("cell") == cell_of[(f.source, f.where)]
            held = F.array_sort(F.collect_list(F.when(
                here, F.struct("pos", F.col(slot_of[(f.source, f.where)]).alias("v")))))
            dtype = rows.schema[names[f.source]].dataType
            lists.append(held["v"].cast(T.ArrayType(dtype)).alias(ids[f.name]))
        tops = top.groupBy(*on).agg(*lists)
        out = tops if out is None else out.join(tops, on, "left")
    return out


def _single_values(counted: DataFrame, cutoffs: _Cutoffs, features, ids, pick, by_key: bool) -> DataFrame:
    """(key, time, features) from the counts of each value, of one row per key and part until the end.

    Rows of ordinary keys (``by_key``) meet in one task; those of very frequent keys are reduced where their values lie.
    """
    held = counted.repartition(KEY) if by_key else counted
    picks, names = [], []
    for i, c in enumerate(cutoffs.counts):
        n = F.nullif(F.col(c), F.lit(0))
        made = {f"v{i}_{j}": pick(f, n) for j, f in enumerate(features)} | {f"v{i}_rows": F.count(n)}
        picks += [value.alias(name) for name, value in made.items()]
        names.append(list(made))
    out = [ids[f.name] for f in features]
    done = held.groupBy(KEY, PART).agg(*picks)
    return cutoffs.spread(done, names, [*out, "__rows"]).where("__rows > 0").select(KEY, TIME, *out)


def _median(rows, names, features, ids, window: _Window, on) -> DataFrame:
    """All medians of a child. Values of ordinary keys meet in one task; others are ranked by value ranges."""
    inputs = [_masked(F.col(names[f.source]).cast("double"), _keep(f, names)) for f in features]
    if TIME not in on or window.buckets is None:
        cold, hot = None, window.pairs(rows) if TIME in on else rows
    else:
        cold, hot = split_hot(window.buckets.assign(rows, AT), KEY, len({w.cutoff for w in window.buckets.windows}))
    out = None
    if cold is not None:
        slim = cold.select(KEY, BUCKET, *[x.alias(ids[f.name]) for f, x in zip(features, inputs)])
        out = window.buckets.expand(slim.repartition(KEY), TIME).groupBy(*on).agg(*[
            F.median(ids[f.name]).alias(ids[f.name]) for f in features])
    if hot is not None:
        cells = F.array(*[F.struct(F.lit(i).alias("cell"), x.alias("v")) for i, x in enumerate(inputs)])
        slots = Slots.of(hot.select(F.inline(cells)).where(F.col("v").isNotNull()), "v")
        at = [KEY, BUCKET] if cold is not None else on
        counts = (hot.select(*at, F.inline(cells)).where(F.col("v").isNotNull())
                  .groupBy(*at, "cell", "v").agg(F.count(F.lit(1)).alias("n")))
        if cold is not None:
            counts = window.buckets.expand(counts.repartition(KEY, "cell", "v"), TIME).groupBy(*on, "cell", "v").agg(
                F.sum("n").alias("n"))
        found = exact_quantiles(counts, "v", {"q": 0.5}, [*on, "cell"], weight="n", slots=slots)
        part = found.groupBy(*on).agg(*[
            F.max(F.when(F.col("cell") == i, F.col("q"))).alias(ids[f.name]) for i, f in enumerate(features)])
        out = part if out is None else out.unionByName(part)
    return out


def _paired(pairs, names, features, ids, on) -> DataFrame:
    """Features that can only be computed on rows that already know their cutoff."""
    free = [f for f in features if aggregate(f.primitive).route == "pairs"]
    simple = [f for f in features if aggregate(f.primitive).route in ("merge", "order")]
    partials = _Partials(simple, names)
    picks = [c.alias(n) for n, c in partials.columns.items()]
    for f in free:
        keep = _keep(f, names)
        prim = aggregate(f.primitive)
        picks.append(prim.expr(_masked(_value_of(f, names), keep), _masked(F.col(AT), keep), F.col(TIME))
                     .alias(ids[f.name]))
    out = None
    if picks:
        done = pairs.groupBy(*on).agg(*picks)
        out = done.select(*on, *[ids[f.name] for f in free],
                          *[partials.finish(f).alias(ids[f.name]) for f in simple])
    for f in features:
        if aggregate(f.primitive).route == "median":
            x = _masked(_value_of(f, names), _keep(f, names))
            fixed = pairs.select(*on, x.cast("double").alias("v"))
            if f.source.how == "inner":
                fixed = checkpointed(fixed)
            part = exact_quantiles(fixed, "v", {"q": 0.5}, on).select(*on, F.col("q").alias(ids[f.name]))
            out = part if out is None else out.join(part, on, "full")
    return out


def _streams(es, child: Entity, f: Feature, window: _Window) -> bool:
    """Does the inner aggregate only change where a row comes in, and can the outer one be merged?

    So it is with cutoffs known in advance that all reach back to the first moment, and partials that a running sum, minimum or
    maximum carries on.
    """
    inner = f.source.inner
    prim = aggregate(inner.primitive)
    if window.buckets is None or window.spec.training_window is not None or not child.time or not es[inner.entity].time:
        return False
    if prim.name in ENDS_AT_CUTOFF or prim.name not in BUILT_IN or prim.route not in ("merge", "order"):
        return False
    if inner.source is not None and (inner.source.how == "inner" or _is_age(inner.source)):
        return False
    simple = all(PARTIALS[need].merge in ("sum", "min", "max") for need in prim.needs)
    return simple and aggregate(f.primitive).route in ("merge", "order")


def _streamed(es, rows, names, features, ids, window: _Window, grandchild: Entity, column: str) -> DataFrame:
    """Outer aggregates from the changes of the inner ones.

    An inner aggregate keeps its value from one of its own rows to the next. So each child row has one state per time bucket
    with a change, valid from that bucket to the one before the next change, whatever the number of cutoffs. States of a key
    with the same first and last bucket are aggregated before they move by key, and only there meet the cutoffs.
    """
    buckets = window.buckets
    times = sorted({w.cutoff for w in buckets.windows})  # cutoff number j takes the buckets 0 to j
    sources = list(dict.fromkeys(f.source for f in features))
    inner = [s.inner for s in sources]
    wheres = [f.where[0] for f in inner if f.where]
    below, below_names = _prepare(es, grandchild, column, [*[f.source for f in inner], *wheres])
    partials = _Partials(inner, below_names)
    reduced = buckets.assign(below, AT).groupBy(F.col(KEY).alias("__row"), F.col(BUCKET).alias("__b")).agg(
        *[c.alias(f"i_{n}") for n, c in partials.columns.items()])
    owners = buckets.assign(rows.where(F.col(AT).isNotNull()), AT)
    held = [f"i_{n}" for n in partials.columns]
    own = owners.select("__row", F.col(BUCKET).alias("__own"))
    later = reduced.join(own, "__row").select("__row", F.greatest("__b", "__own").alias("__from"), *held)
    start = own.select("__row", F.col("__own").alias("__from"), *[F.lit(None).cast(reduced.schema[c].dataType).alias(c) for c in held])
    changes = later.unionByName(start).groupBy("__row", "__from").agg(
        *[MERGES[how](F.col(f"i_{n}")).alias(f"i_{n}") for n, how in partials.merges.items()])
    order = Window.partitionBy("__row").orderBy("__from")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = changes.select("__row", "__from", F.coalesce(F.lead("__from").over(order) - 1, F.lit(len(times) - 1)).alias("__last"),
                            *[MERGES[how](F.col(f"i_{n}")).over(running).alias(n) for n, how in partials.merges.items()])
    inner_ids = {f.name: f"g{i}" for i, f in enumerate(inner)}
    states = states.select("__row", "__from", "__last", *[partials.finish(f).alias(inner_ids[f.name]) for f in inner])
    side = owners.drop(BUCKET).join(states, "__row").withColumns({names[s]: _filled(s.inner, inner_ids[s.inner.name]) for s in sources})
    outer = _Partials(features, names)
    spans = side.groupBy(KEY, "__from", "__last").agg(*[c.alias(n) for n, c in outer.columns.items()])
    moved = outer.aligned(spans.repartition(KEY))
    cutoffs = F.array(*[ntz(t) for t in times])
    wide = moved.withColumn("__j", F.explode(F.sequence("__from", "__last"))).withColumn(TIME, F.get(cutoffs, F.col("__j")))
    done = wide.groupBy(KEY, TIME).agg(*[MERGES[how](F.col(n)).alias(n) for n, how in outer.merges.items()])
    return done.select(KEY, TIME, *[outer.finish(f).alias(ids[f.name]) for f in features])


def _inner(es, child: Entity, rows, names, features, ids, window: _Window):
    """Aggregates over child rows of an aggregate over their own children, both up to the cutoff."""
    for grandchild, column in es.children(child.name):
        mine = [f for f in features if f.source.inner.entity == grandchild.name and _streams(es, child, f, window)]
        if mine:
            yield _streamed(es, rows, names, mine, ids, window, grandchild, column)
            features = [f for f in features if f not in mine]
    if not features:
        return
    pairs = window.pairs(rows)
    stacks: dict[str, list[Source]] = {}
    for s in dict.fromkeys(f.source for f in features):
        stacks.setdefault(s.inner.entity, []).append(s)
    owners = _Window(window.buckets, pairs.select(F.col("__row").alias(KEY), TIME), window.spec)
    for grandchild, column in es.children(child.name):
        sources = stacks.get(grandchild.name)
        if not sources:
            continue
        inner_ids = {s.inner.name: f"g{i}" for i, s in enumerate(sources)}
        side = pairs
        for part, on in _child_features(es, grandchild, column, [s.inner for s in sources], inner_ids, owners):
            side = side.join(part.withColumnRenamed(KEY, "__row"), ["__row", *on[1:]], "left")
        side = side.select(*pairs.columns, *[
            _filled(s.inner, inner_ids[s.inner.name]).alias(names[s]) for s in sources])
        mine = [f for f in features if f.source in sources]
        yield _paired(side, names, mine, ids, [KEY, TIME])


def feature_list(features: Sequence[Feature]) -> list[tuple[int, str]]:
    """(index, name) of every feature, as in the written feature statistics."""
    return list(enumerate(f.name for f in features))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Exact number of values per column; a column's values are spread over all tasks."""
    if not columns:
        return {}
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(columns)])))
    counted = dict(cells.where(F.col("v").isNotNull()).distinct().groupBy("c").count().collect())
    return {c: counted.get(i, 0) for i, c in enumerate(columns)}


def id_like_columns(
    matrix: DataFrame, keep: Sequence[str], share: float = 0.9, limit: int = 1000,
    kind: str = "string", approximate: bool = False,
) -> list[str]:
    """Columns with so many distinct values that they act as ids: more than min(rows × share, limit).

    ``kind`` integer uses the number of distinct ids (first entry of ``keep``) × share instead.
    """
    if kind == "string":
        wanted = (T.StringType,)
    elif kind == "integer":
        wanted = (T.IntegralType,)
    else:
        raise ValueError(f"unknown kind: {kind!r}")
    columns = [f.name for f in matrix.schema if isinstance(f.dataType, wanted) and f.name not in keep]
    if not columns:
        return []
    safe = matrix.select(F.col(f"`{keep[0]}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    base = F.count(F.lit(1)) if kind == "string" else F.count_distinct("id")
    if approximate:
        row = safe.agg(base.alias("base"), *[F.approx_count_distinct(f"c{i}").alias(f"c{i}") for i in range(len(columns))]).first()
        distinct = [row[f"c{i}"] for i in range(len(columns))]
    else:
        row = safe.agg(base.alias("base")).first()
        distinct = list(distinct_counts(safe, [f"c{i}" for i in range(len(columns))]).values())
    bound = min(row["base"] * share, limit) if kind == "string" else row["base"] * share
    return [c for c, n in zip(columns, distinct) if n > bound]


def drop_id_like(matrix: DataFrame, fitted: Sequence[str], hook: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Drop the fitted columns; ``hook`` may do more for one project."""
    out = matrix.drop(*fitted)
    return hook(out) if hook else out


def sql_name(name: str) -> str:
    """A feature name as a plain column name: ``SUM(orders.o_totalprice)`` → ``sum_orders_o_totalprice``."""
    return re.sub(r"\W+", "_", name).strip("_").lower()


def with_sql_names(matrix: DataFrame) -> DataFrame:
    plain = [sql_name(c) for c in matrix.columns]
    if len(set(plain)) < len(plain):
        plain = [f"{p}_{i}" if plain.count(p) > 1 else p for i, p in enumerate(plain)]
    return matrix.toDF(*plain)
