import statistics
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cutline.functions.calendar import Offset
from cutline.functions.primitives import AGGREGATES, Aggregate, primitive_name, register_aggregate
from cutline.operators import features, skew
from cutline.operators.entities import Entity, EntitySet, Parent, auto_interesting
from cutline.operators.features import (
    drop_id_like, feature_list, id_like_columns, make_features, sql_name, with_sql_names)
from cutline.plans.feature_plan import FeatureSpec, plan_features
from helpers import plan_of

CUT = datetime(2020, 1, 1)
ALL = [a for a in AGGREGATES if AGGREGATES[a].route != "pairs"]


def customers(spark, keys):
    return Entity("customer", spark.createDataFrame([(k, f"seg{k % 2}") for k in keys], "ck long, segment string"), key="ck")


def orders(spark, rows):
    """rows: (order key, customer, time, x, flag, word)"""
    df = spark.createDataFrame(rows, "ok long, ck long, t timestamp_ntz, x double, flag boolean, word string")
    return Entity("orders", df, key="ok", time="t", parents=[Parent("customer", "ck")])


def before(days):
    return CUT - timedelta(days=days)


def instances(spark, keys, times=(CUT,)):
    return spark.createDataFrame([(k, t) for k in keys for t in times], "ck long, time timestamp_ntz")


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, 1, before(40), 1.0, True, "b"), (2, 1, before(30), 2.0, False, "a"), (3, 1, before(20), 7.0, None, "b"),
            (4, 1, before(10), 9.5, True, "a"), (5, 1, before(5), None, True, None), (6, 2, before(3), 4.0, False, "c"),
            (7, 2, CUT, 100.0, True, "z"), (8, 1, before(900), 55.0, True, "old")]
    return EntitySet([customers(spark, [1, 2, 3]), orders(spark, rows)])


def rows_of(df):
    return {(r["ck"], r["time"]): r.asDict() for r in df.collect()}


def test_every_aggregate(spark, small):
    spec = FeatureSpec("customer", aggregates=[*ALL, "month_of_cutoff_point"], transforms=[])
    got = rows_of(make_features(small, spec, instances(spark, [1, 2, 3]), [CUT]))
    one, three = got[(1, CUT)], got[(3, CUT)]
    x = [1.0, 2.0, 7.0, 9.5]
    want = {
        "COUNT(orders)": 5, "SUM(orders.x)": 19.5, "MEAN(orders.x)": 4.875, "MAX(orders.x)": 9.5, "MIN(orders.x)": 1.0,
        "MEDIAN(orders.x)": 4.5, "STD(orders.x)": statistics.stdev(x), "SKEW(orders.x)": 0.2668903296503254,
        "FIRST(orders.x)": 1.0, "LAST(orders.x)": None, "LAST(orders.word)": None, "MODE(orders.word)": "a",
        "N_MOST_COMMON(orders.word)": ["a", "b"], "NUM_UNIQUE(orders.word)": 2, "ENTROPY(orders.word)": np.log(2),
        "NUM_TRUE(orders.flag)": 3, "PERCENT_TRUE(orders.flag)": 0.6, "ALL(orders.flag)": False, "ANY(orders.flag)": True,
        "AVG_TIME_BETWEEN(orders.t)": 35 / 4 * 86400, "TIME_SINCE_FIRST(orders.t)": 40 * 86400.0,
        "TIME_SINCE_LAST(orders.t)": 5 * 86400.0, "DAYS_SINCE_LAST(orders.t)": 5,
        "TREND(orders.x)": np.polyfit([-40, -30, -20, -10], x, 1)[0], "MONTH_OF_CUTOFF_POINT": 1, "segment": "seg1"}
    for name, value in want.items():
        assert one[name] == (pytest.approx(value) if isinstance(value, float) else value), name
    empty = {"COUNT(orders)": 0, "SUM(orders.x)": 0.0, "MEAN(orders.x)": None, "NUM_UNIQUE(orders.word)": 0, "MODE(orders.word)": None,
             "PERCENT_TRUE(orders.flag)": 0.0, "NUM_TRUE(orders.flag)": 0, "ALL(orders.flag)": None, "MEDIAN(orders.x)": None}
    assert {n: three[n] for n in empty} == empty
    assert got[(2, CUT)]["COUNT(orders)"] == 1 and got[(2, CUT)]["STD(orders.x)"] is None


def test_cutoff_boundary(spark, small):
    for include, n in ((False, 1), (True, 2)):
        spec = FeatureSpec("customer", aggregates=["count"], transforms=[], only=["COUNT(orders)"], include_cutoff=include)
        got = rows_of(make_features(small, spec, instances(spark, [2]), [CUT]))
        assert got[(2, CUT)]["COUNT(orders)"] == n


def test_no_leak_and_large_offsets_keep_their_spread(spark):
    rows = [(i, 1, before(400 - i), 1e9 + i % 3, True, "w") for i in range(100)]
    later = [(1000 + i, 1, CUT + timedelta(days=i), 5.0, False, "v") for i in range(50)]
    spec = FeatureSpec("customer", aggregates=["std", "mean", "mode", "median", "last", "trend"], transforms=["diff"])
    inst = instances(spark, [1])
    base = rows_of(make_features(EntitySet([customers(spark, [1]), orders(spark, rows)]), spec, inst, [CUT]))
    more = rows_of(make_features(EntitySet([customers(spark, [1]), orders(spark, rows + later)]), spec, inst, [CUT]))
    assert base == more
    assert base[(1, CUT)]["STD(orders.x)"] == pytest.approx(statistics.stdev(i % 3 for i in range(100)), rel=1e-8)


@pytest.fixture(scope="module")
def busy(spark):
    """One customer holds a third of the rows."""
    rng = np.random.default_rng(7)
    n = 600
    rows = [(i, 0 if rng.random() < 0.34 else int(rng.integers(1, 20)), before(int(rng.integers(1, 500))),
             float(rng.integers(0, 40)), bool(rng.random() < 0.5), "abc"[rng.integers(0, 3)]) for i in range(n)]
    return EntitySet([customers(spark, range(20)), orders(spark, rows)])


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for c in a[k]:
            assert a[k][c] == (pytest.approx(b[k][c]) if isinstance(b[k][c], float) else b[k][c]), (k, c)


def test_all_ways_give_one_result(spark, busy, monkeypatch):
    times = [CUT, before(31), before(62)]
    inst = instances(spark, range(20), times)
    spec = FeatureSpec("customer", aggregates=ALL, transforms=["month", "time_since"], training_window=Offset(200, "days"))
    base = rows_of(make_features(busy, spec, inst, times))
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    same(rows_of(make_features(busy, spec, inst, times)), base)
    monkeypatch.undo()
    monkeypatch.setattr(features, "MAX_TIMES", 2)
    same(rows_of(make_features(busy, spec, inst)), base)


def test_agrees_with_pandas(spark, busy):
    spec = FeatureSpec("customer", aggregates=["std", "skew", "median"], transforms=["diff"], training_window=Offset(200, "days"))
    got = rows_of(make_features(busy, spec, instances(spark, range(20)), [CUT]))
    pdf = busy["orders"].df.toPandas().sort_values(["t", "ok"])
    pdf["d"] = pdf.groupby("ck")["x"].diff()
    pdf = pdf[pdf["t"] >= pd.Timestamp(before(200))]
    for k, g in pdf.groupby("ck"):
        row = got[(k, CUT)]
        assert row["MEDIAN(orders.x)"] == pytest.approx(g["x"].median())
        assert row["SKEW(orders.x)"] == pytest.approx(g["x"].skew())
        assert row["STD(orders.DIFF(x))"] == pytest.approx(g["d"].std())


def test_where_parent_and_stacked_features(spark):
    orders_e = orders(spark, [(1, 1, before(9), 1.0, True, "a"), (2, 1, before(8), 2.0, True, "b"), (3, 1, before(7), 3.0, True, "a")])
    lines = spark.createDataFrame([(1, "p", 4.0, before(9)), (1, "q", 6.0, before(8)), (2, "p", 1.0, before(8)),
                                   (3, "q", 9.0, CUT + timedelta(days=1))], "ok long, pk string, n double, at timestamp_ntz")
    parts = spark.createDataFrame([("p", "PROMO"), ("q", "OTHER")], "pk string, kind string")
    es = EntitySet([customers(spark, [1]), orders_e, Entity("parts", parts, key="pk"),
                    Entity("lines", lines, time="at", parents=[Parent("orders", "ok"), Parent("parts", "pk")])])
    es = es.with_interesting({"orders": {"word": ["a"]}})
    spec = FeatureSpec("customer", aggregates=["count", "sum", "mean", "max", "median"], transforms=[], where=["count", "sum"])
    row = rows_of(make_features(es, spec, instances(spark, [1]), [CUT]))[(1, CUT)]
    assert row["COUNT(orders WHERE word = a)"] == 2 and row["SUM(orders.x WHERE word = a)"] == 4.0
    assert row["MEAN(orders.SUM(lines.n))"] == pytest.approx(11 / 3)  # the late line does not count
    assert row["MAX(orders.COUNT(lines))"] == 2 and row["MEDIAN(orders.SUM(lines.n))"] == 1.0


@pytest.mark.parametrize("include", [False, True])
def test_state_as_of_any_number_of_cutoffs(spark, monkeypatch, include):
    """One key holds a third of all rows, times tie with cutoffs, keys without rows, a cutoff for nearly every instance."""
    rng = np.random.default_rng(3)
    rows = [(i, 0 if i % 3 == 0 else int(rng.integers(1, 30)), before(int(rng.integers(-3, 90))), None if i % 11 == 0 else float(rng.integers(0, 40)), bool(i % 2), "ab"[i % 2]) for i in range(600)]
    rows += [(1000, 4, None, 1.0, True, "a")]
    es = EntitySet([customers(spark, range(33)), orders(spark, rows)])
    inst = instances(spark, range(33), [before(d) for d in (0, 1, 5, 30, 89, 200)])
    spec = FeatureSpec("customer", aggregates=ALL, transforms=["month", "time_since"], include_cutoff=include)
    base = rows_of(make_features(es, spec, inst, [before(d) for d in (0, 1, 5, 30, 89, 200)]))
    monkeypatch.setattr(features, "MAX_TIMES", 2)
    same(rows_of(make_features(es, spec, inst)), base)


def test_state_as_of_makes_no_pairs(spark, busy):
    spec = FeatureSpec("customer", aggregates=["sum", "max", "last"], transforms=[])
    planned = [f for f in plan_features(busy, spec) if f.how == "aggregate"]
    rows, names = features._prepare(busy, busy["orders"], "ck", [f.source for f in planned])
    inst = instances(spark, range(20), [CUT, before(3)]).select(F.col("ck").alias("__key"), F.col("time").alias("__time"))
    window = features._Window(None, inst, spec)
    plan = plan_of(features._as_of(rows, names, planned, {f.name: f"f{i}" for i, f in enumerate(planned)}, window))
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Join") == 1 and "hashpartitioning(__key#" in physical  # the one of a range with the state before it


def stacked(spark):
    rng = np.random.default_rng(7)
    o = [(i, int(rng.integers(0, 6)), before(int(rng.integers(-5, 120))), float(rng.integers(0, 50)), bool(i % 2), "ab"[i % 2]) for i in range(80)]
    lines = [(int(rng.integers(0, 80)), float(rng.integers(0, 9)), "pq"[int(rng.integers(0, 2))], before(int(rng.integers(-10, 130)))) for _ in range(300)]
    lines += [(3, 1.0, "p", None), (None, 1.0, "p", CUT), (4, None, "q", before(50))]
    below = Entity("lines", spark.createDataFrame([(i, *r) for i, r in enumerate(lines)], "lk long, ok long, n double, kind string, at timestamp_ntz"),
                   key="lk", time="at", parents=[Parent("orders", "ok")])
    return EntitySet([customers(spark, range(7)), orders(spark, o), below]).with_interesting({"orders": {"word": ["a"]}, "lines": {"kind": ["p"]}})


@pytest.mark.parametrize("include", [False, True])
def test_changes_give_what_all_pairs_give(spark, monkeypatch, include):
    es = stacked(spark)
    times = [before(d) for d in (0, 20, 21, 60, 119, 300)]
    spec = FeatureSpec("customer", aggregates=["count", "sum", "mean", "max", "min", "first", "last", "std", "skew", "trend", "median", "time_since_last"],
                       transforms=[], where=["count", "sum"], include_cutoff=include)
    deep = [f for f in plan_features(es, spec) if f.source is not None and f.source.how == "inner"]
    assert len(deep) > 20
    inst = instances(spark, range(7), times)
    got = rows_of(make_features(es, spec, inst, times, deep))
    monkeypatch.setattr(features, "_streams", lambda *a: False)
    same(got, rows_of(make_features(es, spec, inst, times, deep)))


def test_changes_move_before_they_meet_the_cutoffs(spark):
    es = stacked(spark)
    times = [before(d) for d in range(0, 200, 10)]
    deep = [f for f in plan_features(es, FeatureSpec("customer", aggregates=["mean", "sum"], transforms=[])) if f.name == "MEAN(orders.SUM(lines.n))"]
    window = features._Window(features.past_windows(times, FeatureSpec("customer")), None, FeatureSpec("customer"))
    rows, names = features._prepare(es, es["orders"], "ck", [f.source for f in deep])
    plan = plan_of(features._streamed(es, rows, names, deep, {f.name: "f0" for f in deep}, window, es["lines"], "ok"))
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.index("Generate explode") < physical.index("Exchange")  # nothing moves once the cutoffs are in


def test_child_without_time(spark):
    phones = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x")], "ck long, brand string")
    es = EntitySet([customers(spark, [1, 2]), Entity("phones", phones, parents=[Parent("customer", "ck")])])
    spec = FeatureSpec("customer", aggregates=["count", "mode", "num_unique", "last"], transforms=["diff"])
    got = rows_of(make_features(es, spec, instances(spark, [1, 2]), [CUT]))
    assert got[(1, CUT)]["MODE(phones.brand)"] == "x" and got[(2, CUT)]["COUNT(phones)"] == 0
    assert "LAST(phones.brand)" not in got[(1, CUT)]


def test_plan_rules(small):
    spec = FeatureSpec("customer")
    names = [f.name for f in plan_features(small, spec)]
    assert names == sorted(names) and "LAST(orders.MONTH(t))" in names and "MEAN(orders.DIFF(x))" in names
    assert not any("ok" in n.split("(") or "ck" == n for n in names)
    assert feature_list(plan_features(small, FeatureSpec("customer", max_features=2))) == [(0, names[0]), (1, names[1])]
    assert "segment" not in [f.name for f in plan_features(small, FeatureSpec("customer", drop_exact=["segment"]))]
    no_x = [f.name for f in plan_features(small, FeatureSpec("customer", drop_contains=["x"]))]
    assert "MAX(orders.x)" not in no_x and any("MAX" not in n for n in no_x)
    assert not any("orders" in n for n in [f.name for f in plan_features(small, FeatureSpec("customer", ignore_entities=["orders"]))])
    ignored = plan_features(small, FeatureSpec("customer", ignore_columns={"orders": ["word"]}))
    assert not any("word" in f.name for f in ignored)
    for bad in ({"aggregates": ["Magic"]}, {"transforms": ["Magic"]}, {"only": ["COUNT(nothing)"]}):
        with pytest.raises(ValueError):
            plan_features(small, FeatureSpec("customer", **bad))
    with pytest.raises(ValueError):
        FeatureSpec("customer", training_window=Offset(3, "hours"))
    assert primitive_name("NMostCommon") == "n_most_common" and primitive_name("TimeSinceLast") == "time_since_last"


def test_auto_interesting_values(small):
    es = auto_interesting(small, 2)
    assert es["orders"].interesting["word"] == ["a", "b"]


def test_user_aggregate(spark, small):
    register_aggregate(Aggregate("spread_test", "numeric", route="pairs", expr=lambda x, t, time: F.max(x) - F.min(x)))
    try:
        spec = FeatureSpec("customer", aggregates=["spread_test"], transforms=[], only=["SPREAD_TEST(orders.x)"])
        assert rows_of(make_features(small, spec, instances(spark, [1]), [CUT]))[(1, CUT)]["SPREAD_TEST(orders.x)"] == 8.5
    finally:
        AGGREGATES.pop("spread_test")
    with pytest.raises(ValueError):
        register_aggregate(Aggregate("bad", "numeric", route="values"))


def test_id_like_columns(spark):
    df = spark.range(50).selectExpr("id AS ck", "concat('n', id) AS name", "concat('g', id % 3) AS grp", "id AS code", "id % 2 AS bit")
    assert id_like_columns(df, ["ck"]) == ["name"] and id_like_columns(df, ["ck"], approximate=True) == ["name"]
    assert id_like_columns(df, ["ck"], kind="integer") == ["code"]
    assert drop_id_like(df, ["name"], hook=lambda d: d.drop("bit")).columns == ["ck", "grp", "code"]


def test_plain_names(small, spark):
    assert sql_name("SUM(orders.o_totalprice)") == "sum_orders_o_totalprice"
    df = spark.range(1).selectExpr("id AS `A(b)`", "id AS `A.b`")
    assert len(set(with_sql_names(df).columns)) == 2


def test_native_plan(spark, small):
    spec = FeatureSpec("customer", transforms=["month"])
    plan = plan_of(make_features(small, spec, instances(spark, [1, 2]), [CUT]))
    for word in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert word not in plan


VALUES = ["mode", "num_unique", "entropy", "n_most_common"]


def test_values_are_counted_without_a_row_per_cutoff(spark, busy):
    """Memory of a task must not grow with the cutoffs, so no aggregation of values is keyed by them."""
    times = [before(31 * i) for i in range(12)]
    spec = FeatureSpec("customer", aggregates=["mode", "num_unique"], transforms=["month"], training_window=Offset(200, "days"))
    planned = [f for f in plan_features(busy, spec) if f.how == "aggregate"]
    rows, names = features._prepare(busy, busy["orders"], "ck", [f.source for f in planned])
    window = features._Window(features.past_windows(times, spec), instances(spark, range(20), times), spec)
    plan = plan_of(features._by_value(rows, names, planned, {f.name: f"f{i}" for i, f in enumerate(planned)}, window, ["__key", "__time"]))
    keys = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "Aggregate(key" in line]
    assert keys and not any("__time" in line.split("functions=")[0] for line in keys)


def test_values_at_many_cutoffs_agree_with_pandas(spark, busy, monkeypatch):
    """Sliding windows in parts of a few cutoffs, and frequent keys apart."""
    times = [before(31 * i) for i in range(12)]
    spec = FeatureSpec("customer", aggregates=VALUES, transforms=[], training_window=Offset(100, "days"))
    inst = instances(spark, range(20), times)
    base = rows_of(make_features(busy, spec, inst, times))
    pdf = busy["orders"].df.toPandas()
    for (key, t), row in base.items():
        words = pdf[(pdf["ck"] == key) & (pdf["t"] < t) & (pdf["t"] >= t - timedelta(days=100))]["word"]
        sizes = words.value_counts()
        best = sorted(sizes.index, key=lambda w: (-sizes[w], w))
        share = sizes / len(words)
        assert row["NUM_UNIQUE(orders.word)"] == len(sizes) and row["MODE(orders.word)"] == (best[0] if best else None)
        assert (row["N_MOST_COMMON(orders.word)"] or []) == best[:3]
        assert row["ENTROPY(orders.word)"] == (pytest.approx(-(share * np.log(share)).sum(), abs=1e-9) if best else None)
    for name, value in ((features, 12), (skew, 20)):
        monkeypatch.setattr(name, "EXPRESSIONS_PER_PASS" if name is features else "HOT_ROWS", value)
        same(rows_of(make_features(busy, spec, inst, times)), base)


def test_merged_features_have_no_row_per_cutoff_before_the_end(spark, busy, monkeypatch):
    times = [before(31 * i) for i in range(12)]
    spec = FeatureSpec("customer", aggregates=["sum", "std", "last"], transforms=[], training_window=Offset(200, "days"))
    planned = [f for f in plan_features(busy, spec) if f.how == "aggregate"]
    rows, names = features._prepare(busy, busy["orders"], "ck", [f.source for f in planned])
    inst = instances(spark, range(20), times)
    window = features._Window(features.past_windows(times, spec), inst, spec)
    plan = plan_of(features._merged(rows, names, planned, {f.name: f"f{i}" for i, f in enumerate(planned)}, window, ["__key", "__time"]))
    keys = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "Aggregate(key" in line]
    assert keys and not any("__time" in line.split("functions=")[0] for line in keys)
    base = rows_of(make_features(busy, spec, inst, times))
    monkeypatch.setattr(features, "EXPRESSIONS_PER_PASS", 12)
    same(rows_of(make_features(busy, spec, inst, times)), base)
