import statistics
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cutline.functions.actions import exclude_values, filter_actions
from cutline.functions.calendar import Offset
from cutline.operators import skew, windows
from cutline.operators.labels import (
    LabelSpec, label_cutoffs, label_stats, make_labels, product_labels, wide_products, with_action_rows)
from helpers import moment, plan_of

CUT = datetime(2020, 1, 1)
EVENTS = [
    ("A", "2019-06-15", 10.0), ("B", "2019-06-15", 10.0), ("B", "2020-03-01", 5.0), ("C", "2019-06-15", 10.0),
    ("C", "2020-06-15", 7.0), ("D", "2019-12-31 23:00:00", 1.0), ("E", "2018-05-01", 1.0), ("F", "2020-01-01", 3.0),
    ("G", "2019-01-01", 2.0), ("H", "2019-06-15", 4.0), ("H", "2020-12-31 23:59:59", None), ("I", "2019-06-15", 4.0),
    ("I", "2021-01-01", 9.0), ("J", "2019-06-15", 4.0), ("J", "2020-01-15", 6.0)]
# fixed values: purchase, churn and value per key, for lead 0 and lead 1 month; churn for a 13 month window
LEAD_0 = {"A": (0, 1, 0), "B": (1, 0, 5), "C": (1, 1, 7), "D": (0, 1, 0), "G": (0, 1, 0), "H": (1, 1, 0), "I": (0, 1, 0), "J": (1, 0, 6)}
LEAD_1 = {"A": (0, 1, 0), "B": (1, 0, 5), "C": (1, 1, 7), "D": (0, 1, 0), "G": (0, 1, 0), "H": (1, 1, 0), "I": (1, 1, 9), "J": (0, 1, 0)}
CHURN_13 = {"A": 1, "B": 0, "C": 0, "D": 0, "G": 1, "H": 1, "I": 1, "J": 0}


@pytest.fixture(scope="module")
def events(spark):
    rows = [(k, moment(t), v) for k, t, v in EVENTS]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")


def spec_of(problem, lead=0, window=12, **params):
    if problem == "churn":
        params = {"churn_window": window, "churn_window_unit": "months"}
    return LabelSpec(problem, lead=Offset(lead), prediction=Offset(12), params=params)


def run(events, spec, form="bucketed"):
    rows = make_labels(events, "k", "t", spec, cutoffs=[CUT], form=form).collect()
    assert all(r["time"] == CUT for r in rows)
    return {r["k"]: r[-1] for r in rows}


@pytest.mark.parametrize("form", ["bucketed", "direct"])
@pytest.mark.parametrize("lead,expected", [(0, LEAD_0), (1, LEAD_1)])
def test_boundaries(events, form, lead, expected):
    value = {"value_column": "v", "value_agg": "sum"}
    for i, spec in enumerate([spec_of("purchase", lead), spec_of("churn", lead), spec_of("value", lead, **value)]):
        assert run(events, spec, form) == {k: v[i] for k, v in expected.items()}


def test_churn_window_past_prediction_end(events):
    assert run(events, spec_of("churn", window=13)) == CHURN_13


def test_value_aggregates(spark):
    values = [1.0, 2.0, 7.0, 9.5, None, 2.0]
    present = [v for v in values if v is not None]
    rows = [("a", CUT - timedelta(days=1), None)] + [("a", CUT + timedelta(days=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows + [("b", CUT - timedelta(days=2), 5.0)], "k string, t timestamp_ntz, v double")
    expected = {"sum": 21.5, "mean": 4.3, "count": 5, "min": 1.0, "max": 9.5, "median": 2.0, "nunique": 4.0,
                "std": statistics.stdev(present), "var": statistics.variance(present)}
    for how, want in expected.items():
        got = run(df, spec_of("value", value_column="v", value_agg=how))
        assert got["a"] == pytest.approx(want) and got["b"] == 0.0
    with pytest.raises(ValueError):
        run(df, spec_of("value", value_column="v", value_agg="kurtosis"))


def test_product_purchase(spark):
    rows = [(k, CUT + timedelta(days=d), p) for k, d, p in [
        ("A", -3, "Z"), ("A", 3, "X"), ("B", -3, "X"), ("B", 5, "Z")]]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, p string")
    spec = spec_of("product_purchase", product_column="p", product_list=["X", "Y", None])
    with pytest.warns(UserWarning):
        labels = make_labels(df, "k", "t", spec, cutoffs=[CUT])
    got = {(r["k"], r["product"]): r["product_purchase"] for r in labels.collect()}
    assert got == {("A", "X"): 1, ("A", "Y"): 0, ("B", "X"): 0, ("B", "Y"): 0}
    wide = wide_products(labels, "k", ["X", "Y"]).where("k = 'A'").first()
    assert (wide["product_purchase@X"], wide["product_purchase@Y"]) == (1, 0)
    assert product_labels(labels, "k", "X").columns == ["time", "k", "product_purchase"]


def test_many_products_use_several_masks(spark):
    names = [f"p{i}" for i in range(130)]
    rows = [("A", CUT - timedelta(days=1), "none")] + [("A", CUT + timedelta(days=1), f"p{i}") for i in (0, 61, 62, 129)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, p string")
    labels = make_labels(df, "k", "t", spec_of("product_purchase", product_column="p", product_list=names), cutoffs=[CUT])
    assert {r["product"] for r in labels.where("product_purchase = 1").collect()} == {"p0", "p61", "p62", "p129"}
    assert labels.count() == 130


def test_actions_and_action_rows(spark, events):
    spec = replace(spec_of("purchase"), actions=[{"column": "v", "operator": ">", "value": 5}])
    assert run(events, spec) == {**{k: 0 for k in LEAD_0}, "C": 1, "J": 1}
    both = with_action_rows(events.where("t < '2020-01-01'"), events.where("k = 'B'"))
    spec = replace(spec_of("purchase"), actions=[{"column": "is_action", "operator": "==", "value": 1}])
    assert run(both, spec) == {**{k: 0 for k in LEAD_0}, "B": 1}


def test_action_filter_and_exclusion(spark):
    df = spark.createDataFrame([(1,), (3,), (6,), (8,), (0,), (None,)], "t int")
    assert [r.t for r in filter_actions(df, [{"column": "t", "operator": "==", "value": 6}]).collect()] == [6]
    with pytest.raises(ValueError):
        filter_actions(df, [{"column": "t", "operator": "; drop", "value": 6}])
    with pytest.raises(ValueError):
        filter_actions(df, [{"column": "u", "operator": "==", "value": 6}])
    assert filter_actions(df, [{"column": "u", "operator": "==", "value": 6}], ignore_missing=True).count() == 6
    texts = spark.createDataFrame([(None,), ("a",), ("b",)], "c string")
    kept = exclude_values(texts, [{"column": "c", "values": ["a"]}]).collect()
    assert {r.c for r in kept} == {None, "b"}


def test_forms_agree_and_later_events_do_not_matter(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = LabelSpec("purchase", cutoff_num=5)
    cutoffs = label_cutoffs(orders, "o_orderdate", spec)
    base = make_labels(orders, "o_custkey", "o_orderdate", spec, cutoffs=cutoffs)
    direct = make_labels(orders, "o_custkey", "o_orderdate", spec, cutoffs=cutoffs, form="direct")
    assert base.exceptAll(direct).isEmpty() and direct.exceptAll(base).isEmpty()
    later = orders.withColumn("o_orderdate", F.col("o_orderdate") + Offset(20, "years").interval())
    more = make_labels(orders.unionByName(later).repartition(5), "o_custkey", "o_orderdate", spec, cutoffs=cutoffs)
    assert base.exceptAll(more).isEmpty() and more.exceptAll(base).isEmpty()


def test_hot_keys_take_the_other_way_with_the_same_result(spark, monkeypatch):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn(
        "k", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey") + 1))
    for how, column in (("median", "o_totalprice"), ("nunique", "o_orderpriority")):
        spec = LabelSpec("value", cutoff_num=3, prediction=Offset(12), params={"value_column": column, "value_agg": how})
        cold = make_labels(orders, "k", "o_orderdate", spec)
        monkeypatch.setattr(skew, "HOT_ROWS", 3)
        hot = make_labels(orders, "k", "o_orderdate", spec)
        assert sorted(cold.collect()) == sorted(hot.collect())
        monkeypatch.undo()


def test_plan_has_no_nested_loop_and_pushes_the_time_range(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(make_labels(orders, "o_custkey", "o_orderdate", LabelSpec("purchase")))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan and "BatchEvalPython" not in plan


def test_statistics(spark):
    rows = [(CUT, 1), (CUT, 0), (CUT, 0), (datetime(2020, 2, 1), 1)]
    labels = spark.createDataFrame(rows, "time timestamp_ntz, y int")
    stats = {r["time"]: (r.n, r.share_0, r.share_1) for r in label_stats(labels, "y").collect()}
    assert stats == {"2020-01-01": (3, pytest.approx(2 / 3), pytest.approx(1 / 3)), "2020-02-01": (1, 0.0, 1.0), "All": (4, 0.5, 0.5)}
    assert label_stats(labels, "y", pretty=True).where("time = 'All'").first().share_0 == "50.0000%"
    numbers = spark.createDataFrame([(CUT, 1.0), (CUT, 2.0), (CUT, 9.0), (datetime(2020, 2, 1), 4.0)], "time timestamp_ntz, y double")
    stats = {r["time"]: (r.n, r["mean"], r["median"]) for r in label_stats(numbers, "y", "regression").collect()}
    assert stats == {"2020-01-01": (3, 4.0, 2.0), "2020-02-01": (1, 4.0, 4.0), "All": (4, 4.0, 3.0)}


def test_empty_input_and_unknown_problem(spark, events):
    assert make_labels(events.limit(0), "k", "t", spec_of("purchase")).count() == 0
    nothing = events.withColumn("t", F.lit(None).cast("timestamp_ntz"))
    assert make_labels(nothing, "k", "t", spec_of("churn")).columns == ["k", "time", "churn"]
    with pytest.raises(ValueError):
        make_labels(events, "k", "t", LabelSpec("highvalue"))


def test_long_schedules_find_buckets_by_search(spark, monkeypatch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    spec = LabelSpec("purchase", sample=Offset(5, "days"), prediction=Offset(2, "days"), gap=Offset(1, "days"), cutoff_num=9)
    cutoffs = label_cutoffs(events, "ts", replace(spec, cutoff_day=25))
    tree = make_labels(events, "user_id", "ts", spec, cutoffs=cutoffs)
    monkeypatch.setattr(windows, "TREE_EDGES", 3)
    search = make_labels(events, "user_id", "ts", spec, cutoffs=cutoffs)
    assert tree.count() > 0 and sorted(tree.collect()) == sorted(search.collect())


def test_windows_of_a_microsecond(spark):
    assert windows.Buckets([windows.RoleWindow(CUT, "a", CUT, CUT + timedelta(microseconds=1))]).edges[-1].microsecond == 1
    with pytest.raises(ValueError):
        windows.Buckets([windows.RoleWindow(CUT, "a", CUT, CUT)])
