import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cutline.functions.standardize import forward_fill
from cutline.operators import skew
from cutline.operators.ranking import (
    exact_quantiles, percentile_rank, previous_row, quantile_rows, running_totals, with_deciles, with_rank)
from helpers import plan_of


def scores(n, seed=3):
    """A third of all rows share one score."""
    rng = np.random.default_rng(seed)
    s = np.round(rng.normal(size=n) * 50, 1)
    s[rng.random(n) < 0.34] = 7.0
    return pd.DataFrame({"id": rng.permutation(n), "s": s, "w": rng.integers(0, 5, n)})


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_and_totals_with_one_heavy_score(spark, descending, text_ids):
    pdf = scores(4000)
    if text_ids:
        pdf["id"] = "x" + pdf["id"].astype(str)
    df = spark.createDataFrame(pdf).repartition(7)
    got = running_totals(df, "s", {"rank": F.lit(1).cast("bigint"), "sum_w": F.col("w")}, "id", descending, slots=16).toPandas()
    assert sorted(got["rank"]) == list(range(1, 4001)) and set(got["rank_total"]) == {4000}
    got = got.sort_values("rank")
    ordered = got["s"].to_numpy()
    assert (np.diff(ordered) <= 0).all() if descending else (np.diff(ordered) >= 0).all()
    assert (got["w"].cumsum() == got["sum_w"]).all()
    if not text_ids:
        want = pdf.sort_values(["s", "id"], ascending=[not descending, True])
        assert list(want["id"]) == list(got["id"])


def test_heavy_score_is_spread_over_several_windows(spark):
    df = spark.createDataFrame(scores(4000))
    ranked = with_rank(df, "s", "id", slots=16)
    assert "SinglePartition" in plan_of(ranked)  # only the slot counts, which are bounded
    from cutline.operators.ranking import SLOT, TIE_SLOT, Slots
    sizes = Slots.of(df, "s", "id", 16).assign(df).groupBy(SLOT, TIE_SLOT).count().toPandas()["count"]
    assert sizes.max() < 4000 * 0.1


def test_deciles(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 16)], "id int, s double")
    got = [r.decile for r in with_deciles(df, "s", "id").orderBy("id").collect()]
    bins = [1, 1, 2, 3, 3, 4, 5, 5, 6, 7, 8, 8, 9, 10, 10]
    assert got == [pytest.approx((11 - b) / 10) for b in bins]
    for n in (1, 10, 101):
        df = spark.range(n).select("id", F.col("id").cast("double").alias("s"))
        got = [r.decile for r in with_deciles(df, "s", "id").orderBy("id").collect()]
        if n >= 10:
            want = pd.qcut(pd.Series(range(n)).rank(method="first"), 10, labels=False)
            assert got == [pytest.approx((10 - b) / 10) for b in want]


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles(spark, n):
    pdf = scores(n)
    probs = {f"p{i}": i / 10 for i in range(11)}
    row = exact_quantiles(spark.createDataFrame(pdf), "s", probs, slots=16).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(pdf["s"], p))
    row = exact_quantiles(spark.createDataFrame(pdf), "s", probs, method="higher", slots=16).first()
    for name, p in probs.items():
        want = pdf["s"].quantile(p, interpolation="higher")
        assert row[name] == want and row[f"{name}_upto"] == (pdf["s"] <= want).sum()


def test_grouped_and_weighted_quantiles(spark):
    pdf = scores(2000).assign(g=lambda d: np.where(d["id"] % 3 == 0, 0, d["id"] % 50))
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, "s", {"m": 0.5}, ["g"], slots=16).toPandas().set_index("g")["m"]
    pd.testing.assert_series_equal(got.sort_index(), pdf.groupby("g")["s"].median(), check_names=False, check_index_type=False)
    counts = df.groupBy("g", "s").count()
    again = exact_quantiles(counts, "s", {"m": 0.5}, ["g"], weight="count", slots=16).toPandas().set_index("g")["m"]
    pd.testing.assert_series_equal(got.sort_index(), again.sort_index())
    assert quantile_rows(df.limit(0), "s", [0.5]).count() == 0
    assert exact_quantiles(df.limit(0), "s", {"m": 0.5}).first()["m"] is None


def test_percentile_rank(spark):
    df = spark.createDataFrame([(5,), (5,), (7,), (9,), (None,)], "x int")
    got = sorted((r.x is None, r.x, r.p) for r in percentile_rank(df, "x", "p").collect() if r.x is not None)
    assert [p for _, _, p in got] == [0.375, 0.375, 0.75, 1.0]


@pytest.mark.parametrize("hot", [10, 10**6])
def test_previous_row_across_slots(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.where(rng.random(3000) < 0.4, 0, rng.integers(1, 200, 3000)),
                        "t": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 900, 3000), unit="h"),
                        "id": np.arange(3000), "x": rng.normal(size=3000)})
    df = spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = previous_row(df, "k", "t", ["id"], {"before": "x"}, slots=16).toPandas().set_index("id")["before"].sort_index()
    want = pdf.sort_values(["t", "id"]).assign(b=lambda d: d.groupby("k")["x"].shift()).set_index("id")["b"].sort_index()
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float))


def test_forward_fill_across_slots(spark):
    rows = [(i, "v%d" % i if i % 37 == 5 else None) for i in range(500)]
    got = forward_fill(spark.createDataFrame(rows, "i int, c string"), "i", ["c"]).orderBy("i").collect()
    last = None
    for (i, c), r in zip(rows, got):
        last = c or last
        assert r.c == last


def test_nan_sorts_last(spark):
    df = spark.createDataFrame([(1, 2.0), (2, math.nan), (3, 1.0)], "id int, s double")
    assert [r.id for r in with_rank(df, "s", "id").orderBy("rank").collect()] == [3, 1, 2]
