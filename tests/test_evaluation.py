import numpy as np
import pytest

from cutline.operators import evaluation as ev
from cutline.operators.ranking import exact_quantiles
from cutline.operators.training import with_label

Y = [1, 0, 1, 1, 0, 0, 1, 0, 0, 0]
P = [.9, .85, .8, .7, .6, .5, .4, .3, .2, .1]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(list(zip(range(10), Y, P)), "id int, y int, p double")


@pytest.fixture(scope="module")
def predicted(spark):
    return spark.createDataFrame(list(zip(range(5), [5, 3, 8, 1, 2], [9, 8, 7, 2, 1])), "id int, y int, p int")


def test_auc(spark, scored):
    assert ev.auc(scored, "y", "p").first().auc == pytest.approx(0.7916667, abs=1e-7)
    ties = spark.createDataFrame([(1, 1.0), (0, 1.0), (0, 0.0), (1, 1.0)], "y int, p double")
    assert ev.auc(ties, "y", "p").first().auc == pytest.approx(0.75)
    assert ev.auc(scored.where("y = 1"), "y", "p").first().auc is None


def test_threshold(scored):
    cut = exact_quantiles(scored, "p", {"q": 1 - 0.4}).first()["q"]
    assert cut == pytest.approx(0.64)
    assert with_label(scored.withColumnRenamed("p", "prediction"), threshold=cut).where("label = 1").count() == 4
    with pytest.raises(ValueError):
        with_label(scored)


def test_profit_report(scored):
    report = {round(r.decile, 1): (r.cul_total, r.cul_positive) for r in ev.profit_report_classifier(scored, "y", "p").collect()}
    assert (report[0.1], report[0.2], report[0.5], report[1.0]) == ((1, 1), (2, 1), (5, 3), (9, 4))
    first = ev.profit_report_classifier(scored, "y", "p").where("decile = 0.2").first()
    assert (first.precision, first.recall, first.lift) == (0.5, 0.25, pytest.approx(1.25))
    assert ev.profit_report_classifier(scored, "y", "p", pretty=True).where("decile = 0.2").first().precision == "50.00%"


def test_confusion_roc_gain(scored):
    cells = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(scored, "y", "p").collect()}
    assert cells == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    roc = {r.threshold: (r.fpr, r.tpr) for r in ev.roc_points(scored, "y", "p").collect()}
    assert roc[0.8] == (pytest.approx(1 / 6), 0.5) and roc[0.1] == (1.0, 1.0)
    gain = {(r["class"], round(r.percentage, 2)): r.gain for r in ev.cumulative_gain(scored, "y", "p", "id").collect()}
    assert len(gain) == 22 and gain[(1, 0.0)] == 0.0 and gain[(1, 0.4)] == 0.75 and gain[(0, 0.3)] == 0.5


def test_regression_reports(predicted):
    report = ev.profit_report_regression(predicted, "y", "p", "id").orderBy("decile").collect()
    assert [r.cul_sum for r in report] == [8, 8, 16, 16, 16, 17, 17, 19, 19, 19]
    assert [r.cul_num for r in report] == [2, 2, 3, 3, 3, 4, 4, 5, 5, 5]
    assert report[0].lift == pytest.approx(8 / 19 / 0.1)
    metrics = ev.regression_metrics(predicted, "y", "p").first()
    assert (metrics.r2, metrics.mae, metrics.mse) == (pytest.approx(-0.4285714, abs=1e-7), 2.4, 8.8)
    gains = ev.gain_regression(predicted, "y", "p", "id").orderBy("percentages").collect()
    want = np.percentile(np.array([0, 5, 8, 16, 17, 19]) / 19, np.linspace(0, 100, 11))
    assert [r.gains for r in gains] == [pytest.approx(w) for w in want]


def test_falling_running_truth(spark):
    """With negative values the running truth is no longer sorted by rank."""
    y = [5.0, -3.0, 4.0, -6.0, 2.0, 1.0]
    df = spark.createDataFrame([(i, v, float(10 - i)) for i, v in enumerate(y)], "id int, y double, p double")
    import pandas as pd
    cum = pd.Series(y).cumsum()
    want = cum.quantile([i / 10 for i in range(1, 11)], interpolation="higher")
    got = ev.profit_report_regression(df, "y", "p", "id").orderBy("decile").collect()
    assert [r.cul_sum for r in got] == list(want)
    assert [r.cul_num for r in got] == [(cum <= w).sum() for w in want]


def test_error_tables(spark, predicted):
    shares = {r.error: r.precision for r in ev.absolute_error_share(predicted, "y", "p", [1, 4]).collect()}
    assert shares == {1.0: 0.6, 4.0: 0.8}
    rates = ev.relative_error_share(predicted, "y", "p").collect()
    assert len(rates) == 21 and {round(r.error_rate, 1): r.precision for r in rates}[1.0] == 0.8
    zero = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (1.0, 1.0)], "y double, p double")
    assert ev.relative_error_share(zero, "y", "p", [2.0]).first().precision == pytest.approx(1 / 3)
    cdf = ev.error_cdf(spark.createDataFrame([(float(i),) for i in range(11)], "e double"), "e").collect()
    assert {r.percentile: r.error for r in cdf}[50.0] == 5.0 and len(cdf) == 101


def test_summary(spark, scored):
    rows = scored.selectExpr("*", "IF(id < 6, 'train', 'test') AS part")
    out = {(r.split, r.metric) for r in ev.evaluation_summary(rows, "part", "y", "p", "classifier").collect()}
    assert out == {("train", "auc"), ("test", "auc")}
    out = ev.evaluation_summary(rows, "part", "y", "p", "regression")
    assert {r.metric for r in out.collect()} == {"r2", "mae", "mse"}


def test_summary_of_many_groups(spark):
    """Thousands of splits in one pass, NULL among them, one with a third of all rows; equal to each on its own."""
    import random
    rng = random.Random(3)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"g{i % 997}", rng.randint(0, 1), rng.randint(0, 20) / 20, i) for i in range(9000)]
    frame = spark.createDataFrame(rows, "g string, y int, p double, id int")
    got = {r["split"]: r["value"] for r in ev.evaluation_summary(frame, "g", "y", "p", "classifier").collect()}
    assert set(got) == {r[0] for r in rows}
    for g in (None, "hot", "g1", "g500"):
        pos, neg = ([p for h, y, p, _ in rows if h == g and y == c] for c in (1, 0))
        pairs = [1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg]
        assert got[g] == (pytest.approx(sum(pairs) / len(pairs)) if pairs else None)
    both = ev.evaluation_summary(frame.withColumn("q", frame["id"] % 2), ["g", "q"], "y", "p", "regression")
    assert both.columns == ["g", "q", "metric", "value"] and both.where("metric = 'mae'").count() > 997
