"""Nothing is cut by size: rounds, cutoffs, text columns, ties, hot keys, and what the flows write."""

from dataclasses import replace
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.functions.calendar import Offset
from cutline.functions.primitives import PARTIALS, Aggregate, register_aggregate, register_partial
from cutline.operators import ranking, skew, windows
from cutline.operators import training as tr
from cutline.operators.entities import Entity, EntitySet, Parent
from cutline.operators.evaluation import auc, cumulative_gain
from cutline.operators.features import make_features
from cutline.operators.labels import LABELS, LabelSpec, make_labels, register_label
from cutline.operators.ranking import exact_quantiles, previous_row, running_totals
from cutline.plans.comment_flow import comment_job
from cutline.plans.feature_plan import FeatureSpec
from cutline.plans.flows import predict_flow, train_flow
from cutline.plans.queries import small_model_config, tables
from cutline.sources.sinks import column_types, write_sorted
from helpers import plan_of

FOLDER = "/root/testdata/sf0.001"


def signal(spark, n=900):
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    return spark.range(n).select(
        "id", F.lit(datetime(2020, 1, 1)).alias("time"), h.alias("x"), (h > 0.7).cast("int").alias("y"),
        F.concat(F.lit("v"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(300))).alias("code"))


def test_default_rates_keep_their_rounds(spark):
    spec = tr.TrainSpec("y", rounds=12)
    assert spec.rate == 0.01
    model = tr.fit(signal(spark), spec)
    assert model.facts["rounds"] > 1 and model.pipeline.stages[-1].getNumTrees == model.facts["rounds"]


def test_the_best_prefix_of_the_rounds_is_kept(spark, monkeypatch):
    noisy = signal(spark, 300).withColumn("y", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2)).cast("int"))
    spec = tr.TrainSpec("y", rounds=8, rate=0.8, depth=4)
    kept = tr.fit(noisy, spec).facts["rounds"]
    monkeypatch.setattr(tr, "best_rounds", lambda booster, test, kind: 3)
    assert kept <= 8 and tr.fit(noisy, spec).facts["rounds"] == 3


def test_text_with_many_values_stays_in_the_model(spark, monkeypatch):
    monkeypatch.setattr(tr, "MAX_CATEGORIES", 100)
    base = signal(spark, 3000).drop("x").withColumn("noise", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)).cast("double"))
    matrix = base.withColumn("y", (F.pmod(F.xxhash64("code"), F.lit(10)) < 4).cast("int"))
    model = tr.fit(matrix, tr.TrainSpec("y", rounds=4, depth=3, rate=0.3))
    assert model.facts["hashed"] == ["code"]
    scored = tr.raw_scores(model, matrix).join(matrix.select("id", "y"), "id")
    assert auc(scored, "y", "prediction").first().auc > 0.85
    names = [r.feature_name for r in tr.feature_importance(model, spark).collect()]
    assert names[0] == "code" and set(names) == {"code", "noise"}


@pytest.mark.parametrize("place", ["first", "middle", "last"])
def test_null_cutoffs_lose_no_others(spark, place):
    days = [datetime(2020, 1, 1) + pd.Timedelta(days=i) for i in range(1200)]
    at = {"first": 0, "middle": 600, "last": 1200}[place]
    rows = [(1, d) for d in days]
    rows.insert(at, (1, None))
    es = EntitySet([Entity("c", spark.createDataFrame([(1,)], "k long"), key="k"),
                    Entity("e", spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)], "i long, k long, t timestamp_ntz"),
                           key="i", time="t", parents=[Parent("c", "k")])])
    spec = FeatureSpec("c", aggregates=["count"], transforms=[], only=["COUNT(e)"], training_window=None)
    got = make_features(es, spec, spark.createDataFrame(rows, "k long, time timestamp_ntz").coalesce(1)).collect()
    assert len(got) == 1201 and sum(r["COUNT(e)"] for r in got) == sum(range(1200))


def test_ties_make_a_total_order(spark):
    rows = spark.range(400).select(F.pmod("id", F.lit(40)).alias("k"), F.floor(F.col("id") / 40).alias("time"), F.pmod("id", F.lit(3)).alias("p"), F.pmod("id", F.lit(2)).alias("y"))
    one = cumulative_gain(rows, "y", "p", ["k", "time"]).collect()
    other = cumulative_gain(rows.repartition(5, "y"), "y", "p", ["k", "time"]).collect()
    assert sorted(one) == sorted(other)
    ranked = running_totals(rows, "p", {"rank": F.lit(1)}, ["k", "time"]).toPandas().sort_values("rank")
    assert ranked[["p", "k", "time"]].to_numpy().tolist() == sorted(ranked[["p", "k", "time"]].to_numpy().tolist())


@pytest.mark.parametrize("hot", [50, 10**6])
def test_previous_row_with_null_keys_and_equal_times(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    n = 3000
    pdf = pd.DataFrame({"k": np.where(np.arange(n) % 3 == 0, 0, np.arange(n) % 70), "id": np.random.default_rng(1).permutation(n)})
    pdf["t"] = pd.Timestamp("2020-01-01")
    pdf["x"] = pdf["id"] * 1.5
    df = spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz"))
    odd = df.limit(40).select(F.lit(None).cast("long").alias("k"), (F.col("id") + 10_000).alias("id"), "t", "x").unionByName(
        df.limit(5).select("k", (F.col("id") + 20_000).alias("id"), F.lit(None).cast("timestamp_ntz").alias("t"), "x"))
    got = previous_row(df.unionByName(odd), "k", "t", ["id"], {"before": "x"}, slots=16).toPandas().set_index("id")["before"].sort_index()
    want = pdf.sort_values("id").assign(b=lambda d: d.groupby("k")["x"].shift()).set_index("id")["b"].sort_index()
    np.testing.assert_allclose(got.loc[:9_999].to_numpy(float), want.to_numpy(float))
    assert got.loc[10_000:].isna().all() and len(got) == n + 45


def test_equal_times_of_a_hot_key_are_spread(spark):
    df = spark.range(4000).select(F.lit(1.0).alias("s"), "id")
    sizes = ranking.Slots.of(df, "s", "id", 16).assign(df).groupBy(ranking.SLOT, ranking.TIE_SLOT).count().toPandas()["count"]
    assert sizes.max() < 1000


def test_a_shared_value_is_reduced_before_the_grouped_join(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id") * 1.0).alias("v"))
    found = ranking.quantile_rows(df, "v", [0.5], ["g"])
    assert {r.quantile for r in found.collect()} == {0.0}
    text = plan_of(found)
    joined = text[text.index("== Optimized Logical Plan"):]
    join_at = joined.index("Join Inner")
    assert "Aggregate [g" in joined[join_at:joined.index("== Physical Plan")]


def test_many_cutoffs_join_on_more_than_the_bucket(spark, monkeypatch):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    spec = LabelSpec("purchase", cutoff_num=6)
    want = make_labels(orders, "o_custkey", "o_orderdate", spec).collect()
    monkeypatch.setattr(windows, "BROADCAST_ROWS", 0)
    salted = make_labels(orders, "o_custkey", "o_orderdate", spec)
    assert sorted(salted.collect()) == sorted(want)
    assert windows.SALT in plan_of(salted)


def test_time_since_is_merged_and_not_paired(spark):
    days = [datetime(2020, 1, 1) + pd.Timedelta(days=3 * i, hours=i) for i in range(40)]
    es = EntitySet([Entity("c", spark.createDataFrame([(1,), (2,)], "k long"), key="k"),
                    Entity("e", spark.createDataFrame([(i, 1 + i % 2, d) for i, d in enumerate(days)], "i long, k long, t timestamp_ntz"),
                           key="i", time="t", parents=[Parent("c", "k")])])
    names = [f"{p}(e.TIME_SINCE(t))" for p in ("MEAN", "MAX", "MIN", "SUM")]
    spec = FeatureSpec("c", aggregates=["mean", "max", "min", "sum"], transforms=["time_since"], only=names, training_window=Offset(2))
    cutoffs = [datetime(2020, 2, 1), datetime(2020, 4, 1)]
    rows = spark.createDataFrame([(k, c) for k in (1, 2) for c in cutoffs], "k long, time timestamp_ntz")
    for r in make_features(es, spec, rows, cutoffs).collect():
        ages = [(r.time - d).total_seconds() for i, d in enumerate(days) if 1 + i % 2 == r.k and r.time - pd.DateOffset(months=2) <= d < r.time]
        assert [r[n] for n in names] == pytest.approx([np.mean(ages), max(ages), min(ages), sum(ages)])


def test_modes_of_decimals_and_times_fall_to_the_smallest_value(spark):
    rows = spark.createDataFrame([(1, 1, "10.5", datetime(2020, 1, 2)), (2, 1, "9.5", datetime(2020, 1, 3))], "i long, k long, d string, t timestamp_ntz")
    es = EntitySet([Entity("c", spark.createDataFrame([(1,)], "k long"), key="k"),
                    Entity("e", rows.withColumn("d", F.col("d").cast("decimal(10,2)")), key="i", time="t", parents=[Parent("c", "k")], categorical=["d"])])
    spec = FeatureSpec("c", aggregates=["mode"], transforms=[], only=["MODE(e.d)"], training_window=None)
    got = make_features(es, spec, spark.createDataFrame([(1, datetime(2020, 2, 1))], "k long, time timestamp_ntz")).first()
    assert float(got["MODE(e.d)"]) == 9.5


def test_grouped_median_of_one_hot_value(spark):
    df = spark.range(2000).select(F.lit("a").alias("g"), F.lit(4.0).alias("v"))
    assert exact_quantiles(df, "v", {"m": 0.5}, ["g"]).first().m == 4.0


def test_built_in_names_are_kept():
    with pytest.raises(ValueError):
        register_aggregate(Aggregate("sum", "numeric", route="pairs", expr=lambda x, t, time: F.max(x)))
    with pytest.raises(ValueError):
        register_partial("sum", PARTIALS["max"])
    with pytest.raises(ValueError):
        register_label("churn", LABELS["purchase"])


def test_long_integers_get_a_wide_type(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType())])
    assert column_types(spark.createDataFrame([], schema)) == {"a": "BIGINT", "b": "INTEGER"}


def test_files_in_order(spark, tmp_path):
    write_sorted(spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(500)).alias("s"), "id"), str(tmp_path / "p"), F.desc("s"), "id")
    parts = sorted((tmp_path / "p").glob("part-*.parquet"))
    rows = [tuple(r) for p in parts for r in pd.read_parquet(p).itertuples(index=False)]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) == 1000


def test_flow_writes_resumes_and_takes_plug_ins(spark, tmp_path):
    config, data = small_model_config("purchase"), tables(spark, FOLDER)
    estimator = LogisticRegression(featuresCol="__features", labelCol="purchase", probabilityCol="__probability",
                                   rawPredictionCol="__raw", predictionCol="__prediction")

    def hook(matrix):
        return matrix.withColumn("extra", F.col("count_orders") * 2)

    first = train_flow(spark, config, data, str(tmp_path / "run"), with_evaluation=False, estimator=estimator, hook=hook)
    assert type(first.models[None].pipeline.stages[-1]).__name__ == "LogisticRegressionModel" and "extra" in first.feature_names
    assert {p.name for p in (tmp_path / "run").iterdir()} >= {"labels", "features", "label_stats", "feature_list", "pipeline", "model_facts"}
    again = train_flow(spark, config, {k: v.limit(0) if k == "nation" else v for k, v in data.items()}, str(tmp_path / "run"), with_evaluation=False, resume=True)
    assert sorted(again.labels.collect()) == sorted(first.labels.collect())
    assert again.features.count() == first.features.count()

    seen = []
    config["result_saving_desc"] = {"table_name": "scores", "db_info": {
        "type": "greenplum", "host": "h", "port": 1, "database": "d", "user": "u", "password": "p"}}
    out = predict_flow(spark, config, first.models, data, str(tmp_path / "out"), hook, write=lambda df, db, table, how: seen.append((table, how, df.count())))
    assert seen == [("scores", "into", out.count())]
    parts = sorted((tmp_path / "out/predictions").glob("part-*.parquet"))
    scores = [x for p in parts for x in pd.read_parquet(p)["prediction"]]
    assert scores == sorted(scores, reverse=True)


def test_id_like_limit_is_a_setting(spark, tmp_path):
    config = small_model_config("purchase")
    config["feature_extraction_desc"] = {**config["feature_extraction_desc"], "id_like_limit": 2}
    result = train_flow(spark, config, tables(spark, FOLDER), with_evaluation=False)
    assert result.id_like_limit == 2 and "c_mktsegment" in result.dropped


def test_comment_job_appends_only_new_words(spark):
    spark.sql("DROP TABLE IF EXISTS words_done")
    comments = spark.createDataFrame([(1, "good dress", 10), (2, "bad fit", 30), (3, "nice cut", 20)], "oid long, content string, created int")
    comment_job(spark, comments.where("oid < 3"), "words_done", stop_words=["bad"])
    comment_job(spark, comments, "words_done", stop_words=["bad"])
    assert sorted(tuple(r) for r in spark.table("words_done").collect()) == [(1, "dress"), (1, "good"), (2, "fit"), (3, "cut"), (3, "nice")]
    spark.sql("DROP TABLE words_done")


def test_specs_can_be_changed(spark):
    assert replace(tr.TrainSpec("y"), rounds=3).rounds == 3
