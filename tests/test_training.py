from datetime import datetime

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cutline.operators import training as tr
from cutline.operators.evaluation import auc
from cutline.plans.flows import label_spec, predict_flow, preview, train_flow
from cutline.plans.queries import small_model_config, tables

FOLDER = "/root/testdata/sf0.001"
SPEC = tr.TrainSpec("y", key="id", rounds=4, depth=3, rate=0.3)


@pytest.fixture(scope="module")
def matrix(spark):
    """A planted signal: y follows x, with some noise and a few absent values."""
    df = spark.range(600).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)
    return df.select(
        "id", F.expr("IF(id % 3 = 0, timestamp_ntz'2020-02-01', timestamp_ntz'2020-01-01')").alias("time"),
        F.when(F.col("id") % 11 != 0, F.col("h")).alias("x"), F.concat(F.lit("c"), F.col("id") % 4).alias("few"),
        F.concat(F.lit("m"), F.col("id") % 17).alias("many"), (F.col("h") + F.pmod(F.xxhash64("id", "h"), F.lit(100)) / 300 > 0.8)
        .cast("int").alias("y"))


@pytest.fixture(scope="module")
def model(matrix):
    return tr.fit(matrix, SPEC)


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "NaT", True, datetime(2020, 1, 1)), (2, 5, None, None, None)],
                               "id long, n int, s string, b boolean, t timestamp_ntz")
    out = tr.training_columns(df, ["id"])
    assert out.columns == ["id", "n", "s", "b"]
    assert [tuple(r) for r in out.collect()] == [(1, None, None, 1.0), (2, 5.0, "other", None)]
    assert tr.align_columns(out, [("s", "string"), ("gone", "double")]).first() == (None, None)


def test_splits(matrix):
    assert tr.split_by_last_time(matrix).where("is_test").select("time").distinct().count() == 1
    by_id = tr.split_by_id(matrix, "id", 0.3)
    assert 120 < by_id.where("is_test").count() < 240
    assert tr.split_by_id(matrix, "id", 0.3, exact=True).where("is_test").count() == 180
    parts = tr.split_stratified(matrix, "id", "y", 0.3).groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("s"))
    assert all(abs(r.s - 0.3) < 0.02 for r in parts.collect())
    with pytest.raises(ValueError):
        tr.split(matrix, tr.TrainSpec("y", split="odd"))


def test_guards_and_weight(matrix):
    def status(df):
        return tr.train_guards(df.withColumn("is_test", F.col("id") % 2 == 0), "y").first().status
    assert status(matrix) == "ok" and status(matrix.limit(0)) == "empty"
    assert status(matrix.where("y = 1")) == "single label value"
    assert status(matrix.withColumn("y", (F.col("id") == 3).cast("int"))) == "class with one member"
    assert status(matrix.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("id") % 4).otherwise(0))) == "single label value in train"
    assert tr.fit(matrix.where("y = 1"), SPEC) is None
    w = tr.class_weight(matrix, "y").first()
    assert w.weight is None and tr.class_weight(matrix, "y", 0.1).first().weight == w.negatives / w.positives


def test_model_finds_the_signal_and_survives_saving(spark, matrix, model, tmp_path):
    scored = tr.raw_scores(model, matrix).join(matrix.select("id", "y"), "id")
    quality = auc(scored, "y", "prediction").first().auc
    assert quality > 0.8
    model.save(str(tmp_path / "m"))
    again = tr.TrainedModel.load(spark, str(tmp_path / "m"))
    a = tr.predict(model, matrix).orderBy("id").collect()
    assert a == tr.predict(again, matrix).orderBy("id").collect()
    assert set(a[0].asDict()) == {"id", "cutoff", "prediction", "label", "decile", "train_pos_rate", "train_pos_rate_threshold"}
    assert tr.raw_scores(model, matrix.drop("few")).count() == 600
    top = tr.feature_importance(model, spark).collect()
    assert top[0].feature_name == "x" and top[0].feature_importance == max(r.feature_importance for r in top)


def test_any_estimator(matrix):
    estimator = LogisticRegression(featuresCol="__features", labelCol="y", probabilityCol="__probability",
                                   rawPredictionCol="__raw", predictionCol="__prediction")
    model = tr.fit(matrix, SPEC, estimator)
    assert tr.raw_scores(model, matrix).where("prediction BETWEEN 0 AND 1").count() == 600


def test_products(matrix):
    long = matrix.select("id", "time", "y", F.lit("a/b").alias("product")).unionByName(
        matrix.select("id", "time", F.lit(1).alias("y"), F.lit("always").alias("product")))
    models = tr.fit_products(matrix.drop("y"), long, SPEC, ["a/b", "always"])
    assert list(models) == ["a/b"]
    assert tr.predict_products(models, matrix.drop("y")).select("product").distinct().count() == 1


def test_flow_for_products(spark, tmp_path):
    config = small_model_config("purchase")
    config["business_desc"] = {
        "problem_type": "product_purchase", "customer_entity": "customer", "behavior_entity": "orders", "product_entity": "priority",
        "target_definition": {"product_purchase_para": {"product_column": "grade", "product_list": ["high", "low", None]}}}
    config["entity_set_desc"][2]["parent_entity"].append({"entity_name": "priority", "join_column": "o_orderpriority"})
    config["entity_set_desc"].append({"entity_name": "priority", "index": ["p_name"]})
    data = dict(tables(spark, FOLDER))
    data["priority"] = data["orders"].select(F.col("o_orderpriority").alias("p_name")).distinct().withColumn(
        "grade", F.when(F.col("p_name") < "3", "high").otherwise("low"))
    with pytest.warns(UserWarning):
        result = train_flow(spark, config, data, str(tmp_path / "models"), with_evaluation=False)
    assert set(result.models) == {"high", "low"}
    with pytest.warns(UserWarning):
        scored = predict_flow(spark, config, result.models, data)
    assert {r.grade for r in scored.select("grade").distinct().collect()} == {"high", "low"}
    assert any("where_priority_grade_high" in c for c in result.features.columns)


def test_flow_with_evaluation(spark):
    result = train_flow(spark, small_model_config("value"), tables(spark, FOLDER))
    assert result.label_stats.where("time = 'All'").count() == 1 and "c_name" not in result.dropped
    parts = result.evaluations[None]
    assert set(parts) == {"train", "test"} and parts["test"]["metrics"].first().mae > 0
    assert parts["test"]["profit"].count() == 10
    assert set(preview(spark, small_model_config("value"), tables(spark, FOLDER))) == {"customer", "nation", "orders"}


def test_configuration_names():
    config = small_model_config("purchase")
    config["business_desc"]["target_definition"] = {"action": [{"column": "a", "operator": "==", "value": 1}]}
    assert label_spec(config).actions == [{"column": "a", "operator": "==", "value": 1}]
    config["business_desc"]["problem_type"] = "other"
    with pytest.raises(ValueError):
        label_spec(config)
