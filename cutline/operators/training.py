"""Training matrix, splits, boosted trees, scoring and importance with pyspark.ml."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.operators.features import distinct_counts
from cutline.operators.ranking import exact_quantiles, with_deciles, with_rank
from cutline.session import checkpointed
from cutline.sources.sinks import path_exists

MAX_CATEGORIES = 1000
HASHED_CATEGORIES = 4096
HASH_DIGITS = 13


@dataclass(frozen=True)
class TrainSpec:
    """Settings of a training run; the booster defaults follow the reference configuration."""

    label: str
    kind: str = "classifier"
    key: str = "id"
    split: str = "id"
    test_size: float = 0.3
    seed: int = 1
    depth: int = 5
    rate: float = 0.01
    rounds: int = 200
    column_share: float = 0.7
    one_hot_max: int = 10
    weight_threshold: float = 10.0


def train_matrix(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    return features.join(labels, ["time", key])


def training_columns(matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns as a model takes them: no datetimes, numbers and flags as double, NULL text as ``other``."""
    picks = []
    for f in matrix.schema:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            picks.append(c)
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            x = c.cast("int") if isinstance(f.dataType, T.BooleanType) else c
            picks.append(F.nanvl(x.cast("double"), F.lit(None).cast("double")).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            picks.append(F.when(c == "NaT", None).otherwise(F.coalesce(c, F.lit("other"))).alias(f.name))
    return matrix.select(*picks)


def align_columns(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Columns in training order; those the frame lacks become NULL. Entries are (name, type)."""
    return df.select(*[
        (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns])


def hash_number(*parts: Column | str) -> Column:
    """A number from the md5 of the parts' text, the same in every engine."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def split_by_last_time(matrix: DataFrame, out: str = "is_test") -> DataFrame:
    """The latest cutoff is the test part."""
    last = matrix.agg(F.max("time")).first()[0]
    kind = matrix.schema["time"].dataType.simpleString()
    return matrix.withColumn(out, F.col("time") == F.lit(str(last)).cast(kind))


def split_by_id(matrix: DataFrame, key: str, test_size: float = 0.3, seed: int = 1, exact: bool = False,
                out: str = "is_test") -> DataFrame:
    """A share of the ids by hash; ``exact`` takes exactly ``int(test_size * ids)`` of them."""
    if not exact:
        bucket = hash_number(F.col(key), str(seed)) % 10_000
        return matrix.withColumn(out, bucket < int(round(test_size * 10_000)))
    ids = matrix.select(key).distinct().withColumn("__hash", hash_number(F.col(key), str(seed)))
    ranked = with_rank(ids, "__hash", key)
    chosen = F.col("rank") <= F.floor(F.col("rank_total") * test_size + F.lit(1e-9))
    return matrix.join(ranked.select(key, chosen.alias(out)), key)


def split_stratified(matrix: DataFrame, key: str, label: str, test_size: float = 0.3, seed: int = 1,
                     out: str = "is_test") -> DataFrame:
    """Per label, the rows up to the ``test_size`` quantile of their hash."""
    hashed = matrix.withColumn("__hash", hash_number(
        F.col(key), F.date_format("time", "yyyy-MM-dd"), str(seed)).cast("double"))
    limits = exact_quantiles(hashed, "__hash", {"__limit": test_size}, [label]).select(label, "__limit")
    return (hashed.join(limits, label)
            .withColumn(out, F.col("__hash") <= F.col("__limit")).drop("__hash", "__limit").select(*matrix.columns, out))


def split(matrix: DataFrame, spec: TrainSpec) -> DataFrame:
    if spec.split == "last_time":
        return split_by_last_time(matrix)
    if spec.split == "id":
        return split_by_id(matrix, spec.key, spec.test_size, spec.seed)
    if spec.split == "stratified" and spec.kind == "classifier":
        return split_stratified(matrix, spec.key, spec.label, spec.test_size, spec.seed)
    if spec.split == "stratified":
        return matrix.withColumn("is_test", hash_number(
            F.col(spec.key), F.date_format("time", "yyyy-MM-dd"), str(spec.seed)) % 10_000 < int(spec.test_size * 10_000))
    raise ValueError(f"unknown split: {spec.split!r}")


def class_weight(labels: DataFrame, label: str, threshold: float = 10.0) -> DataFrame:
    """(negatives, positives, weight of a positive); the weight is NULL below the threshold."""
    counts = labels.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
    ratio = F.col("negatives") / F.nullif(F.col("positives"), F.lit(0))
    return counts.select("negatives", "positives", F.when(ratio >= threshold, ratio).alias("weight"))


def train_guards(matrix: DataFrame, label: str, kind: str = "classifier") -> DataFrame:
    """One status row for a split matrix: ``ok`` or why no model is trained."""
    per_label = matrix.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_test")).alias("n_train"))
    seen = per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("label_values"),
        F.min("n").alias("smallest_class"), F.count_if(F.col("n_train") > 0).alias("train_label_values"))
    status = F.when(F.col("rows") == 0, "empty")
    if kind == "classifier":
        status = (status.when(F.col("label_values") == 1, "single label value")
                  .when(F.col("smallest_class") == 1, "class with one member"))
    return seen.withColumn("status", status.when(F.col("train_label_values") <= 1, "single label value in train").otherwise("ok"))


@dataclass
class TrainedModel:
    pipeline: PipelineModel
    spec: TrainSpec
    columns: list[tuple[str, str]]
    inputs: list[str]
    facts: dict = field(default_factory=dict)

    def save(self, folder: str, mark: str | None = None) -> None:
        """``mark``: fingerprint of all that the model is made from. It is written last, so a save that failed leaves none."""
        if mark is not None:
            self._save_facts(folder, None)
        self.pipeline.write().overwrite().save(f"{folder}/pipeline")
        self._save_facts(folder, mark)

    def _save_facts(self, folder: str, mark: str | None) -> None:
        text = json.dumps({"spec": asdict(self.spec), "columns": self.columns, "inputs": self.inputs, "facts": self.facts, "mark": mark})
        spark = SparkSession.getActiveSession()
        spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/model_facts")

    @staticmethod
    def saved_mark(spark: SparkSession, folder: str) -> str | None:
        """The mark of the model that was completely saved in a folder; None without one."""
        if not path_exists(spark, f"{folder}/model_facts/_SUCCESS"):
            return None
        return json.loads(spark.read.text(f"{folder}/model_facts").first()[0]).get("mark")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "TrainedModel":
        text = json.loads(spark.read.text(f"{folder}/model_facts").first()[0])
        return cls(PipelineModel.load(f"{folder}/pipeline"), TrainSpec(**text["spec"]),
                   [tuple(c) for c in text["columns"]], text["inputs"], text["facts"])


def _stages(train: DataFrame, spec: TrainSpec, numeric: Sequence[str], text: Sequence[str]):
    """Fill numbers below their minimum with a marker, encode text, assemble one vector.

    Text with more than ``MAX_CATEGORIES`` values is hashed to ``HASHED_CATEGORIES`` of them, so that
    no column is left out and no dictionary grows with the data. Returns the hashed columns too.
    """
    facts = train.agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in numeric]).first().asDict()
    facts |= distinct_counts(train, text)
    hashed = [c for c in text if facts[c] > MAX_CATEGORIES]
    stages, inputs = [], []
    if hashed:
        codes = ", ".join(f"cast(pmod(xxhash64(`{c}`), {HASHED_CATEGORIES}) AS string) AS `{c}__hashed`" for c in hashed)
        stages.append(SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__"))
        facts |= {f"{c}__hashed": facts[c] for c in hashed}
        text = [f"{c}__hashed" if c in hashed else c for c in text]
    if numeric:
        fills = ", ".join(
            f"coalesce(`{c}`, {(facts[c] if facts[c] is not None else 0.0) - 1.0!r}D) AS `{c}__filled`, "
            f"cast(`{c}` IS NULL AS double) AS `{c}__absent`" for c in numeric)
        stages.append(SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__"))
        inputs += [f"{c}__{end}" for c in numeric for end in ("filled", "absent")]
    few = [c for c in text if facts[c] <= spec.one_hot_max]
    many = [c for c in text if facts[c] > spec.one_hot_max]
    if text:
        stages.append(StringIndexer(inputCols=text, outputCols=[f"{c}__index" for c in text], handleInvalid="keep"))
    if few:
        stages.append(OneHotEncoder(inputCols=[f"{c}__index" for c in few], outputCols=[f"{c}__hot" for c in few],
                                    handleInvalid="keep"))
        inputs += [f"{c}__hot" for c in few]
    if many:
        stages.append(TargetEncoder(
            inputCols=[f"{c}__index" for c in many], outputCols=[f"{c}__target" for c in many], labelCol=spec.label,
            targetType="binary" if spec.kind == "classifier" else "continuous", handleInvalid="keep", smoothing=10.0))
        # plain numbers: the encoder's output still calls itself categorical
        means = ", ".join(f"`{c}__target` + 0.0D AS `{c}__mean`" for c in many)
        stages.append(SQLTransformer(statement=f"SELECT *, {means} FROM __THIS__"))
        inputs += [f"{c}__mean" for c in many]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__features"))
    return stages, inputs, hashed


def default_estimator(spec: TrainSpec) -> Estimator:
    common = dict(featuresCol="__features", labelCol=spec.label, predictionCol="__prediction", maxDepth=spec.depth,
                  stepSize=spec.rate, maxIter=spec.rounds, seed=spec.seed, featureSubsetStrategy=str(spec.column_share))
    if spec.kind == "classifier":
        return GBTClassifier(weightCol="__weight", **common).setProbabilityCol("__probability").setRawPredictionCol("__raw")
    return GBTRegressor(**common)


def best_rounds(booster, test: DataFrame, kind: str) -> int:
    """The number of boosting rounds with the smallest loss on the test part; all rounds if it is empty."""
    if test.isEmpty():
        return booster.getNumTrees
    losses = booster.evaluateEachIteration(test) if kind == "classifier" else booster.evaluateEachIteration(test, "squared")
    return losses.index(min(losses)) + 1


def fit_booster(train: DataFrame, test: DataFrame, spec: TrainSpec):
    """All rounds on the train part, then the best prefix of them by the loss on the test part.

    Boosting with the same seed repeats its rounds, so the prefix is a second, shorter fit.
    """
    booster = default_estimator(spec).fit(train)
    best = best_rounds(booster, test, spec.kind)
    return booster if best == spec.rounds else default_estimator(replace(spec, rounds=best)).fit(train)


def fit(matrix: DataFrame, spec: TrainSpec, estimator: Estimator | None = None) -> TrainedModel | None:
    """Train on a joined matrix with plain column names; None if a guard says no.

    ``estimator`` may be any pyspark.ml estimator on ``__features``. ``facts`` of the result record
    the rounds kept and the text columns that were hashed.
    """
    matrix = matrix.where(F.col(spec.label).isNotNull())
    prepared = split(matrix, spec)
    prepared = training_columns(prepared, [spec.key, "time", "is_test"]).withColumn(
        spec.label, F.col(spec.label).cast("double"))
    # the feature plan is long and boosting reads its input many times
    prepared = checkpointed(prepared)
    guard = train_guards(prepared, spec.label, spec.kind).first()
    if guard["status"] != "ok":
        return None
    keep = [spec.key, "time", "is_test", spec.label]
    columns = [(f.name, f.dataType.simpleString()) for f in prepared.schema if f.name not in keep]
    numeric = [c for c, t in columns if t == "double"]
    text = [c for c, t in columns if t == "string"]
    train = prepared.where(~F.col("is_test"))
    facts = {"samples": guard["rows"], "features": len(columns),
             "cutoffs": prepared.agg(F.count_distinct("time")).first()[0]}
    weight = F.lit(1.0)
    if spec.kind == "classifier":
        w = class_weight(prepared, spec.label, spec.weight_threshold).first()
        facts["class_weight"] = w["weight"]
        if w["weight"] is not None:
            weight = F.when(F.col(spec.label) == 1, w["weight"]).otherwise(1.0)
        facts["pos_rate"] = w["positives"] / guard["rows"]
    else:
        middle = exact_quantiles(prepared, spec.label, {"median": 0.5}).first()["median"]
        facts.update(mean=prepared.agg(F.avg(spec.label)).first()[0], median=middle)
    stages, inputs, facts["hashed"] = _stages(train, spec, numeric, text)
    encoders = Pipeline(stages=stages).fit(train)
    # every round reads the encoded rows
    encoded = checkpointed(encoders.transform(prepared.withColumn("__weight", weight)).select(
        "__features", "__weight", spec.label, "is_test"))
    train_rows, test_rows = encoded.where(~F.col("is_test")), encoded.where("is_test")
    if estimator is not None:
        booster = estimator.fit(train_rows)
    else:
        booster = fit_booster(train_rows, test_rows, spec)
        facts["rounds"] = booster.getNumTrees
    model = TrainedModel(PipelineModel(stages=[*encoders.stages, booster]), spec, columns, inputs, facts)
    if spec.kind == "classifier":
        scores = raw_scores(model, train)
        facts["threshold"] = exact_quantiles(scores, "prediction", {"q": 1 - facts["pos_rate"]}).first()["q"]
    return model


def raw_scores(model: TrainedModel, matrix: DataFrame) -> DataFrame:
    """(key, time, prediction) for a feature matrix; columns are aligned to the training columns."""
    keep = [c for c in (model.spec.key, "time") if c in matrix.columns]
    typed = training_columns(matrix, keep)
    rows = typed.select(*keep, F.struct(*[F.col(f"`{c}`") for c in typed.columns if c not in keep]).alias("__row"))
    have = [c for c in typed.columns if c not in keep]
    rows = rows.select(*keep, *[
        (F.col("__row")[c] if c in have else F.lit(None)).cast(t).alias(c) for c, t in model.columns])
    scored = model.pipeline.transform(rows)
    value = vector_to_array("__probability")[1] if model.spec.kind == "classifier" else F.col("__prediction")
    return scored.select(*keep, value.alias("prediction"))


def with_label(scored: DataFrame, threshold: float | None = None, top_share: float | None = None) -> DataFrame:
    """0/1 label by a score threshold, or for the top share of the rows by score."""
    if (threshold is None) == (top_share is None):
        raise ValueError("give a threshold or a share")
    if top_share is not None:
        threshold = exact_quantiles(scored, "prediction", {"q": 1 - top_share}).first()["q"]
    return scored.withColumn("label", (F.col("prediction") >= F.lit(threshold)).cast("int"))


def predict(model: TrainedModel, matrix: DataFrame) -> DataFrame:
    """Prediction table; for a classifier also label, decile, rounded score and training rates."""
    key = model.spec.key
    # scores come from float sums, and ranking reads them twice
    scored = checkpointed(raw_scores(model, matrix).withColumnRenamed("time", "cutoff"))
    if model.spec.kind != "classifier":
        return scored
    labelled = with_label(scored, threshold=model.facts["threshold"])
    ties = [c for c in (key, "cutoff") if c in labelled.columns]
    return with_deciles(labelled, "prediction", ties).select(
        key, "cutoff", F.round("prediction", 4).alias("prediction"), "label", "decile",
        F.lit(model.facts["pos_rate"]).alias("train_pos_rate"),
        F.lit(model.facts["threshold"]).alias("train_pos_rate_threshold"))


def fit_products(matrix: DataFrame, labels: DataFrame, spec: TrainSpec, products: Sequence,
                 estimator: Estimator | None = None) -> dict:
    """One model per product on one fixed feature matrix; products without a model are left out."""
    matrix = checkpointed(matrix)
    models = {}
    for product in products:
        mine = labels.where(F.col("product") == product).select("time", spec.key, spec.label)
        model = fit(train_matrix(matrix, mine, spec.key), spec, estimator)
        if model is not None:
            models[product] = model
    return models


def predict_products(models: dict, matrix: DataFrame) -> DataFrame | None:
    out = None
    for product, model in models.items():
        part = predict(model, matrix).withColumn("product", F.lit(product))
        out = part if out is None else out.unionByName(part)
    return out


def feature_importance(model: TrainedModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Importance per input column (encoded parts added up), largest first; ``top`` keeps a few for a picture."""
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    sizes = _input_sizes(model)
    rows, at = [], 0
    for name in model.inputs:
        width = sizes.get(name, 1)
        rows.append((name.rsplit("__", 1)[0].removesuffix("__hashed"), float(sum(weights[at:at + width]))))
        at += width
    df = spark.createDataFrame(rows, "feature_name string, importance double").groupBy("feature_name").agg(
        F.sum("importance").alias("feature_importance"))
    df = df.orderBy(F.desc("feature_importance"), "feature_name")
    return df.limit(top) if top else df


def _input_sizes(model: TrainedModel) -> dict[str, int]:
    """Width of each one-hot vector."""
    out = {}
    for stage in model.pipeline.stages:
        if type(stage).__name__ == "OneHotEncoderModel":
            drop = 1 if stage.getDropLast() else 0
            extra = 1 if stage.getHandleInvalid() == "keep" else 0
            for column, size in zip(stage.getOutputCols(), stage.categorySizes):
                out[column] = size + extra - drop
    return out
