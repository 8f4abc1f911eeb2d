"""Training and prediction flows from a configuration document (a plain dict, as read from YAML)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutline.functions.calendar import Offset
from cutline.functions.primitives import DEFAULT_AGGREGATES, DEFAULT_TRANSFORMS, DEFAULT_WHERE
from cutline.operators.entities import (
    Entity, EntitySet, Parent, auto_interesting, common_keys, keep_last_by_key, product_join, virtual_parent,
    with_native_keys)
from cutline.operators.evaluation import (
    auc, confusion_matrix, cumulative_gain, gain_regression, prediction_pairs, profit_report_classifier,
    profit_report_regression, regression_metrics, roc_points)
from cutline.operators.features import drop_id_like, id_like_columns, make_features, sql_name, with_sql_names
from cutline.operators.labels import LabelSpec, label_cutoffs, label_stats, make_labels, with_action_rows
from cutline.operators.training import (
    TrainedModel, TrainSpec, fit, predict, raw_scores, split, train_matrix)
from cutline.plans.feature_plan import Feature, FeatureSpec, plan_features
from cutline.session import checkpointed
from cutline.sources.readers import Database, load_entities
from cutline.sources.sinks import save_result, stage_folder, staged, write_csv, write_jdbc, write_parquet, write_sorted
from cutline.sources.snapshots import fingerprint

# fixed values: problem type -> label type
LABEL_TYPES = {"churn": "classifier", "purchase": "classifier", "value": "regression", "product_purchase": "classifier"}
ACTION_FLAG = "is_action"


def _window(desc: Mapping, name: str, default: Offset | None = None) -> Offset | None:
    part = desc.get(f"{name}_window") or desc.get(name) or {}
    n, unit = part.get(f"{name}_window"), part.get(f"{name}_window_unit")
    return default if n is None or unit is None else Offset(n, unit)


def label_spec(config: Mapping) -> LabelSpec:
    business, desc = config["business_desc"], config["label_desc"]
    target = business.get("target_definition") or {}
    problem, point = business["problem_type"], desc.get("cutoff_point") or {}
    if problem not in LABEL_TYPES:
        raise ValueError(f"unknown problem type: {problem!r}")
    lead = desc.get("lead_time_window") or {}
    return LabelSpec(
        problem=problem, params=dict(target.get(f"{problem}_para") or {}),
        actions=list(target.get("actions_list") or target.get("action") or []),
        cutoff_day=point.get("cutoff_day") or 1, cutoff_num=point.get("cutoff_num"),
        last_cutoff=point.get("cutoff_last_date"),
        gap=Offset(point.get("gap_window") or 1, point.get("gap_window_unit") or "months"),
        sample=_window(desc, "sample_filtering"), prediction=_window(desc, "prediction"),
        lead=Offset(lead.get("lead_time_window") or 0, lead.get("lead_time_window_unit") or "days"))


def feature_spec(config: Mapping) -> FeatureSpec:
    business, desc = config["business_desc"], config.get("feature_extraction_desc") or {}
    interesting = desc.get("interesting_values_desc") or {}
    ignored = {e["entity_name"]: e.get("columns") or e.get("values") or [] for e in desc.get("ignore_variables") or ()}
    return FeatureSpec(
        target=business["customer_entity"], aggregates=desc.get("agg_primitives") or DEFAULT_AGGREGATES,
        transforms=desc.get("trans_primitives") or DEFAULT_TRANSFORMS,
        where=interesting.get("where_primitives") or DEFAULT_WHERE,
        training_window=_window(config.get("label_desc") or {}, "training"),
        ignore_entities=desc.get("ignore_entities") or (), ignore_columns=ignored,
        drop_contains=desc.get("drop_contains") or (), drop_exact=desc.get("drop_exact") or (),
        max_features=desc.get("max_features"))


def train_spec(config: Mapping, label: str, key: str) -> TrainSpec:
    desc = config.get("model_desc") or {}
    para = desc.get("model_para") or {}
    names = {"depth": "depth", "rate": "learning_rate", "rounds": "iterations", "column_share": "rsm",
             "one_hot_max": "one_hot_max_size"}
    given = {ours: para[theirs] for ours, theirs in names.items() if para.get(theirs) is not None}
    if desc.get("test_size") is not None:
        given["test_size"] = desc["test_size"]
    if desc.get("train_test_split_type"):
        given["split"] = desc["train_test_split_type"].removeprefix("split_by_")
    return TrainSpec(label=label, key=key, kind=LABEL_TYPES[config["business_desc"]["problem_type"]], **given)


def entity_set(spark: SparkSession, config: Mapping, tables: Mapping[str, DataFrame] | None = None,
               nrows: int | None = None) -> EntitySet:
    """Entities of ``entity_set_desc``: loaded, typed, one row per key, linked to their parents."""
    described = {d["entity_name"]: d for d in config["entity_set_desc"]}
    frames = load_entities(spark, config["entity_set_desc"], nrows, tables)
    for name, d in described.items():
        key, time = (d.get("index") or [None])[0], d.get("time_index")
        if d.get("normalize_base_entity"):
            base = described[d["normalize_base_entity"]]
            frames[name] = virtual_parent(frames[base["entity_name"]], key, base.get("time_index"))
        elif key and d.get("drop_duplicates", True):
            frames[name] = keep_last_by_key(frames[name], key, [time] if time else [])
    business = config.get("business_desc") or {}
    wanted: dict[str, dict[str, list]] = {}
    interesting = (config.get("feature_extraction_desc") or {}).get("interesting_values_desc") or {}
    for entry in interesting.get("manual_interesting_values_desc") or ():
        for c in entry["columns_desc"]:
            wanted.setdefault(entry["entity_name"], {})[c["column_name"]] = list(c["column_values"])
    product = (business.get("target_definition") or {}).get("product_purchase_para") or {}
    if business.get("product_entity") and product.get("product_list"):
        listed = [p for p in product["product_list"] if p is not None]
        wanted.setdefault(business["product_entity"], {})[product["product_column"]] = listed
    entities = []
    for name, d in described.items():
        parents = []
        for p in d.get("parent_entity") or ():
            parent_key = described[p["entity_name"]]["index"][0]
            parents.append(Parent(p["entity_name"], p.get("join_column") or parent_key))
        categorical = [f["name"] for f in d.get("field_list") or () if f["variable_type"] == "categorical"]
        entities.append(Entity(name, frames[name], (d.get("index") or [None])[0], d.get("time_index"),
                               parents, categorical=categorical))
    es = with_native_keys(EntitySet(entities)).with_interesting(wanted)
    if interesting.get("auto_max_values"):
        es = auto_interesting(es, interesting["auto_max_values"])
    return es


def label_events(es: EntitySet, config: Mapping, spec: LabelSpec) -> tuple[DataFrame, LabelSpec]:
    """Behaviour rows as labels need them: with product columns or target rows, if the problem asks."""
    business = config["business_desc"]
    behaviour = es[business["behavior_entity"]]
    events, column = behaviour.df, _customer_column(es, config)
    if spec.problem == "product_purchase":
        product = es[business["product_entity"]]
        link = next(p.column for p in behaviour.parents if p.name == product.name)
        events = product_join(events, product.df.withColumnRenamed(product.key, link), link)
    if business.get("action_entity"):
        action = es[business["action_entity"]]
        link = next(p.column for p in action.parents if p.name == business["customer_entity"])
        rows = action.df.select(F.col(link).alias(column), F.col(action.time).alias(behaviour.time))
        events = with_action_rows(events.select(column, behaviour.time), rows, ACTION_FLAG)
        flag = {"column": ACTION_FLAG, "operator": "==", "value": 1}
        spec = LabelSpec(**{**spec.__dict__, "actions": [*spec.actions, flag]})
    if config.get("known_customers_only"):
        events = common_keys(events, es[business["customer_entity"]].df, column, es[business["customer_entity"]].key)
    return events, spec


def _customer_column(es: EntitySet, config: Mapping) -> str:
    business = config["business_desc"]
    return next(p.column for p in es[business["behavior_entity"]].parents if p.name == business["customer_entity"])


def labels(es: EntitySet, config: Mapping, mode: str = "train", last_cutoff=None) -> tuple[DataFrame, list[datetime], LabelSpec]:
    """Label table with the customer key and ``time``, its cutoffs and the spec."""
    spec = label_spec(config)
    if mode == "predict":
        spec = LabelSpec(**{**spec.__dict__, "last_cutoff": last_cutoff})
    events, spec = label_events(es, config, spec)
    behaviour = es[config["business_desc"]["behavior_entity"]]
    column, key = _customer_column(es, config), es[config["business_desc"]["customer_entity"]].key
    cutoffs = label_cutoffs(events, behaviour.time, spec, mode)
    table = make_labels(events, column, behaviour.time, spec, mode, cutoffs)
    return table.withColumnRenamed(column, key), cutoffs, spec


def features(es: EntitySet, config: Mapping, instances: DataFrame, cutoffs, plan: list[Feature] | None = None) -> DataFrame:
    """Feature matrix with plain column names."""
    spec = feature_spec(config)
    plan = plan if plan is not None else plan_features(es, spec)
    return with_sql_names(make_features(es, spec, instances, cutoffs, plan))


MODEL_PARTS = {"model_desc", "model_prediction_desc", "result_saving_desc"}
#: Parts of the configuration that a stage does not depend on.
AFTER = {"entities": {*MODEL_PARTS, "feature_extraction_desc", "label_desc"}, "labels": {*MODEL_PARTS, "feature_extraction_desc"}, "features": MODEL_PARTS,
         "model": {"model_prediction_desc", "result_saving_desc"}}


@dataclass
class TrainingResult:
    labels: DataFrame
    label_stats: DataFrame
    features: DataFrame
    dropped: list[str]
    models: dict[str | None, TrainedModel]
    feature_names: list[str] = field(default_factory=list)
    id_like_limit: int = 1000
    evaluations: dict[str | None, dict[str, dict[str, DataFrame]]] = field(default_factory=dict)


def evaluate(model: TrainedModel, matrix: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """All evaluation tables for the train and the test part."""
    spec = model.spec
    parts = split(matrix.where(F.col(spec.label).isNotNull()), spec)
    scored = checkpointed(raw_scores(model, parts).join(parts.select(spec.key, "time", spec.label, "is_test"), [spec.key, "time"]))
    out = {}
    for name, flag in (("train", False), ("test", True)):
        part = scored.where(F.col("is_test") == flag)
        y, p, tie = spec.label, "prediction", [spec.key, "time"]
        if spec.kind == "classifier":
            out[name] = {
                "auc": auc(part, y, p), "roc": roc_points(part, y, p), "confusion": confusion_matrix(part, y, p),
                "gain": cumulative_gain(part, y, p, tie), "profit": profit_report_classifier(part, y, p)}
        else:
            out[name] = {
                "metrics": regression_metrics(part, y, p), "pairs": prediction_pairs(part, y, p),
                "gain": gain_regression(part, y, p, tie), "profit": profit_report_regression(part, y, p, tie)}
    return out


def train_flow(spark: SparkSession, config: Mapping, tables: Mapping[str, DataFrame] | None = None,
               folder: str | None = None, with_evaluation: bool = True, resume: bool = False,
               estimator: Estimator | None = None, hook: Callable[[DataFrame], DataFrame] | None = None,
               snapshot: bool = False) -> TrainingResult:
    """Labels, features, one model per product (or one), evaluation.

    With a ``folder``, labels (by cutoff), label statistics, feature matrix, feature list and models are
    written there, labels and matrix in a folder named by a fingerprint of settings and inputs, models with it beside; ``resume``
    takes those that an earlier run completed from the same ones. ``estimator`` may be any pyspark.ml estimator; ``hook`` shapes the
    feature matrix of one project. They are code, which has no fingerprint: a run with one of them trains its models itself.
    ``snapshot`` first writes the entities there too, so that labels and features see the same rows.
    """
    def mark_of(name: str, *more) -> str:
        settings = {k: v for k, v in config.items() if k not in AFTER[name.split("/")[0]]}
        return fingerprint([name, settings, *more], inputs)

    def stage(name: str, build: Callable[[], DataFrame], by: Sequence = ()) -> DataFrame:
        if folder is None:
            return checkpointed(build())
        return staged(build, spark, f"{folder}/{name}", resume, by, mark_of(name))

    es = entity_set(spark, config, tables)
    inputs = {n: e.df for n, e in es.entities.items()}
    if snapshot and folder is not None:
        es = EntitySet([replace(e, df=stage(f"entities/{e.name}", lambda e=e: e.df)) for e in es.entities.values()])
    made, cutoffs, spec = labels(es, config)
    key = es[config["business_desc"]["customer_entity"]].key
    label = "value" if spec.problem == "value" else spec.problem
    # read once per product and once per statistic
    table = stage("labels", lambda: made, ["time"])
    instances = table.select(key, "time").distinct() if spec.problem == "product_purchase" else table.select(key, "time")
    matrix = stage("features", lambda: features(es, config, instances, cutoffs))
    plain = sql_name(key)
    limit = (config.get("feature_extraction_desc") or {}).get("id_like_limit") or 1000
    dropped = id_like_columns(matrix, [plain, "time"], limit=limit)
    matrix = drop_id_like(matrix, dropped, hook)
    names = [c for c in matrix.columns if c not in (plain, "time")]
    settings = train_spec(config, label, plain)
    kind = settings.kind
    table = table.withColumnRenamed(key, plain)
    stats = label_stats(table, label, kind)
    if folder:
        write_parquet(stats, f"{folder}/label_stats")
        write_csv(spark.createDataFrame(list(enumerate(names)), "index int, feature_name string").coalesce(1), f"{folder}/feature_list")
    products = [None]
    if spec.problem == "product_purchase":
        products = [p for p in spec.params["product_list"] if p is not None]
    result = TrainingResult(table, stats, matrix, dropped, {}, feature_names=names, id_like_limit=limit)
    for product in products:
        mine = table if product is None else table.where(F.col("product") == product)
        joined = train_matrix(matrix, mine.select("time", plain, label), plain)
        place = stage_folder(folder, product) if folder else None
        mark = mark_of("model", product, asdict(settings), names) if folder and estimator is None and hook is None else None
        done = resume and mark is not None and TrainedModel.saved_mark(spark, place) == mark
        model = TrainedModel.load(spark, place) if done else fit(joined, settings, estimator)
        if model is None:
            continue
        result.models[product] = model
        if with_evaluation:
            result.evaluations[product] = evaluate(model, joined)
        if folder and not done:
            model.save(place, mark)
    return result


def predict_flow(spark: SparkSession, config: Mapping, models: Mapping[str | None, TrainedModel],
                 tables: Mapping[str, DataFrame] | None = None, folder: str | None = None,
                 hook: Callable[[DataFrame], DataFrame] | None = None, write=write_jdbc) -> DataFrame | None:
    """Score everyone active at the latest cutoff with every model; the label logic only lists them.

    With a ``folder``, predictions are written there by falling score, and from there into the table that
    ``result_saving_desc`` (``db_info``, ``table_name``, ``insert_type``) names, if the config has one.
    """
    es = entity_set(spark, config, tables)
    wanted = (config.get("model_prediction_desc") or {}).get("cutoff_last_date")
    table, cutoffs, spec = labels(es, config, "predict", wanted)
    key = es[config["business_desc"]["customer_entity"]].key
    matrix = checkpointed(drop_id_like(features(es, config, table.select(key, "time").distinct(), cutoffs), [], hook))
    out = None
    for product, model in models.items():
        part = predict(model, matrix)
        if product is not None:
            part = part.withColumn(spec.params["product_column"], F.lit(product))
        out = part if out is None else out.unionByName(part)
    if out is None or folder is None:
        return out
    path = f"{folder}/predictions"
    write_sorted(out, path, F.desc("prediction"), *[c for c in out.columns if c != "prediction"])
    saving = config.get("result_saving_desc")
    if saving:
        save_result(spark, path, Database.from_config(saving["db_info"]), saving["table_name"], saving.get("insert_type") or "into", write)
    return spark.read.parquet(path)


def preview(spark: SparkSession, config: Mapping, tables: Mapping[str, DataFrame] | None = None) -> dict[str, str]:
    """Schema of every entity without reading rows."""
    es = entity_set(spark, config, tables, nrows=0)
    return {name: e.df.schema.simpleString() for name, e in es.entities.items()}
