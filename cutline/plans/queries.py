"""The registered queries: every operator on the given tables, over whole tables and whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cutline.functions.actions import exclude_values
from cutline.functions.calendar import Offset, seconds_between
from cutline.functions.primitives import TRANSFORMS, Aggregate, register_aggregate
from cutline.functions.standardize import apply_dictionary, cast_keys, null_minimum_dates, replace_commas, standardize_types
from cutline.operators import evaluation as ev
from cutline.operators import training as tr
from cutline.operators.entities import (
    Entity, EntitySet, Parent, auto_interesting, common_keys, frequent_values, keep_last_by_key, parent_lookup,
    product_join, virtual_parent)
from cutline.operators.features import id_like_columns, make_features, with_sql_names
from cutline.operators.labels import (
    LabelFunction, LabelSpec, label_cutoffs, label_stats, make_labels, register_label, wide_products, with_action_rows)
from cutline.operators.ranking import exact_quantiles, percentile_rank, previous_row, with_deciles, with_rank
from cutline.operators.text import counted_words, dictionary_words, letter_words, new_comments, spread, word_rows
from cutline.operators.windows import Buckets, RoleWindow, interval_join
from cutline.plans.comment_flow import comment_job
from cutline.plans.comment_flow import comment_words as comment_words_flow
from cutline.plans.feature_plan import FeatureSpec
from cutline.plans.flows import predict_flow, train_flow
from cutline.session import checkpointed, shared_folder
from cutline.sources.readers import modified_since, read_csv
from cutline.sources.sinks import sanitized, write_csv
from cutline.sources.snapshots import refresh_snapshot
from cutline.sources.sql_jobs import run_sql, union_over

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# fixed values used by both the queries and their SQL
PRODUCT_TYPES = ["PROMO", "ECONOMY", "SMALL"]
STOP_WORDS = ["the", "and", "of", "in", "de", "la", "le", "et", "der", "die", "und", "el", "los"]
BIG_SPEND = 300000.0
ERROR_BOUNDS = [1000.0, 10000.0, 50000.0, 100000.0]


def query(f: Callable[[SparkSession, str], DataFrame]):
    # a trailing underscore keeps the function apart from the operator of the same name
    QUERIES[f.__name__.rstrip("_")] = f
    return f


@lru_cache(maxsize=64)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A lazy table; its schema is read once per session."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def by_day(df: DataFrame, *columns) -> DataFrame:
    return df.select(*[day(c) if c == "time" else c for c in (columns or df.columns)])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# ---- loading and clean-up


@query
def standardize_types_(spark, d):
    raw = table(spark, d, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), F.regexp_extract("props", r"(\d+)", 1).alias("k"),
        F.col("event_type").alias("as_number"), (F.col("event_type") == "click").cast("string").alias("clicked"),
        F.col("user_id").alias("user_text"))
    fields = [("ts", "datetime"), ("k", "int"), ("as_number", "numeric"), ("clicked", "boolean"),
              ("user_text", "categorical"), ("absent", "numeric")]
    typed = standardize_types(raw, [{"name": n, "variable_type": t} for n, t in fields])
    return typed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def min_date_null(spark, d):
    old = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderdate") - Offset(98, "years").interval()).alias("seen"))
    return null_minimum_dates(old).withColumn("seen", F.date_format("seen", "yyyy-MM-dd"))


@query
def exclude_values_(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return exclude_values(rows, [{"column": "priority", "values": ["1-URGENT", "2-HIGH"]}])


@query
def data_dictionary(spark, d):
    rows = table(spark, d, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    entries = [
        {"source": "c_custkey", "target": "customer_id", "type": "int", "is_key": 1},
        {"source": "c_name", "target": "name", "type": "varchar"},
        {"source": "c_acctbal", "target": "balance", "type": "float"},
        {"source": "c_mktsegment", "target": "segment", "type": "varchar", "is_merge": 1},
        {"source": "c_grade", "target": "grade", "type": "varchar", "default": "basic"},
        {"source": "c_nationkey", "target": None},
    ]
    shaped = apply_dictionary(rows, entries, order="c_custkey", constants={"shop": "main"})
    return rounded(shaped, 2, "balance")


@query
def keep_last_by_key_(spark, d):
    return keep_last_by_key(
        table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"),
        "o_custkey", ["o_orderdate"]).select("o_custkey", day("o_orderdate"), "o_orderkey", "o_orderstatus")


@query
def incremental_scan(spark, d):
    fresh = modified_since(table(spark, d, "lineitem"), "l_shipdate", "2001-01-01 00:00:00")
    return fresh.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query
def virtual_parent_(spark, d):
    return virtual_parent(table(spark, d, "orders"), "o_custkey", "o_orderdate").select(
        "o_custkey", day("first_o_orderdate"))


@query
def parent_lookup_(spark, d):
    nation = parent_lookup(table(spark, d, "nation"), table(spark, d, "region"), "n_regionkey", "r_regionkey", "region")
    joined = parent_lookup(table(spark, d, "customer"), nation, "c_nationkey", "n_nationkey", "nation")
    return joined.select("c_custkey", "nation_n_name", "nation_region_r_name")


@query
def key_semi_join(spark, d):
    return common_keys(table(spark, d, "customer"), table(spark, d, "orders"), "c_custkey", "o_custkey").select(
        "c_custkey", "c_mktsegment")


@query
def csv_round_trip(spark, d):
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return read_csv(spark, path, schema="c_custkey bigint, c_name string, c_acctbal double")


@query
def sanitized_text(spark, d):
    return sanitized(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.md5("text").alias("text_md5"))


@query
def comma_replacement(spark, d):
    return replace_commas(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.md5("text").alias("text_md5"))


@query
def key_cast(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment")
    left, right = cast_keys(table(spark, d, "orders"), "o_custkey", keys, "c_custkey")
    return left.join(right, left.o_custkey == right.c_custkey).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


# ---- labels


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders")


def label(spark, d, spec: LabelSpec, events: DataFrame | None = None, key="o_custkey", time="o_orderdate", **how):
    events = orders(spark, d) if events is None else events
    return by_day(make_labels(events, key, time, spec, **how))


PURCHASE = LabelSpec("purchase")
CHURN = LabelSpec("churn", prediction=Offset(12), params={"churn_window": 12, "churn_window_unit": "months"})


def value_spec(how: str, prediction: Offset = Offset(12)) -> LabelSpec:
    return LabelSpec("value", prediction=prediction, params={"value_column": "o_totalprice", "value_agg": how})


@query
def cutoff_schedule(spark, d):
    """Cutoffs on the 31st (clamped, stepping iteratively) with the events in each sample window."""
    spec = replace(PURCHASE, cutoff_day=31, cutoff_num=6)
    cutoffs = label_cutoffs(orders(spark, d), "o_orderdate", spec)
    windows = Buckets([RoleWindow(c, "sample", spec.sample.before(c), c) for c in cutoffs])
    pairs = interval_join(orders(spark, d).select("o_orderdate"), "o_orderdate", windows)
    return by_day(pairs.groupBy("time").agg(F.count(F.lit(1)).alias("n")))


@query
def label_purchase(spark, d):
    return label(spark, d, PURCHASE, form="direct")


@query
def label_purchase_bucketed(spark, d):
    return label(spark, d, PURCHASE)


@query
def label_purchase_actions(spark, d):
    actions = [{"column": "o_orderstatus", "operator": "==", "value": "F"},
               {"column": "o_totalprice", "operator": ">=", "value": 100000}]
    return label(spark, d, replace(PURCHASE, actions=actions))


@query
def label_churn(spark, d):
    return label(spark, d, CHURN)


@query
def label_churn_lead(spark, d):
    return label(spark, d, replace(CHURN, lead=Offset(1), params={"churn_window": 9, "churn_window_unit": "months"}))


@query
def label_value_sum(spark, d):
    return rounded(label(spark, d, value_spec("sum")), 2, "value")


@query
def label_value_mean(spark, d):
    return rounded(label(spark, d, value_spec("mean")), 6, "value")


@query
def label_value_median(spark, d):
    return rounded(label(spark, d, value_spec("median")), 4, "value")


@query
def label_value_std(spark, d):
    return rounded(label(spark, d, value_spec("std")), 2, "value")


@query
def label_value_nunique(spark, d):
    return label(spark, d, LabelSpec("value", prediction=Offset(12), params={
        "value_column": "o_orderpriority", "value_agg": "nunique"}))


def order_items(spark, d) -> DataFrame:
    """Order lines with their order's customer, date and key."""
    head = orders(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, d, "lineitem")
    return lines.join(head, lines.l_orderkey == head.o_orderkey).drop("o_orderkey")


def product_labels_long(spark, d) -> DataFrame:
    part = table(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey")
    spec = LabelSpec("product_purchase", cutoff_num=3, params={
        "product_column": "p_type", "product_list": PRODUCT_TYPES})
    items = product_join(order_items(spark, d), part, "l_partkey")
    return make_labels(items, "o_custkey", "o_orderdate", spec)


@query
def label_product_purchase(spark, d):
    return by_day(product_labels_long(spark, d))


@query
def label_product_purchase_wide(spark, d):
    return by_day(wide_products(product_labels_long(spark, d), "o_custkey", PRODUCT_TYPES, sep="_"))


@query
def label_action_entity(spark, d):
    rows = orders(spark, d).select("o_custkey", "o_orderdate", "o_orderstatus")
    both = with_action_rows(rows.where("o_orderstatus <> 'O'"), rows.where("o_orderstatus = 'O'"))
    return label(spark, d, replace(PURCHASE, actions=[{"column": "is_action", "operator": "==", "value": 1}]), both)


@query
def label_stats_classifier(spark, d):
    return rounded(label_stats(make_labels(orders(spark, d), "o_custkey", "o_orderdate", PURCHASE), "purchase"),
                   8, "share_0", "share_1")


@query
def label_stats_regression(spark, d):
    stats = label_stats(make_labels(orders(spark, d), "o_custkey", "o_orderdate", value_spec("sum")), "value", "regression")
    return rounded(rounded(stats, 6, "mean"), 4, "median")


@query
def label_events_days(spark, d):
    """Purchase label at day scale: events of type purchase in the next 3 days, daily cutoffs."""
    spec = LabelSpec("purchase", sample=Offset(7, "days"), prediction=Offset(3, "days"), lead=Offset(1, "days"),
                     gap=Offset(1, "days"), cutoff_num=10, cutoff_day=20,
                     actions=[{"column": "event_type", "operator": "==", "value": "purchase"}])
    return label(spark, d, spec, table(spark, d, "events"), "user_id", "ts")


@query
def label_stats_pretty(spark, d):
    labels = make_labels(orders(spark, d), "o_custkey", "o_orderdate", PURCHASE)
    return label_stats(labels, "purchase", pretty=True)


# ---- features


def entities(spark, d) -> EntitySet:
    return EntitySet([
        Entity("customer", table(spark, d, "customer"), key="c_custkey", parents=[Parent("nation", "c_nationkey")]),
        Entity("nation", table(spark, d, "nation"), key="n_nationkey", parents=[Parent("region", "n_regionkey")]),
        Entity("region", table(spark, d, "region"), key="r_regionkey"),
        Entity("orders", orders(spark, d), key="o_orderkey", time="o_orderdate", parents=[Parent("customer", "o_custkey")]),
        Entity("lineitem", table(spark, d, "lineitem"), time="l_shipdate", parents=[Parent("orders", "l_orderkey")]),
    ])


def items_entities(spark, d) -> EntitySet:
    items = order_items(spark, d).drop("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return EntitySet([
        Entity("customer", table(spark, d, "customer"), key="c_custkey"),
        Entity("part", table(spark, d, "part"), key="p_partkey"),
        Entity("items", items, time="o_orderdate", parents=[Parent("customer", "o_custkey"), Parent("part", "l_partkey")]),
    ])


def instances(spark, d):
    cutoffs = label_cutoffs(orders(spark, d), "o_orderdate", PURCHASE)
    found = make_labels(orders(spark, d), "o_custkey", "o_orderdate", PURCHASE, cutoffs=cutoffs)
    return found.withColumnRenamed("o_custkey", "c_custkey"), cutoffs


def matrix(spark, d, es: EntitySet, names: list[str], **settings) -> DataFrame:
    """The named features for the purchase instances, with plain column names."""
    rows, cutoffs = instances(spark, d)
    spec = FeatureSpec("customer", only=names, **settings)
    return by_day(with_sql_names(make_features(es, spec, rows, cutoffs)))


@query
def feat_numeric(spark, d):
    names = ["COUNT(orders)"] + [f"{p}(orders.o_totalprice)" for p in ("SUM", "MEAN", "MAX", "MIN", "STD")]
    out = matrix(spark, d, entities(spark, d), names, aggregates=["count", "sum", "mean", "max", "min", "std"], transforms=[])
    out = rounded(out, 2, "sum_orders_o_totalprice", "std_orders_o_totalprice")
    return rounded(out, 6, "mean_orders_o_totalprice")


@query
def feat_include_cutoff(spark, d):
    return matrix(spark, d, entities(spark, d), ["COUNT(orders)"], aggregates=["count"], transforms=[],
                  include_cutoff=True, training_window=None)


@query
def feat_median_skew(spark, d):
    out = matrix(spark, d, entities(spark, d), ["MEDIAN(orders.o_totalprice)", "SKEW(orders.o_totalprice)"],
                 aggregates=["median", "skew"], transforms=[])
    return rounded(out, 4, "median_orders_o_totalprice", "skew_orders_o_totalprice")


@query
def feat_mode(spark, d):
    return matrix(spark, d, entities(spark, d), ["MODE(orders.o_orderpriority)", "MODE(orders.YEAR(o_orderdate))"],
                  aggregates=["mode"], transforms=["year"])


@query
def feat_first_last(spark, d):
    out = matrix(spark, d, entities(spark, d), [
        "FIRST(orders.o_totalprice)", "LAST(orders.o_totalprice)", "LAST(orders.o_orderstatus)"],
        aggregates=["first", "last"], transforms=[])
    return rounded(out, 2, "first_orders_o_totalprice", "last_orders_o_totalprice")


@query
def feat_nunique(spark, d):
    return matrix(spark, d, entities(spark, d), [
        "NUM_UNIQUE(orders.o_orderpriority)", "NUM_UNIQUE(orders.o_orderstatus)"], aggregates=["num_unique"], transforms=[])


@query
def feat_boolean(spark, d):
    es = entities(spark, d)
    flagged = orders(spark, d).select("o_orderkey", "o_custkey", "o_orderdate", F.when(
        F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("is_final"))
    es.add(replace(es["orders"], df=flagged))
    names = [f"{p}(orders.is_final)" for p in ("NUM_TRUE", "PERCENT_TRUE", "ALL", "ANY")]
    out = matrix(spark, d, es, names, aggregates=["num_true", "percent_true", "all", "any"], transforms=[])
    return rounded(out, 6, "percent_true_orders_is_final")


@query
def feat_entropy(spark, d):
    return rounded(matrix(spark, d, entities(spark, d), ["ENTROPY(orders.o_orderpriority)"], aggregates=["entropy"],
                          transforms=[]), 6, "entropy_orders_o_orderpriority")


@query
def feat_time(spark, d):
    names = [f"{p}(orders.o_orderdate)" for p in (
        "TIME_SINCE_FIRST", "TIME_SINCE_LAST", "AVG_TIME_BETWEEN", "DAYS_SINCE_LAST")] + ["MONTH_OF_CUTOFF_POINT"]
    out = matrix(spark, d, entities(spark, d), names, transforms=[], aggregates=[
        "time_since_first", "time_since_last", "avg_time_between", "days_since_last", "month_of_cutoff_point"])
    return rounded(out, 4, "avg_time_between_orders_o_orderdate")


@query
def feat_trend(spark, d):
    out = matrix(spark, d, entities(spark, d), ["TREND(orders.o_totalprice)"], aggregates=["trend"], transforms=[])
    return out.select("c_custkey", "time", F.round(F.col("trend_orders_o_totalprice") * 365.2425, 2).alias("trend_per_year"))


@query
def feat_n_most_common(spark, d):
    out = matrix(spark, d, entities(spark, d), ["N_MOST_COMMON(orders.o_orderpriority)"], aggregates=["n_most_common"],
                 transforms=[])
    return out.withColumn("n_most_common_orders_o_orderpriority",
                          F.array_join("n_most_common_orders_o_orderpriority", "|"))


@query
def feat_transforms(spark, d):
    parts = ["second", "minute", "weekday", "is_weekend", "hour", "day", "week", "month", "year"]
    shifted = (F.col("value") - 50).alias("value")
    rows = table(spark, d, "events").select("event_id", "ts", shifted)
    return rows.select("event_id", *[TRANSFORMS[p].build(F.col("ts")).alias(p) for p in parts],
                       F.round(TRANSFORMS["absolute"].build(F.col("value")), 4).alias("absolute"))


@query
def feat_diff(spark, d):
    rows = previous_row(orders(spark, d), "o_custkey", "o_orderdate", ["o_orderkey"], {"before": "o_totalprice"})
    return rows.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("before"), 2).alias("diff"))


@query
def feat_time_since_previous(spark, d):
    rows = previous_row(table(spark, d, "events"), "user_id", "ts", ["event_id"], {"before": "ts"})
    return rows.select("event_id", F.round(seconds_between(F.col("before"), F.col("ts")), 6).alias("seconds"))


@query
def feat_percentile(spark, d):
    rows = percentile_rank(table(spark, d, "lineitem").select("l_quantity"), "l_quantity", "percentile")
    return rows.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("percentile"), 8).alias("percentile"))


@query
def feat_time_since(spark, d):
    out = matrix(spark, d, entities(spark, d), [
        "MEAN(orders.TIME_SINCE(o_orderdate))", "MAX(orders.TIME_SINCE(o_orderdate))"],
        aggregates=["mean", "max"], transforms=["time_since"])
    return rounded(out, 3, "mean_orders_time_since_o_orderdate", "max_orders_time_since_o_orderdate")


@query
def feat_where_manual(spark, d):
    es = items_entities(spark, d).with_interesting({"part": {"p_type": ["PROMO"]}, "items": {"l_returnflag": ["R"]}})
    out = matrix(spark, d, es, [
        "COUNT(items WHERE part.p_type = PROMO)", "SUM(items.l_extendedprice WHERE part.p_type = PROMO)",
        "COUNT(items WHERE l_returnflag = R)"], aggregates=[], transforms=[])
    return rounded(out, 2, "sum_items_l_extendedprice_where_part_p_type_promo")


@query
def feat_where_auto(spark, d):
    es = auto_interesting(entities(spark, d), 2, skip=["customer", "nation", "region", "lineitem"])
    rows, cutoffs = instances(spark, d)
    spec = FeatureSpec("customer", aggregates=[], transforms=[], where=["count"], ignore_entities=["nation", "lineitem"],
                       ignore_columns={"customer": ["c_name", "c_acctbal", "c_mktsegment"]})
    wide = make_features(es, spec, rows, cutoffs)
    names = [c for c in wide.columns if "WHERE" in c]
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("n")) for c in names]))
    # value names come from the data, so the result is long
    return by_day(wide.select("c_custkey", "time", cells))


@query
def interesting_values(spark, d):
    found = frequent_values(table(spark, d, "part"), ["p_type", "p_brand", "p_name"], 4)
    return rounded(found, 8, "share")


@query
def feat_depth2(spark, d):
    out = matrix(spark, d, entities(spark, d), [
        "LAST(orders.MONTH(o_orderdate))", "NUM_UNIQUE(orders.MONTH(o_orderdate))", "MEAN(orders.DIFF(o_totalprice))",
        "MEAN(orders.SUM(lineitem.l_quantity))"],
        aggregates=["last", "num_unique", "mean", "sum"], transforms=["month", "diff"])
    return rounded(out, 6, "mean_orders_diff_o_totalprice", "mean_orders_sum_lineitem_l_quantity")


@query
def feat_parent_mode(spark, d):
    return matrix(spark, d, items_entities(spark, d), ["MODE(items.part.p_type)", "NUM_UNIQUE(items.part.p_brand)"],
                  aggregates=["mode", "num_unique"], transforms=[])


@query
def feat_direct(spark, d):
    return matrix(spark, d, entities(spark, d), ["nation.n_name", "c_mktsegment", "c_acctbal", "MONTH_OF_CUTOFF_POINT"],
                  aggregates=["month_of_cutoff_point"], transforms=[])


@query
def feat_drop_id_like(spark, d):
    wide = matrix(spark, d, entities(spark, d), ["c_name", "c_mktsegment", "nation.n_name", "MODE(orders.o_orderpriority)"],
                  aggregates=["mode"], transforms=[])
    dropped = id_like_columns(wide, ["c_custkey", "time"])
    names = [c for c in wide.columns if c not in ("c_custkey", "time")]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v"), F.lit(c in dropped).alias("dropped"))
        for c in names]))).groupBy("column_name", "dropped").agg(F.count("v").alias("n"))


@query
def feature_list(spark, d):
    """Index and name of every feature with the number of rows that have a value."""
    names = ["COUNT(orders)", "LAST(orders.o_totalprice)", "MEAN(orders.o_totalprice)", "STD(orders.o_totalprice)"]
    rows, cutoffs = instances(spark, d)
    wide = make_features(entities(spark, d), FeatureSpec(
        "customer", only=names, aggregates=["count", "last", "mean", "std"], transforms=[]), rows, cutoffs)
    counted = wide.agg(*[F.count(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("index"), F.lit(n).alias("feature_name"), F.col(f"c{i}").alias("n"))
        for i, n in enumerate(names)])))


@query
def feat_null_cutoff(spark, d):
    """Every order date of a customer is a cutoff of its own, far more than a thousand, and one is absent."""
    seen = orders(spark, d).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("time")).distinct()
    absent = seen.select("c_custkey", F.lit(None).cast("timestamp_ntz").alias("time")).distinct()
    spec = FeatureSpec("customer", only=["COUNT(orders)"], aggregates=["count"], transforms=[], training_window=None)
    return by_day(with_sql_names(make_features(entities(spark, d), spec, absent.unionByName(seen))))


@query
def id_like_integers(spark, d):
    rows = orders(spark, d).select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("o_year"))
    dropped = id_like_columns(rows, ["o_custkey"], kind="integer")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("v"), F.lit(c in dropped).alias("dropped"))
             for c in ("o_orderkey", "o_year")]
    return rows.select(F.inline(F.array(*cells))).groupBy("column_name", "dropped").agg(F.count("v").alias("n"))


@query
def aligned_columns(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return tr.align_columns(rows, [("c_custkey", "string"), ("absent", "double"), ("c_acctbal", "double")])


@query
def custom_primitive(spark, d):
    register_aggregate(Aggregate("range", "numeric", route="pairs", expr=lambda x, t, time: F.max(x) - F.min(x)))
    register_aggregate(Aggregate("mean_of_ends", "numeric", needs=("min", "max"),
                                 finish=lambda p, time: (p["min"] + p["max"]) / 2 + F.month(time)))
    out = matrix(spark, d, entities(spark, d), ["RANGE(orders.o_totalprice)", "MEAN_OF_ENDS(orders.o_totalprice)"],
                 aggregates=["range", "mean_of_ends"], transforms=[])
    return rounded(out, 3, "range_orders_o_totalprice", "mean_of_ends_orders_o_totalprice")


@query
def custom_label(spark, d):
    register_label("big_spender", LabelFunction(
        partials=lambda spec, t: {"spent": F.sum("o_totalprice")},
        merges=lambda spec: {"spent": F.sum(F.when(F.col("in_pred"), F.col("spent")))},
        finish=lambda spec: {"big_spender": F.coalesce((F.col("spent") > spec.params["limit"]).cast("int"), F.lit(0))}))
    return label(spark, d, LabelSpec("big_spender", prediction=Offset(6), params={"limit": BIG_SPEND}))


# ---- training tables


def purchase_labels(spark, d) -> DataFrame:
    return make_labels(orders(spark, d), "o_custkey", "o_orderdate", PURCHASE)


@query
def train_matrix(spark, d):
    names = ["COUNT(orders)", "LAST(orders.o_orderstatus)", "c_mktsegment"]
    rows, cutoffs = instances(spark, d)
    wide = with_sql_names(make_features(entities(spark, d), FeatureSpec(
        "customer", only=names, aggregates=["count", "last"], transforms=[], training_window=Offset(6)), rows, cutoffs))
    joined = tr.train_matrix(wide, rows.select("c_custkey", "time", "purchase"), "c_custkey")
    return by_day(tr.training_columns(joined, ["c_custkey", "time", "purchase"]))


@query
def split_last_time(spark, d):
    return by_day(tr.split_by_last_time(purchase_labels(spark, d)).groupBy("time", "is_test").agg(
        F.count(F.lit(1)).alias("n")))


@query
def split_by_id(spark, d):
    return by_day(tr.split_by_id(purchase_labels(spark, d), "o_custkey"), "o_custkey", "time", "is_test")


@query
def split_by_id_exact(spark, d):
    return by_day(tr.split_by_id(purchase_labels(spark, d), "o_custkey", exact=True), "o_custkey", "time", "is_test")


@query
def split_stratified(spark, d):
    return by_day(tr.split_stratified(purchase_labels(spark, d), "o_custkey", "purchase"),
                  "o_custkey", "time", "purchase", "is_test")


@query
def class_weight(spark, d):
    return rounded(tr.class_weight(purchase_labels(spark, d), "purchase", threshold=5.0), 8, "weight")


@query
def train_guards(spark, d):
    return tr.train_guards(tr.split_by_last_time(purchase_labels(spark, d)), "purchase")


# ---- ranking and evaluation


def scored_orders(spark, d) -> DataFrame:
    """Orders as scored rows: positive if final, the price as the score."""
    return orders(spark, d).select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / 600000.0).alias("prediction"))


def predicted_orders(spark, d) -> DataFrame:
    return orders(spark, d).select(
        "o_orderkey", F.col("o_totalprice").alias("y"),
        (F.col("o_totalprice") * (0.5 + (F.col("o_orderkey") % 100) / 100.0)).alias("prediction"))


@query
def rank_first(spark, d):
    ranked = with_rank(table(spark, d, "events").select("event_id", "user_id"), "user_id", "event_id")
    return ranked.select("event_id", "rank", "rank_total")


@query
def decile(spark, d):
    return with_deciles(scored_orders(spark, d), "prediction", "o_orderkey").select("o_orderkey", "decile")


@query
def threshold_label(spark, d):
    rows = scored_orders(spark, d)
    rate = rows.agg(F.avg("y")).first()[0]
    cut = exact_quantiles(rows, "prediction", {"q": 1 - rate}).first()["q"]
    return tr.with_label(rows, threshold=cut).select("o_orderkey", F.col("label"))


@query
def top_share_label(spark, d):
    return tr.with_label(scored_orders(spark, d), top_share=0.3).select("o_orderkey", "label")


@query
def auc(spark, d):
    return rounded(ev.auc(scored_orders(spark, d), "y", "prediction"), 8, "auc")


@query
def confusion_matrix(spark, d):
    return ev.confusion_matrix(scored_orders(spark, d), "y", "prediction")


@query
def roc_points(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity")
    return rounded(ev.roc_points(rows, "y", "l_quantity"), 8, "fpr", "tpr")


@query
def cumulative_gain(spark, d):
    return rounded(ev.cumulative_gain(scored_orders(spark, d), "y", "prediction", "o_orderkey"), 8, "percentage", "gain")


@query
def profit_report_classifier(spark, d):
    return rounded(ev.profit_report_classifier(scored_orders(spark, d), "y", "prediction"), 8, "precision", "recall", "lift")


@query
def profit_report_regression(spark, d):
    report = ev.profit_report_regression(predicted_orders(spark, d), "y", "prediction", "o_orderkey")
    return rounded(rounded(report, 2, "cul_sum", "cul_avg"), 8, "recall", "lift")


@query
def gain_regression(spark, d):
    return rounded(ev.gain_regression(predicted_orders(spark, d), "y", "prediction", "o_orderkey"), 8, "gains")


@query
def regression_metrics(spark, d):
    return rounded(rounded(ev.regression_metrics(predicted_orders(spark, d), "y", "prediction"), 8, "r2"), 2, "mae", "mse")


@query
def prediction_pairs(spark, d):
    return rounded(ev.prediction_pairs(predicted_orders(spark, d), "y", "prediction"), 6, "true", "pred")


@query
def error_share(spark, d):
    rows = predicted_orders(spark, d)
    near = ev.absolute_error_share(rows, "y", "prediction", ERROR_BOUNDS).select(
        F.lit("absolute").alias("kind"), F.col("error").alias("bound"), "precision")
    rates = [0.05 + 0.1 * i for i in range(6)]
    share = ev.relative_error_share(rows, "y", "prediction", rates).select(
        F.lit("relative").alias("kind"), F.col("error_rate").alias("bound"), "precision")
    return rounded(near.unionByName(share), 8, "bound", "precision")


@query
def error_cdf(spark, d):
    rows = predicted_orders(spark, d).select((F.col("y") - F.col("prediction")).alias("error"))
    return rounded(ev.error_cdf(rows, "error"), 4, "error")


@query
def evaluation_summary(spark, d):
    rows = tr.split_by_id(scored_orders(spark, d), "o_orderkey").withColumn(
        "split", F.when(F.col("is_test"), "test").otherwise("train"))
    return rounded(ev.evaluation_summary(rows, "split", "y", "prediction", "classifier"), 8, "value")


@query
def evaluation_by_customer_group(spark, d):
    """AUC of each nation and cutoff, all in one pass; more groups than a loop could take."""
    rows = purchase_labels(spark, d).join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    rows = rows.withColumn("prediction", F.pmod("o_custkey", F.lit(7)) / 7.0)
    out = ev.evaluation_summary(rows, ["c_nationkey", "time"], "purchase", "prediction", "classifier")
    return rounded(out.withColumn("time", F.date_format("time", "yyyy-MM-dd")), 8, "value")


@query
def evaluation_by_cutoff(spark, d):
    """Gain over a matrix with several cutoffs per key and many equal scores: key and cutoff break the ties."""
    rows = purchase_labels(spark, d).withColumn("prediction", F.pmod("o_custkey", F.lit(7)) / 7.0)
    return rounded(ev.cumulative_gain(rows, "purchase", "prediction", ["o_custkey", "time"]), 8, "percentage", "gain")


# ---- comments


def comments(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("oid"), F.col("text").alias("content"), "lang",
        F.col("n_chars").alias("created"))


def online_orders(spark, d) -> DataFrame:
    return orders(spark, d).where("o_orderstatus = 'O' and o_orderdate > '1996-12-31'").select(
        F.col("o_orderkey").alias("oid"), F.col("o_orderpriority").alias("category"))


def processed(spark, d) -> DataFrame:
    return table(spark, d, "labels").select(F.col("doc_id").alias("oid"))


@query
def comment_new(spark, d):
    fresh = new_comments(comments(spark, d), processed(spark, d), online_orders(spark, d))
    return fresh.select("oid", "created", "category", F.md5("content").alias("content_md5"))


@query
def comment_words(spark, d):
    words = word_rows(spread(comments(spark, d)), "content", STOP_WORDS)
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query
def word_explode_incremental(spark, d):
    fresh = new_comments(comments(spark, d), processed(spark, d), begin=100)
    words = word_rows(fresh, "content", STOP_WORDS)
    return words.groupBy("oid", "word").agg(F.count(F.lit(1)).alias("n"))


@query
def comment_flow(spark, d):
    """The words of new comments, through the flow that fills the word table."""
    words = comment_words_flow(comments(spark, d), processed(spark, d), stop_words=STOP_WORDS, begin=100)
    return words.groupBy("oid", "word").agg(F.count(F.lit(1)).alias("n"))


@query
def comment_batches(spark, d):
    """The word table after two batches, the second of which runs twice, as after a failure."""
    name, rows = f"cutline_words_{uuid.uuid4().hex}", comments(spark, d)
    comment_job(spark, rows.where("created < 2000"), name, stop_words=STOP_WORDS, batch="early")
    for _ in range(2):
        comment_job(spark, rows, name, stop_words=STOP_WORDS, batch="all")
    words = checkpointed(counted_words(spark.table(name), "batch", "oid", "word"))
    spark.sql(f"DROP TABLE {name}")
    return words


# fixed values: one CJK character per letter, to write the documents without word gaps
LATIN, IDEOGRAPHS = "abcdefghijklmnopqrstuvwxyz", "一丁七万丈三上下不与丐丑专且丕世丘丙业丛东丝丞丢两严"


@query
def comment_words_dictionary(spark, d):
    """Dictionary segmentation of the documents written without gaps, in one CJK character per letter."""
    plain = F.translate(F.lower(F.col("content")), LATIN, IDEOGRAPHS)
    rows = spread(comments(spark, d))
    dense = rows.select("oid", F.regexp_replace(plain, r"\s+", "").alias("content"))
    counts = rows.select(F.explode(letter_words(F.col("content"))).alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).alias("frequency"))
    dictionary = counts.select(F.translate("w", LATIN, IDEOGRAPHS).alias("word"), "frequency")
    cut = dictionary_words(dense, "content", dictionary, "words")
    return cut.select("oid", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"))


# ---- jobs and models


@query
def sql_template_union(spark, d):
    orders(spark, d).createOrReplaceTempView("cutline_orders")
    template = """
        SELECT '{brand_nick}' AS brand, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM cutline_orders WHERE o_orderstatus = '{brand_nick}' GROUP BY o_orderpriority"""
    return union_over(spark, template, ["F", "O", "P"])


@query
def sql_script(spark, d):
    orders(spark, d).createOrReplaceTempView("cutline_script_orders")
    return run_sql(spark, """
        CREATE OR REPLACE TEMP VIEW cutline_late AS
        SELECT * FROM cutline_script_orders WHERE o_orderdate >= timestamp_ntz'2000-01-01 00:00:00';
        SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM cutline_late GROUP BY o_orderstatus;
    """)


def small_model_config(problem: str) -> dict:
    """A configuration document over the given tables; few rounds keep it short."""
    window = {"sample_filtering_window": {"sample_filtering_window": 12, "sample_filtering_window_unit": "months"},
              "lead_time_window": {"lead_time_window": 0, "lead_time_window_unit": "days"},
              "prediction_window": {"prediction_window": 3, "prediction_window_unit": "months"},
              "training_window": {"training_window": 12, "training_window_unit": "months"}}
    target = {"value_para": {"value_column": "o_totalprice", "value_agg": "sum"}} if problem == "value" else {}
    return {
        "business_desc": {"problem_type": problem, "customer_entity": "customer", "behavior_entity": "orders",
                          "target_definition": target},
        "label_desc": {"cutoff_point": {"cutoff_day": 1, "cutoff_num": 3}, **window},
        "entity_set_desc": [
            {"entity_name": "customer", "index": ["c_custkey"], "parent_entity": [{"entity_name": "nation", "join_column": "c_nationkey"}]},
            {"entity_name": "nation", "index": ["n_nationkey"]},
            {"entity_name": "orders", "index": ["o_orderkey"], "time_index": "o_orderdate",
             "parent_entity": [{"entity_name": "customer", "join_column": "o_custkey"}]}],
        "feature_extraction_desc": {"agg_primitives": ["Count", "Mean", "Last", "TimeSinceLast"], "trans_primitives": ["Month"]},
        "model_desc": {"model_para": {"iterations": 5, "depth": 3, "learning_rate": 0.3}},
    }


def tables(spark, d) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in ("customer", "nation", "orders")}


@query
def train_classifier(spark, d):
    result = train_flow(spark, small_model_config("purchase"), tables(spark, d), with_evaluation=False)
    return by_day(tr.raw_scores(result.models[None], result.features))


@query
def train_regressor(spark, d):
    result = train_flow(spark, small_model_config("value"), tables(spark, d), with_evaluation=False)
    return by_day(tr.raw_scores(result.models[None], result.features))


@query
def predict_job(spark, d):
    config = small_model_config("purchase")
    models = train_flow(spark, config, tables(spark, d), with_evaluation=False).models
    return predict_flow(spark, config, models, tables(spark, d)).withColumn("cutoff", F.date_format("cutoff", "yyyy-MM-dd"))


@query
def flow_resume(spark, d):
    """Labels and matrix of a training run, read back from the folder that the first run filled."""
    folder, config = f"{shared_folder(spark)}/flow-{uuid.uuid4().hex}", small_model_config("purchase")
    train_flow(spark, config, tables(spark, d), folder, with_evaluation=False)
    again = train_flow(spark, config, tables(spark, d), folder, with_evaluation=False, resume=True)
    joined = again.labels.join(again.features, ["c_custkey", "time"])
    return by_day(joined, "c_custkey", "time", "purchase", "count_orders")


@query
def flow_snapshot(spark, d):
    """Labels and matrix over entities that were written first, taken over by a second run."""
    folder, config = f"{shared_folder(spark)}/flow-{uuid.uuid4().hex}", small_model_config("purchase")
    for resume in (False, True):
        run = train_flow(spark, config, tables(spark, d), folder, with_evaluation=False, resume=resume, snapshot=True)
    joined = run.labels.join(run.features, ["c_custkey", "time"])
    return by_day(joined, "c_custkey", "time", "purchase", "count_orders")


@query
def snapshot_merge(spark, d):
    """The last order of each customer: a snapshot of the early orders that takes in the others by high-water mark."""
    folder, rows = f"{shared_folder(spark)}/snapshot-{uuid.uuid4().hex}", orders(spark, d).select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    for source in (rows.where("o_orderdate < '1997-01-01'"), rows, rows):
        out = refresh_snapshot(source, folder, "o_custkey", "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_date"), "o_orderkey", "o_totalprice")


@query
def predict_job_rows(spark, d):
    """Who is scored at which cutoff, and the positive rate of the training labels."""
    return predict_job(spark, d).select("c_custkey", "cutoff", F.round("train_pos_rate", 8).alias("train_pos_rate"))


@query
def feature_importance(spark, d):
    result = train_flow(spark, small_model_config("purchase"), tables(spark, d), with_evaluation=False)
    return tr.feature_importance(result.models[None], spark)
