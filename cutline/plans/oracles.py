"""DuckDB SQL that gives the result of each registered query on the same tables."""

from __future__ import annotations

from cutline.plans.queries import BIG_SPEND, ERROR_BOUNDS, PRODUCT_TYPES, STOP_WORDS

ORACLES: dict[str, str] = {}

DAY = "strftime({0}, '%Y-%m-%d')"


def text_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---- loading and clean-up

ORACLES["standardize_types"] = r"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS as_number,
       event_type = 'click' AS clicked, CAST(user_id AS VARCHAR) AS user_text
FROM events"""

ORACLES["min_date_null"] = """
SELECT o_orderkey, CASE WHEN o_orderdate - INTERVAL 98 YEAR > TIMESTAMP '1900-01-01'
       THEN strftime(o_orderdate - INTERVAL 98 YEAR, '%Y-%m-%d') END AS seen
FROM orders"""

ORACLES["exclude_values"] = """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"""

ORACLES["data_dictionary"] = """
SELECT c_custkey AS customer_id, c_name AS name, round(c_acctbal, 2) AS balance,
       last_value(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END IGNORE NULLS)
           OVER (ORDER BY c_custkey ROWS UNBOUNDED PRECEDING) AS segment,
       'basic' AS grade, 'main' AS shop
FROM customer"""

ORACLES["keep_last_by_key"] = """
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos FROM orders)
WHERE pos = 1"""

ORACLES["incremental_scan"] = """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY l_returnflag"""

ORACLES["virtual_parent"] = """
SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_o_orderdate FROM orders GROUP BY o_custkey"""

ORACLES["parent_lookup"] = """
SELECT c_custkey, n_name AS nation_n_name, r_name AS nation_region_r_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

ORACLES["key_semi_join"] = """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"""

# ---- labels

ORDER_EVENTS = "SELECT o_custkey AS k, o_orderdate AS t, o_totalprice AS v, TRUE AS ok FROM orders"


def label_ctes(events=ORDER_EVENTS, sample="12 MONTH", lead="0 DAY", pred="1 MONTH", n=12, cutoffs=None) -> str:
    """ev, cuts, w (event x cutoff with flags) and inst (instances)."""
    cutoffs = cutoffs or f"""
        SELECT date_trunc('month', mx - INTERVAL {pred} - INTERVAL {lead})::TIMESTAMP - to_months(CAST(i AS INTEGER)) AS c
        FROM (SELECT max(t) AS mx FROM ev), range({n}) r(i)"""
    return f"""
WITH ev AS ({events}),
cuts AS ({cutoffs}),
w AS (SELECT ev.*, c, t < c AS in_sample, t >= c AND t < c + INTERVAL {lead} AS in_lead,
             t >= c + INTERVAL {lead} AND ok AS hit, t >= c + INTERVAL {lead} AS in_pred
      FROM ev JOIN cuts ON t >= c - INTERVAL {sample} AND t < c + INTERVAL {lead} + INTERVAL {pred}),
inst AS (SELECT k, c FROM w WHERE in_sample GROUP BY k, c)"""


def label_sql(column: str, name: str, aggregate_sql: str, key="o_custkey", **ctes) -> str:
    return label_ctes(**ctes) + f""",
a AS (SELECT k, c, {aggregate_sql}, count(CASE WHEN in_sample THEN 1 END) AS active FROM w GROUP BY k, c)
SELECT k AS {key}, strftime(c, '%Y-%m-%d') AS time, {column} AS {name} FROM a WHERE active > 0"""


HIT = "max(CASE WHEN hit THEN 1 ELSE 0 END) AS got"
PURCHASE = label_sql("got", "purchase", HIT)

ORACLES["cutoff_schedule"] = """
WITH m AS (SELECT max(o_orderdate) - INTERVAL 1 MONTH AS lim FROM orders),
first_cut AS (SELECT CASE WHEN day(lim) < 31 THEN last_day(lim - INTERVAL 1 MONTH)::TIMESTAMP ELSE lim END AS c FROM m),
c1 AS (SELECT c AS c0, c - INTERVAL 1 MONTH AS c1 FROM first_cut),
c2 AS (SELECT *, c1 - INTERVAL 1 MONTH AS c2 FROM c1), c3 AS (SELECT *, c2 - INTERVAL 1 MONTH AS c3 FROM c2),
c4 AS (SELECT *, c3 - INTERVAL 1 MONTH AS c4 FROM c3), c5 AS (SELECT *, c4 - INTERVAL 1 MONTH AS c5 FROM c4),
cuts AS (SELECT unnest([c0, c1, c2, c3, c4, c5]) AS c FROM c5)
SELECT strftime(c, '%Y-%m-%d') AS time, count(*) AS n
FROM orders JOIN cuts ON o_orderdate >= c - INTERVAL 12 MONTH AND o_orderdate < c GROUP BY c"""

ORACLES["label_purchase"] = PURCHASE
ORACLES["label_purchase_bucketed"] = PURCHASE
ORACLES["label_purchase_actions"] = label_sql("got", "purchase", HIT, events=ORDER_EVENTS.replace(
    "TRUE AS ok", "o_orderstatus = 'F' AND o_totalprice >= 100000 AS ok"))

SEEN = """max(CASE WHEN in_sample OR in_lead THEN t END) AS last_seen, min(CASE WHEN hit THEN t END) AS back"""
CHURN = """CASE WHEN last_seen + INTERVAL {window} > c + INTERVAL {lead} + INTERVAL {pred} THEN 0
    WHEN back < last_seen + INTERVAL {window} THEN 0 ELSE 1 END"""
ORACLES["label_churn"] = label_sql(
    CHURN.format(window="12 MONTH", lead="0 DAY", pred="12 MONTH"), "churn", SEEN, pred="12 MONTH")
ORACLES["label_churn_lead"] = label_sql(
    CHURN.format(window="9 MONTH", lead="1 MONTH", pred="12 MONTH"), "churn", SEEN, pred="12 MONTH", lead="1 MONTH")

for how, expression, digits in [
    ("sum", "sum(CASE WHEN hit THEN v END)", 2), ("mean", "avg(CASE WHEN hit THEN v END)", 6),
    ("median", "median(CASE WHEN hit THEN v END)", 4),
]:
    ORACLES[f"label_value_{how}"] = label_sql(
        f"round(coalesce(got, 0.0), {digits})", "value", expression + " AS got", pred="12 MONTH")
ORACLES["label_value_std"] = label_sql(
    "CASE WHEN n > 0 THEN round(got, 2) ELSE 0.0 END", "value",
    "stddev_samp(CASE WHEN hit THEN v END) AS got, count(CASE WHEN hit THEN v END) AS n", pred="12 MONTH")
ORACLES["label_value_nunique"] = label_sql(
    "CAST(got AS DOUBLE)", "value", "count(DISTINCT CASE WHEN hit THEN v END) AS got", pred="12 MONTH",
    events=ORDER_EVENTS.replace("o_totalprice AS v", "o_orderpriority AS v"))

PRODUCT_EVENTS = """SELECT o_custkey AS k, o_orderdate AS t, p_type AS v, TRUE AS ok
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
PRODUCTS = label_ctes(events=PRODUCT_EVENTS, n=3)
ORACLES["label_product_purchase"] = PRODUCTS + f""",
bought AS (SELECT DISTINCT k, c, v FROM w WHERE hit),
listed AS (SELECT unnest([{text_list(PRODUCT_TYPES)}]) AS product)
SELECT i.k AS o_custkey, strftime(i.c, '%Y-%m-%d') AS time, product,
       CAST(b.v IS NOT NULL AS INTEGER) AS product_purchase
FROM inst i CROSS JOIN listed LEFT JOIN bought b ON b.k = i.k AND b.c = i.c AND b.v = product"""
ORACLES["label_product_purchase_wide"] = PRODUCTS + """,
bought AS (SELECT k, c, """ + ", ".join(
    f"max(CAST(v = '{p}' AS INTEGER)) AS g{i}" for i, p in enumerate(PRODUCT_TYPES)) + """ FROM w WHERE hit GROUP BY k, c)
SELECT i.k AS o_custkey, strftime(i.c, '%Y-%m-%d') AS time, """ + ", ".join(
    f"coalesce(g{i}, 0) AS product_purchase_{p}" for i, p in enumerate(PRODUCT_TYPES)) + """
FROM inst i LEFT JOIN bought b ON b.k = i.k AND b.c = i.c"""

ORACLES["label_action_entity"] = label_sql("got", "purchase", HIT, events=ORDER_EVENTS.replace(
    "TRUE AS ok", "o_orderstatus = 'O' AS ok"))

ORACLES["label_events_days"] = label_sql(
    "got", "purchase", HIT, key="user_id", sample="7 DAY", lead="1 DAY", pred="3 DAY",
    events="SELECT user_id AS k, ts AS t, value AS v, event_type = 'purchase' AS ok FROM events",
    cutoffs="""
        SELECT CASE WHEN day(lim) < 20 THEN lim - INTERVAL 1 MONTH ELSE lim END
               + to_days(CAST(20 - day(lim) - i AS INTEGER)) AS c
        FROM (SELECT date_trunc('day', max(t) - INTERVAL 4 DAY)::TIMESTAMP AS lim FROM ev), range(10) r(i)""")

ORACLES["label_stats_classifier"] = f"""
WITH l AS ({PURCHASE})
SELECT coalesce(time, 'All') AS time, count(*) AS n, round(avg(CAST(purchase = 0 AS INTEGER)), 8) AS share_0,
       round(avg(purchase), 8) AS share_1
FROM l GROUP BY ROLLUP (time)"""
ORACLES["label_stats_regression"] = f"""
WITH l AS ({label_sql("coalesce(got, 0.0)", "value", "sum(CASE WHEN hit THEN v END) AS got", pred="12 MONTH")})
SELECT coalesce(time, 'All') AS time, count(*) AS n, round(avg(value), 6) AS mean, round(median(value), 4) AS median
FROM l GROUP BY ROLLUP (time)"""

# ---- features


def feature_sql(picks: str, source="orders", extra="", past="f.o_orderdate < c AND f.o_orderdate >= c - INTERVAL 24 MONTH",
                ctes="") -> str:
    """``picks`` aggregates over f, the customer's source rows before each cutoff."""
    return label_ctes() + ctes + f"""
SELECT i.k AS c_custkey, strftime(i.c, '%Y-%m-%d') AS time, {picks}
FROM inst i LEFT JOIN {source} f ON f.o_custkey = i.k AND {past} {extra}
GROUP BY i.k, i.c"""


ORACLES["feat_numeric"] = feature_sql("""
    count(f.o_orderkey) AS count_orders, round(coalesce(sum(f.o_totalprice), 0), 2) AS sum_orders_o_totalprice,
    round(avg(f.o_totalprice), 6) AS mean_orders_o_totalprice, max(f.o_totalprice) AS max_orders_o_totalprice,
    min(f.o_totalprice) AS min_orders_o_totalprice, round(stddev_samp(f.o_totalprice), 2) AS std_orders_o_totalprice""")
ORACLES["feat_include_cutoff"] = feature_sql("count(f.o_orderkey) AS count_orders", past="f.o_orderdate <= c")
ORACLES["feat_median_skew"] = feature_sql("""
    round(median(f.o_totalprice), 4) AS median_orders_o_totalprice,
    round(skewness(f.o_totalprice), 4) AS skew_orders_o_totalprice""")


def mode_ctes(value: str, name: str, source="orders") -> str:
    """Most frequent value per instance, the smallest on ties."""
    return f""",
{name} AS (SELECT k, c, x FROM (
    SELECT k, c, x, row_number() OVER (PARTITION BY k, c ORDER BY count(*) DESC, x) AS pos
    FROM (SELECT i.k, i.c, {value} AS x FROM inst i JOIN {source} f ON f.o_custkey = i.k
          AND f.o_orderdate < c AND f.o_orderdate >= c - INTERVAL 24 MONTH)
    WHERE x IS NOT NULL GROUP BY k, c, x) WHERE pos = 1)"""


ORACLES["feat_mode"] = label_ctes() + mode_ctes("f.o_orderpriority", "m1") + mode_ctes(
    "CAST(year(f.o_orderdate) AS INTEGER)", "m2") + """
SELECT i.k AS c_custkey, strftime(i.c, '%Y-%m-%d') AS time, m1.x AS mode_orders_o_orderpriority,
       m2.x AS mode_orders_year_o_orderdate
FROM inst i LEFT JOIN m1 ON m1.k = i.k AND m1.c = i.c LEFT JOIN m2 ON m2.k = i.k AND m2.c = i.c"""
ORACLES["feat_first_last"] = feature_sql("""
    round(first(f.o_totalprice ORDER BY f.o_orderdate, f.o_orderkey), 2) AS first_orders_o_totalprice,
    round(first(f.o_totalprice ORDER BY f.o_orderdate DESC, f.o_orderkey DESC), 2) AS last_orders_o_totalprice,
    first(f.o_orderstatus ORDER BY f.o_orderdate DESC, f.o_orderkey DESC) AS last_orders_o_orderstatus""")
ORACLES["feat_nunique"] = feature_sql("""
    count(DISTINCT f.o_orderpriority) AS num_unique_orders_o_orderpriority,
    count(DISTINCT f.o_orderstatus) AS num_unique_orders_o_orderstatus""")
ORACLES["feat_boolean"] = feature_sql("""
    count(CASE WHEN b THEN 1 END) AS num_true_orders_is_final,
    round(coalesce(count(CASE WHEN b THEN 1 END) / nullif(count(f.o_orderkey), 0), 0), 6) AS percent_true_orders_is_final,
    bool_and(b) AS all_orders_is_final, bool_or(b) AS any_orders_is_final""", source="flagged", ctes=""",
flagged AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS b FROM orders)""")
ORACLES["feat_entropy"] = feature_sql(
    "CASE WHEN count(f.o_orderkey) > 0 THEN round(entropy(f.o_orderpriority) * ln(2), 6) END AS entropy_orders_o_orderpriority")
ORACLES["feat_time"] = feature_sql("""
    date_diff('microsecond', min(f.o_orderdate), c) / 1e6 AS time_since_first_orders_o_orderdate,
    date_diff('microsecond', max(f.o_orderdate), c) / 1e6 AS time_since_last_orders_o_orderdate,
    round(date_diff('microsecond', min(f.o_orderdate), max(f.o_orderdate)) / 1e6 / nullif(count(f.o_orderdate) - 1, 0), 4)
        AS avg_time_between_orders_o_orderdate,
    CAST(floor(date_diff('microsecond', max(f.o_orderdate), c) / 1e6 / 86400) AS BIGINT) AS days_since_last_orders_o_orderdate,
    CAST(month(c) AS INTEGER) AS month_of_cutoff_point""")
ORACLES["feat_trend"] = feature_sql("""
    CASE WHEN count(DISTINCT f.o_orderdate) > 1 THEN round(365.2425 * regr_slope(f.o_totalprice,
        date_diff('microsecond', TIMESTAMP '2000-01-01', f.o_orderdate) / 86400e6), 2) END AS trend_per_year""")
ORACLES["feat_n_most_common"] = label_ctes() + """,
counted AS (SELECT i.k, i.c, f.o_orderpriority AS x, count(*) AS n FROM inst i JOIN orders f ON f.o_custkey = i.k
            AND f.o_orderdate < c AND f.o_orderdate >= c - INTERVAL 24 MONTH GROUP BY i.k, i.c, x),
placed AS (SELECT *, row_number() OVER (PARTITION BY k, c ORDER BY n DESC, x) AS pos FROM counted)
SELECT i.k AS c_custkey, strftime(i.c, '%Y-%m-%d') AS time,
       string_agg(x, '|' ORDER BY pos) AS n_most_common_orders_o_orderpriority
FROM inst i LEFT JOIN placed p ON p.k = i.k AND p.c = i.c AND pos <= 3 GROUP BY i.k, i.c"""
ORACLES["feat_transforms"] = """
SELECT event_id, CAST(second(ts) AS INTEGER) AS second, CAST(minute(ts) AS INTEGER) AS minute,
       CAST(isodow(ts) - 1 AS INTEGER) AS weekday, isodow(ts) >= 6 AS is_weekend, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(day(ts) AS INTEGER) AS day, CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
       CAST(year(ts) AS INTEGER) AS year, round(abs(value - 50), 4) AS absolute
FROM events"""
ORACLES["feat_diff"] = """
SELECT o_orderkey, round(o_totalprice - lag(o_totalprice) OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 2) AS diff FROM orders"""
ORACLES["feat_time_since_previous"] = """
SELECT event_id, round(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 1e6, 6) AS seconds
FROM events"""
ORACLES["feat_percentile"] = """
SELECT l_quantity, count(*) AS n, round(max(pct), 8) AS percentile FROM (
    SELECT l_quantity, (rank() OVER (ORDER BY l_quantity) - 1 + (count(*) OVER (PARTITION BY l_quantity) + 1) / 2.0)
           / count(*) OVER () AS pct FROM lineitem)
GROUP BY l_quantity"""
ORACLES["feat_time_since"] = feature_sql("""
    round(avg(date_diff('microsecond', f.o_orderdate, c) / 1e6), 3) AS mean_orders_time_since_o_orderdate,
    round(max(date_diff('microsecond', f.o_orderdate, c) / 1e6), 3) AS max_orders_time_since_o_orderdate""")

ITEMS = """,
items AS (SELECT o_custkey, o_orderdate, lineitem.*, part.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          LEFT JOIN part ON l_partkey = p_partkey)"""
ORACLES["feat_where_manual"] = feature_sql("""
    count(CASE WHEN f.p_type = 'PROMO' THEN 1 END) AS count_items_where_part_p_type_promo,
    round(coalesce(sum(CASE WHEN f.p_type = 'PROMO' THEN f.l_extendedprice END), 0), 2)
        AS sum_items_l_extendedprice_where_part_p_type_promo,
    count(CASE WHEN f.l_returnflag = 'R' THEN 1 END) AS count_items_where_l_returnflag_r""", source="items", ctes=ITEMS)


def frequent_sql(table: str, columns, k: int) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns)
    return f"""
SELECT "column", value, n, share FROM (
    SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS pos FROM (
        SELECT *, n / sum(n) OVER (PARTITION BY "column") AS share, count(*) OVER (PARTITION BY "column") AS d FROM (
            SELECT "column", value, count(*) AS n FROM ({cells}) WHERE value IS NOT NULL GROUP BY ALL))
    WHERE d < 25 OR (share > 0.05 AND share < 0.95))
WHERE pos <= {k}"""


ORACLES["interesting_values"] = f"""
SELECT "column", value, n, round(CAST(share AS DOUBLE), 8) AS share FROM ({frequent_sql("part", ["p_type", "p_brand", "p_name"], 4)})"""
ORACLES["feat_where_auto"] = label_ctes() + f""",
frequent AS ({frequent_sql("orders", ["o_orderstatus", "o_orderpriority"], 2)})
SELECT i.k AS c_custkey, strftime(i.c, '%Y-%m-%d') AS time,
       'COUNT(orders WHERE ' || "column" || ' = ' || value || ')' AS feature,
       count(CASE WHEN value = CASE "column" WHEN 'o_orderstatus' THEN o_orderstatus ELSE o_orderpriority END THEN 1 END) AS n
FROM inst i CROSS JOIN frequent LEFT JOIN orders f ON f.o_custkey = i.k AND f.o_orderdate < c
     AND f.o_orderdate >= c - INTERVAL 24 MONTH
GROUP BY i.k, i.c, "column", value"""
ORACLES["feat_depth2"] = feature_sql("""
    CAST(first(month(f.o_orderdate) ORDER BY f.o_orderdate DESC, f.o_orderkey DESC) AS INTEGER) AS last_orders_month_o_orderdate,
    count(DISTINCT month(f.o_orderdate)) AS num_unique_orders_month_o_orderdate,
    round(avg(f.diff), 6) AS mean_orders_diff_o_totalprice,
    round(avg(CASE WHEN f.o_orderkey IS NOT NULL THEN coalesce(q.quantity, 0) END), 6) AS mean_orders_sum_lineitem_l_quantity""",
    source="lagged", ctes=""",
lagged AS (SELECT *, o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS diff
           FROM orders),
lines AS (SELECT l_orderkey, c AS at, sum(l_quantity) AS quantity FROM lineitem JOIN cuts
          ON l_shipdate < c AND l_shipdate >= c - INTERVAL 24 MONTH GROUP BY l_orderkey, c)""",
    extra="LEFT JOIN lines q ON q.l_orderkey = f.o_orderkey AND q.at = i.c")
ORACLES["feat_parent_mode"] = label_ctes() + ITEMS + mode_ctes("f.p_type", "m", "items") + """,
brands AS (SELECT i.k, i.c, count(DISTINCT f.p_brand) AS n FROM inst i JOIN items f ON f.o_custkey = i.k
           AND f.o_orderdate < c AND f.o_orderdate >= c - INTERVAL 24 MONTH GROUP BY i.k, i.c)
SELECT i.k AS c_custkey, strftime(i.c, '%Y-%m-%d') AS time, m.x AS mode_items_part_p_type,
       coalesce(n, 0) AS num_unique_items_part_p_brand
FROM inst i LEFT JOIN m ON m.k = i.k AND m.c = i.c LEFT JOIN brands b ON b.k = i.k AND b.c = i.c"""
ORACLES["feat_direct"] = label_ctes() + """
SELECT k AS c_custkey, strftime(c, '%Y-%m-%d') AS time, CAST(month(c) AS INTEGER) AS month_of_cutoff_point,
       c_acctbal, c_mktsegment, n_name AS nation_n_name
FROM inst LEFT JOIN customer ON c_custkey = k LEFT JOIN nation ON c_nationkey = n_nationkey"""
ORACLES["feat_drop_id_like"] = label_ctes() + mode_ctes("f.o_orderpriority", "m") + """,
wide AS (SELECT c_name, c_mktsegment, n_name AS nation_n_name, m.x AS mode_orders_o_orderpriority
         FROM inst i LEFT JOIN customer ON c_custkey = i.k LEFT JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN m ON m.k = i.k AND m.c = i.c),
cells AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS v FROM wide" for c in (
    "c_name", "c_mktsegment", "nation_n_name", "mode_orders_o_orderpriority")) + """)
SELECT column_name, count(DISTINCT v) > least(count(*) * 0.9, 1000) AS dropped, count(v) AS n FROM cells GROUP BY column_name"""
ORACLES["feature_list"] = f"""
WITH wide AS ({feature_sql('''
    count(f.o_orderkey) AS a, first(f.o_totalprice ORDER BY f.o_orderdate DESC, f.o_orderkey DESC) AS b,
    avg(f.o_totalprice) AS d, stddev_samp(f.o_totalprice) AS e''')})
SELECT 0 AS "index", 'COUNT(orders)' AS feature_name, count(a) AS n FROM wide
UNION ALL SELECT 1, 'LAST(orders.o_totalprice)', count(b) FROM wide
UNION ALL SELECT 2, 'MEAN(orders.o_totalprice)', count(d) FROM wide
UNION ALL SELECT 3, 'STD(orders.o_totalprice)', count(e) FROM wide"""
ORACLES["custom_primitive"] = feature_sql("""
    round(max(f.o_totalprice) - min(f.o_totalprice), 3) AS range_orders_o_totalprice,
    round((max(f.o_totalprice) + min(f.o_totalprice)) / 2 + month(c), 3) AS mean_of_ends_orders_o_totalprice""")
ORACLES["custom_label"] = label_sql(
    f"CAST(coalesce(got > {BIG_SPEND}, FALSE) AS INTEGER)", "big_spender", "sum(CASE WHEN hit THEN v END) AS got", pred="6 MONTH")

# ---- training tables

HASH = "CAST('0x' || substr(md5({0}), 1, 13) AS BIGINT)"
ORACLES["train_matrix"] = label_ctes() + """,
p AS (SELECT k, c, max(CASE WHEN hit THEN 1 ELSE 0 END) AS purchase FROM w GROUP BY k, c),
feats AS (SELECT i.k, i.c, CAST(count(f.o_orderkey) AS DOUBLE) AS n,
                 first(f.o_orderstatus ORDER BY f.o_orderdate DESC, f.o_orderkey DESC) AS last_status
          FROM inst i LEFT JOIN orders f ON f.o_custkey = i.k AND f.o_orderdate < c
               AND f.o_orderdate >= c - INTERVAL 6 MONTH GROUP BY i.k, i.c)
SELECT feats.k AS c_custkey, strftime(feats.c, '%Y-%m-%d') AS time, n AS count_orders,
       coalesce(last_status, 'other') AS last_orders_o_orderstatus, coalesce(c_mktsegment, 'other') AS c_mktsegment, purchase
FROM feats JOIN p ON p.k = feats.k AND p.c = feats.c LEFT JOIN customer ON c_custkey = feats.k"""
ORACLES["split_last_time"] = f"""
WITH l AS ({PURCHASE}) SELECT time, time = (SELECT max(time) FROM l) AS is_test, count(*) AS n FROM l GROUP BY time"""
ORACLES["split_by_id"] = f"""
WITH l AS ({PURCHASE})
SELECT o_custkey, time, {HASH.format("o_custkey || ':1'")} % 10000 < 3000 AS is_test FROM l"""
ORACLES["split_by_id_exact"] = f"""
WITH l AS ({PURCHASE}),
ids AS (SELECT o_custkey, row_number() OVER (ORDER BY {HASH.format("o_custkey || ':1'")}, o_custkey) AS pos,
               count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM l))
SELECT o_custkey, time, pos <= floor(n * 0.3 + 1e-9) AS is_test FROM l JOIN ids USING (o_custkey)"""
ORACLES["split_stratified"] = f"""
WITH l AS ({PURCHASE}), h AS (SELECT *, {HASH.format("o_custkey || ':' || time || ':1'")} AS hash FROM l)
SELECT o_custkey, time, purchase, percent_rank() OVER (PARTITION BY purchase ORDER BY hash) <= 0.3 AS is_test FROM h"""
ORACLES["class_weight"] = f"""
WITH l AS ({PURCHASE}), s AS (SELECT count(CASE WHEN purchase = 0 THEN 1 END) AS negatives,
                                     count(CASE WHEN purchase = 1 THEN 1 END) AS positives FROM l)
SELECT negatives, positives, CASE WHEN negatives / positives >= 5 THEN round(negatives / positives, 8) END AS weight FROM s"""
ORACLES["train_guards"] = f"""
WITH l AS ({PURCHASE}), per AS (
    SELECT purchase, count(*) AS n, count(CASE WHEN time <> (SELECT max(time) FROM l) THEN 1 END) AS n_train
    FROM l GROUP BY purchase),
s AS (SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS label_values, min(n) AS smallest_class,
             count(CASE WHEN n_train > 0 THEN 1 END) AS train_label_values FROM per)
SELECT *, CASE WHEN label_values = 1 THEN 'single label value' WHEN smallest_class = 1 THEN 'class with one member'
    WHEN train_label_values <= 1 THEN 'single label value in train' ELSE 'ok' END AS status FROM s"""

# ---- ranking and evaluation

SCORED = """WITH s AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice / 600000.0 AS prediction
                     FROM orders)"""
PREDICTED = """WITH s AS (SELECT o_orderkey, o_totalprice AS y,
    o_totalprice * (CAST(0.5 AS DOUBLE) + (o_orderkey % 100) / CAST(100 AS DOUBLE)) AS prediction FROM orders)"""

ORACLES["rank_first"] = """
SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) AS rank, count(*) OVER () AS rank_total FROM events"""
ORACLES["decile"] = SCORED + """
SELECT o_orderkey, (11 - greatest(1, ceil((r - 1) * 10 / greatest(n - 1, 1)))) / 10 AS decile FROM (
    SELECT o_orderkey, row_number() OVER (ORDER BY prediction, o_orderkey) AS r, count(*) OVER () AS n FROM s)"""
ORACLES["threshold_label"] = SCORED + """,
r AS (SELECT *, row_number() OVER (ORDER BY prediction) - 1 AS pos FROM s),
p AS (SELECT (1 - avg(y)) * (count(*) - 1) AS spot FROM s),
ends AS (SELECT max(CASE WHEN pos = floor(spot + 1e-9) THEN prediction END) AS lo,
                max(CASE WHEN pos = ceil(spot - 1e-9) THEN prediction END) AS hi,
                greatest(max(spot) - floor(max(spot) + 1e-9), 0) AS part FROM r, p)
SELECT o_orderkey, CAST(prediction >= lo + (hi - lo) * part AS INTEGER) AS label FROM s, ends"""
ORACLES["top_share_label"] = SCORED + """,
q AS (SELECT quantile_cont(prediction, 0.7) AS cut FROM s)
SELECT o_orderkey, CAST(prediction >= cut AS INTEGER) AS label FROM s, q"""
ORACLES["auc"] = SCORED + """,
r AS (SELECT y, rank() OVER (ORDER BY prediction) + (count(*) OVER (PARTITION BY prediction) - 1) / 2.0 AS rk FROM s),
t AS (SELECT CAST(sum(CASE WHEN y = 1 THEN rk END) AS DOUBLE) AS ranks, CAST(sum(y) AS DOUBLE) AS p,
             CAST(sum(1 - y) AS DOUBLE) AS n FROM r)
SELECT round((ranks - p * (p + 1) / 2) / (p * n), 8) AS auc FROM t"""
ORACLES["confusion_matrix"] = SCORED + """
SELECT y AS actual, CAST(prediction > 0.5 AS INTEGER) AS predicted, count(*) AS n FROM s GROUP BY ALL"""
ORACLES["roc_points"] = """
WITH g AS (SELECT l_quantity AS threshold, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS p, count(*) AS n
           FROM lineitem GROUP BY l_quantity)
SELECT threshold, round(sum(n - p) OVER (ORDER BY threshold DESC) / sum(n - p) OVER (), 8) AS fpr,
       round(sum(p) OVER (ORDER BY threshold DESC) / sum(p) OVER (), 8) AS tpr
FROM g"""
ORACLES["cumulative_gain"] = SCORED + """,
g AS (SELECT 1 AS class, row_number() OVER (ORDER BY prediction DESC, o_orderkey) AS i,
             sum(y) OVER (ORDER BY prediction DESC, o_orderkey) AS found, sum(y) OVER () AS whole, count(*) OVER () AS n FROM s
      UNION ALL
      SELECT 0, row_number() OVER (ORDER BY prediction, o_orderkey), sum(1 - y) OVER (ORDER BY prediction, o_orderkey),
             sum(1 - y) OVER (), count(*) OVER () FROM s)
SELECT class, round(i / n, 8) AS percentage, round(found / whole, 8) AS gain FROM g
UNION ALL SELECT 0, 0.0, 0.0 UNION ALL SELECT 1, 0.0, 0.0"""
ORACLES["profit_report_classifier"] = SCORED + """,
cuts AS (SELECT CAST(i AS DOUBLE) / 10 AS decile, quantile FROM (
    SELECT unnest(range(1, 11)) AS i, unnest(quantile_cont(prediction, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0])) AS quantile
    FROM s)),
t AS (SELECT decile, count(*) AS n, sum(y) AS n_pos, count(CASE WHEN prediction > quantile THEN 1 END) AS cul_total,
             count(CASE WHEN prediction > quantile AND y = 1 THEN 1 END) AS cul_positive FROM s, cuts GROUP BY decile)
SELECT decile, cul_total, cul_positive, cul_total - cul_positive AS cul_negative,
       round(cul_positive / cul_total, 8) AS precision, round(cul_positive / n_pos, 8) AS recall,
       round(cul_positive / cul_total / (n_pos / n), 8) AS lift
FROM t"""
GAINS = PREDICTED + """,
g AS (SELECT sum(y) OVER (ORDER BY prediction DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS gain FROM s),
r AS (SELECT gain, row_number() OVER (ORDER BY gain) - 1 AS pos, count(*) OVER () AS n FROM g),
whole AS (SELECT sum(y) AS total FROM s)"""
ORACLES["profit_report_regression"] = GAINS + """,
q AS (SELECT i / 10 AS decile, gain, pos + 1 AS upto FROM r JOIN (SELECT unnest(range(1, 11)) AS i) d
      ON pos = ceil(i / 10 * (n - 1) - 1e-9))
SELECT decile, round(gain, 2) AS cul_sum, upto AS cul_num, round(gain / upto, 2) AS cul_avg,
       round(gain / total, 8) AS recall, round(gain / total / decile, 8) AS lift
FROM q, whole"""
ORACLES["gain_regression"] = PREDICTED + """,
g AS (SELECT sum(y) OVER (ORDER BY prediction DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS gain FROM s
      UNION ALL SELECT 0.0),
q AS (SELECT unnest(range(0, 11)) AS i,
             unnest(quantile_cont(gain, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS gain FROM g)
SELECT i / 10 AS percentages, round(gain / (SELECT sum(y) FROM s), 8) AS gains FROM q"""
ORACLES["regression_metrics"] = PREDICTED + """
SELECT round(1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)), 8) AS r2,
       round(avg(abs(y - prediction)), 2) AS mae, round(avg((y - prediction) * (y - prediction)), 2) AS mse
FROM s"""
ORACLES["prediction_pairs"] = PREDICTED + """ SELECT round(y, 6) AS "true", round(prediction, 6) AS pred FROM s"""
ORACLES["error_share"] = PREDICTED + f"""
SELECT 'absolute' AS kind, bound, round(avg(CAST(abs(y - prediction) <= bound AS INTEGER)), 8) AS precision
FROM s, (SELECT unnest([{", ".join(f"CAST({b} AS DOUBLE)" for b in ERROR_BOUNDS)}]) AS bound) GROUP BY bound
UNION ALL
SELECT 'relative', round(bound, 8), round(avg(CAST(abs(y - prediction) / y <= bound AS INTEGER)), 8)
FROM s, (SELECT 0.05 + CAST(0.1 AS DOUBLE) * unnest(range(0, 6)) AS bound) GROUP BY bound"""
ORACLES["error_cdf"] = PREDICTED + """
SELECT CAST(i AS DOUBLE) AS percentile, round(error, 4) AS error FROM (
    SELECT unnest(range(0, 101)) AS i, unnest(quantile_cont(y - prediction, [""" + ", ".join(
    str(i / 100) for i in range(101)) + """])) AS error FROM s)"""
ORACLES["evaluation_summary"] = SCORED + f""",
parts AS (SELECT *, CASE WHEN {HASH.format("o_orderkey || ':1'")} % 10000 < 3000 THEN 'test' ELSE 'train' END AS split FROM s),
r AS (SELECT split, y, rank() OVER (PARTITION BY split ORDER BY prediction)
             + (count(*) OVER (PARTITION BY split, prediction) - 1) / 2.0 AS rk FROM parts),
t AS (SELECT split, CAST(sum(CASE WHEN y = 1 THEN rk END) AS DOUBLE) AS ranks, CAST(sum(y) AS DOUBLE) AS p,
             CAST(sum(1 - y) AS DOUBLE) AS n FROM r GROUP BY split)
SELECT split, 'auc' AS metric, round((ranks - p * (p + 1) / 2) / (p * n), 8) AS value FROM t"""

# ---- comments

BOILERPLATE = "'评价方未及时做出评价,系统默认好评!', '好评！', ' '"
ORACLES["comment_new"] = f"""
SELECT DISTINCT d.doc_id AS oid, n_chars AS created, o_orderpriority AS category, md5(text) AS content_md5
FROM documents d
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '1996-12-31') o ON o.o_orderkey = d.doc_id
LEFT JOIN (SELECT DISTINCT doc_id FROM labels) p ON p.doc_id = d.doc_id
WHERE p.doc_id IS NULL AND text NOT IN ({BOILERPLATE})"""
WORDS = f"""
SELECT *, length(word) AS size FROM (
    SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\\p{{L}}]+')) AS word FROM documents)
WHERE length(word) > 1 AND word NOT IN ({text_list(STOP_WORDS)})"""
ORACLES["comment_words"] = f"SELECT lang, word, count(*) AS n FROM ({WORDS}) GROUP BY lang, word"
ORACLES["word_explode_incremental"] = f"""
SELECT doc_id AS oid, word, count(*) AS n FROM ({WORDS.replace("FROM documents", f'''FROM documents
    WHERE n_chars >= 100 AND text NOT IN ({BOILERPLATE}) AND doc_id NOT IN (SELECT doc_id FROM labels)''')})
GROUP BY doc_id, word"""

# ---- jobs

ORACLES["sql_template_union"] = """
SELECT o_orderstatus AS brand, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_orderstatus, o_orderpriority"""

# ---- files, clean-up and flows

ORACLES["csv_round_trip"] = "SELECT c_custkey, c_name, c_acctbal FROM customer"
ORACLES["sanitized_text"] = """
SELECT doc_id, CASE WHEN text NOT IN ('NaT', 'NaN', 'nan', 'None') THEN md5(regexp_replace(text, '[''"]', ' ', 'g')) END AS text_md5
FROM documents"""
ORACLES["comma_replacement"] = "SELECT doc_id, md5(replace(text, ',', '#')) AS text_md5 FROM documents"
ORACLES["key_cast"] = """
SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""
ORACLES["label_stats_pretty"] = f"""
WITH l AS ({PURCHASE})
SELECT coalesce(time, 'All') AS time, count(*) AS n, printf('%.4f%%', avg(CAST(purchase = 0 AS INTEGER)) * 100) AS share_0,
       printf('%.4f%%', avg(purchase) * 100) AS share_1
FROM l GROUP BY ROLLUP (time)"""
ORACLES["feat_null_cutoff"] = """
WITH i AS (SELECT o_custkey AS k, o_orderdate AS c FROM orders UNION SELECT o_custkey, CAST(NULL AS TIMESTAMP) FROM orders)
SELECT k AS c_custkey, strftime(c, '%Y-%m-%d') AS time, count(o_orderkey) AS count_orders
FROM i LEFT JOIN orders ON o_custkey = k AND o_orderdate < c GROUP BY k, c"""
ORACLES["id_like_integers"] = """
WITH cells AS (SELECT 'o_orderkey' AS column_name, o_orderkey AS v FROM orders
               UNION ALL SELECT 'o_year', year(o_orderdate) FROM orders)
SELECT column_name, count(DISTINCT v) > (SELECT count(DISTINCT o_custkey) FROM orders) * 0.9 AS dropped, count(v) AS n
FROM cells GROUP BY column_name"""
ORACLES["aligned_columns"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS DOUBLE) AS absent, c_acctbal FROM customer"""
ORACLES["evaluation_by_cutoff"] = f"""
WITH s AS (SELECT o_custkey, time, purchase AS y, (o_custkey % 7) / CAST(7 AS DOUBLE) AS prediction FROM ({PURCHASE})),
g AS (SELECT 1 AS class, row_number() OVER up AS i, sum(y) OVER up AS found, sum(y) OVER () AS whole, count(*) OVER () AS n FROM s
      WINDOW up AS (ORDER BY prediction DESC, o_custkey, time ROWS UNBOUNDED PRECEDING)
      UNION ALL
      SELECT 0, row_number() OVER down, sum(1 - y) OVER down, sum(1 - y) OVER (), count(*) OVER () FROM s
      WINDOW down AS (ORDER BY prediction, o_custkey, time ROWS UNBOUNDED PRECEDING))
SELECT class, round(i / n, 8) AS percentage, round(found / whole, 8) AS gain FROM g
UNION ALL SELECT 0, 0.0, 0.0 UNION ALL SELECT 1, 0.0, 0.0"""
ORACLES["evaluation_by_customer_group"] = f"""
WITH s AS (SELECT c_nationkey, time, purchase AS y, (o_custkey % 7) / CAST(7 AS DOUBLE) AS prediction
           FROM ({PURCHASE}) l JOIN customer ON c_custkey = o_custkey),
r AS (SELECT c_nationkey, time, y, rank() OVER (PARTITION BY c_nationkey, time ORDER BY prediction)
             + (count(*) OVER (PARTITION BY c_nationkey, time, prediction) - 1) / 2.0 AS rk FROM s),
t AS (SELECT c_nationkey, time, CAST(sum(CASE WHEN y = 1 THEN rk END) AS DOUBLE) AS ranks, CAST(sum(y) AS DOUBLE) AS p,
             CAST(sum(1 - y) AS DOUBLE) AS n FROM r GROUP BY c_nationkey, time)
SELECT c_nationkey, time, 'auc' AS metric, round((ranks - p * (p + 1) / 2) / nullif(p * n, 0), 8) AS value FROM t"""
ORACLES["comment_flow"] = ORACLES["word_explode_incremental"]
ORACLES["sql_script"] = """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY o_orderstatus"""
SMALL_MODEL = {"pred": "3 MONTH", "n": 3}
ORACLES["flow_resume"] = f"""
WITH l AS ({label_sql("got", "purchase", HIT, key="c_custkey", **SMALL_MODEL)})
SELECT l.c_custkey, l.time, l.purchase, count(o_orderkey) AS count_orders
FROM l LEFT JOIN orders ON o_custkey = l.c_custkey AND o_orderdate < CAST(l.time AS TIMESTAMP)
     AND o_orderdate >= CAST(l.time AS TIMESTAMP) - INTERVAL 12 MONTH
GROUP BY ALL"""
ORACLES["predict_job_rows"] = f"""
WITH l AS ({label_sql("got", "purchase", HIT, key="c_custkey", **SMALL_MODEL)}),
now AS (SELECT date_trunc('month', max(o_orderdate))::TIMESTAMP AS c FROM orders)
SELECT o_custkey AS c_custkey, strftime(c, '%Y-%m-%d') AS cutoff, (SELECT round(avg(purchase), 8) FROM l) AS train_pos_rate
FROM orders, now WHERE o_orderdate < c AND o_orderdate >= c - INTERVAL 12 MONTH GROUP BY o_custkey, c"""
ORACLES["flow_snapshot"] = ORACLES["flow_resume"]
ORACLES["snapshot_merge"] = """
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS last_date, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
ORACLES["comment_batches"] = f"""
SELECT CASE WHEN n_chars < 2000 THEN 'early' ELSE 'all' END AS batch, doc_id AS oid, word, count(*) AS n
FROM ({WORDS.replace("FROM documents", f"FROM documents WHERE text NOT IN ({BOILERPLATE})").replace("SELECT doc_id, lang,", "SELECT doc_id, lang, n_chars,")})
GROUP BY ALL"""
