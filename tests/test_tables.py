"""Loading, clean-up, sinks, SQL jobs, comments."""

import math
import random
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cutline import session
from cutline.functions.standardize import (
    apply_dictionary, cast_keys, columns_of_kind, null_minimum_dates, replace_commas, standardize_types)
from cutline.operators import text
from cutline.operators.entities import Entity, EntitySet, Parent, keep_last_by_key, product_join, with_native_keys
from cutline.operators.text import new_comments, split_run, with_prefixes, word_rows
from cutline.sources.readers import (
    Database, jdbc_read_options, load_entities, modified_since, read_csv, read_word_list, row_cap, typed_options)
from cutline.sources.sinks import (
    column_types, jdbc_write_options, sanitized, save_result, stage_folder, write_by_product, write_csv)
from cutline.sources.sql_jobs import create_then_insert, filled, run_sql, run_sql_directory, statements, union_over
from helpers import plan_of

DB = Database("greenplum", "db.example", 5432, "shop", "reader", "secret", "dm")


def test_types_and_minimum_date(spark):
    df = spark.createDataFrame([("2020-02-03 04:05:06", "1.5", "7", "true", 3), ("soon", "x", "y", "maybe", None),
                                ("1900-01-01 00:00:00", None, None, None, 1), ("1900-01-01 00:00:01", "2", "2", "0", 1)],
                               "t string, n string, i string, b string, c int")
    out = standardize_types(df, [{"name": n, "variable_type": v} for n, v in [
        ("t", "datetime"), ("n", "numeric"), ("i", "int"), ("b", "boolean"), ("c", "categorical"), ("gone", "numeric")]])
    assert [tuple(r) for r in out.collect()] == [
        (datetime(2020, 2, 3, 4, 5, 6), 1.5, 7, True, "3"), (None, None, None, None, None),
        (None, None, None, None, "1"), (datetime(1900, 1, 1, 0, 0, 1), 2.0, 2, False, "1")]
    with pytest.raises(ValueError):
        standardize_types(df, [{"name": "t", "variable_type": "colour"}])
    assert null_minimum_dates(out, ["other"]).where("t IS NOT NULL").count() == 2
    assert columns_of_kind(out, "datetime") == ["t"] and columns_of_kind(out, "object") == ["c"]


def test_keep_last_and_commas(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x,y", 1)], "k int, v string, t int")
    assert sorted(keep_last_by_key(df, "k", ["t"]).collect()) == [(1, "b", 3), (2, "x,y", 1)]
    assert replace_commas(df).where("k = 2").first().v == "x#y"


def test_dictionary(spark):
    rows = [(1, "s1", "o1", "5", None), (2, None, "o1", "6", "yes"), (3, None, "o2", "z", "no"), (4, "s2", None, "7", "no"),
            (4, "s2", None, "7", "no")]
    df = spark.createDataFrame(rows, "line int, shop string, dms_order_id string, price string, extra string")
    entries = [{"source": "shop", "target": "dms_nick", "is_merge": 1}, {"source": "dms_order_id", "target": "dms_order_id", "is_key": 1},
               {"source": "price", "target": "amount", "type": "float"}, {"source": "absent", "target": "level", "default": "low"},
               {"source": "extra", "target": None}, {"source": "line", "target": "line_no", "type": "int"}]
    out = apply_dictionary(df, entries, order="line", constants={"origin": "crm"}, order_id=("dms_nick", "dms_order_id"))
    got = sorted(tuple(r) for r in out.collect())
    assert out.columns == ["dms_nick", "dms_order_id", "amount", "level", "line_no", "origin", "order_id"]
    assert got == [("s1", "o1", 6.0, "low", 2, "crm", "s1_o1"), ("s1", "o2", None, "low", 3, "crm", "s1_o2")]


def test_keys_and_product_join(spark):
    a = spark.createDataFrame([(1, "n")], "k int, name string")
    b = spark.createDataFrame([("1", "m")], "k string, name string")
    x, y = cast_keys(a, "k", b, "k")
    assert x.schema["k"].dataType == y.schema["k"].dataType
    assert product_join(*cast_keys(a, "k", b, "k"), "k").columns == ["k", "name", "name_product_entity"]
    es = with_native_keys(EntitySet([Entity("a", a, key="k"), Entity("b", b, parents=[Parent("a", "k")])]))
    assert es["a"].df.schema["k"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        es["c"]


def test_sources(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], "i int, c string"), str(tmp_path / "t"))
    assert read_csv(spark, str(tmp_path / "t"), schema="i int, c string").count() == 2
    assert read_csv(spark, str(tmp_path / "none"), absent_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "none"))
    assert row_cap(spark.range(5), 0).count() == 0 and row_cap(spark.range(5), 2).count() == 2
    assert typed_options([{"para_name": "a", "para_value": "3", "para_value_type": "int"},
                          {"para_name": "b", "para_value": "false", "para_value_type": "bool"}]) == {"a": 3, "b": False}
    with pytest.raises(ValueError):
        typed_options([{"para_name": "a", "para_value": "3", "para_value_type": "date"}])
    (tmp_path / "stop.txt").write_text("the\n of \nthe\n\n", encoding="utf-8")
    assert {r.word for r in read_word_list(spark, str(tmp_path / "stop.txt")).collect()} == {"the", "of"}
    fresh = modified_since(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderdate", "2001-01-01 00:00:00")
    assert "GreaterThanOrEqual(o_orderdate" in fresh._jdf.queryExecution().toString()


def test_entity_loading(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "n string, c string")
    out = load_entities(spark, [
        {"entity_name": "e", "field_list": [{"name": "n", "variable_type": "numeric"}],
         "filter_data_list": [{"column": "c", "values": ["b"]}]},
        {"entity_name": "v", "normalize_base_entity": "e"}], tables={"e": df})
    assert list(out) == ["e"] and sorted(out["e"].collect(), key=str) == [(1.0, "a"), (3.0, None)]


def test_jdbc_settings_need_no_database():
    assert jdbc_read_options(DB, "t")["dbtable"] == "dm.t" and jdbc_read_options(DB, sql="select 1")["query"] == "select 1"
    split = jdbc_read_options(DB, sql="select 1", partition=("id", 0, 100, 8))
    assert split["numPartitions"] == "8" and split["dbtable"].startswith("(select 1)") and "query" not in split
    with pytest.raises(ValueError):
        jdbc_read_options(DB)
    assert "secret" not in repr(DB)
    mode, options = jdbc_write_options(DB, "t", "overwrite", types={"c": "VARCHAR(9)"})
    assert (mode, options["truncate"], options["batchsize"]) == ("overwrite", "true", "5000")
    assert options["createTableColumnTypes"] == "`c` VARCHAR(9)"
    assert jdbc_write_options(DB, "t")[0] == "append" and "truncate" not in jdbc_write_options(DB, "t", recreate=True)[1]
    with pytest.raises(ValueError):
        Database("oracle", "h", 1, "d", "u", "p").url


def test_text_and_types_before_writing(spark, tmp_path):
    df = spark.createDataFrame([("it's \"x\"", float("nan"), 1), ("NaT", 1.5, 2)], "s string, f double, i int")
    assert [tuple(r) for r in sanitized(df).collect()] == [("it s  x ", None, 1), (None, 1.5, 2)]
    assert column_types(df, {"s": ("varchar", 20), "f": ("decimal", 16, 4)}) == {"s": "VARCHAR(20)", "f": "DECIMAL(16,4)", "i": "INTEGER"}
    with pytest.raises(ValueError):
        column_types(spark.range(1).selectExpr("array(id) AS a"))
    assert stage_folder("m", "a/b") == "m/a_b" and stage_folder("m") == "m"
    labels = spark.createDataFrame([(1, "X", 1), (1, "Y", 0)], "k int, product string, product_purchase int")
    write_by_product(labels, str(tmp_path / "labels"))
    assert spark.read.parquet(str(tmp_path / "labels")).where("product = 'X'").count() == 1
    seen = []
    assert save_result(spark, str(tmp_path / "labels"), DB, "t", write=lambda df, *a: seen.append(df.count())) and seen == [2]
    assert not save_result(spark, str(tmp_path / "absent"), DB, "t")


def test_snapshot(spark, tmp_path):
    es = EntitySet([Entity("e", spark.range(3).toDF("k"), key="k")])
    es.save(str(tmp_path / "snap"))
    assert es.reload(spark, str(tmp_path / "snap"))["e"].df.count() == 3


def test_sql_jobs(spark, tmp_path):
    spark.range(6).selectExpr("id", "IF(id % 2 = 0, 'ann', 'bob') AS brand").createOrReplaceTempView("sales_in")
    template = "SELECT '{brand_nick}' AS nick, count(*) AS n FROM sales_in WHERE brand = '{brand_nick}'"
    assert sorted(union_over(spark, template, ["ann", "bob"]).collect()) == [("ann", 3), ("bob", 3)]
    create_then_insert(spark, "per_brand", template, ["ann", "bob"])
    assert spark.table("per_brand").count() == 2
    with pytest.raises(ValueError):
        filled(template, {"brand_nick": "x'; drop table t"})
    assert statements("a;\nb ;\n\n") == ["a", "b"]
    assert run_sql(spark, "SELECT count(*) AS n FROM sales_in WHERE id >= :low", {"low": 4}).first().n == 2
    (tmp_path / "standard").mkdir()
    (tmp_path / "standard" / "1_a.sql").write_text("CREATE OR REPLACE TEMP VIEW v1 AS SELECT '{brand_nick}' AS b;\n")
    (tmp_path / "standard" / "2_b.sql").write_text("CREATE OR REPLACE TEMP VIEW v2 AS SELECT upper(b) AS b FROM v1")
    assert run_sql_directory(spark, str(tmp_path), "no_such", {"brand_nick": "ann"}) == ["1_a.sql", "2_b.sql"]
    assert spark.table("v2").first().b == "ANN"


def test_words(spark):
    comments = spark.createDataFrame([(1, "Abc 12 déf x", 10), (2, "the cat, the hat", 20), (3, " ", 30), (4, None, 40),
                                      (5, "old one", 50), (2, "the cat, the hat", 20)], "oid long, content string, created int")
    done = spark.createDataFrame([(5,), (5,)], "oid long")
    orders = spark.createDataFrame([(1, "dress")], "oid long, category string")
    fresh = new_comments(comments, done, orders)
    assert sorted((r.oid, r.category or "") for r in fresh.collect()) == [(1, "dress"), (2, "")]
    words = word_rows(fresh, "content", ["the"])
    assert sorted((r.oid, r.word) for r in words.collect()) == [(1, "abc"), (1, "déf"), (2, "cat"), (2, "hat")]
    assert new_comments(comments, begin=20, end=50).select("oid").distinct().count() == 1
    kept = word_rows(comments, "content")
    assert sum(r.word == "the" for r in kept.where("oid = 2").collect()) == 4  # two rows of oid 2, repeated words stay
    stop = spark.createDataFrame([("cat",), ("the",)], "word string")
    assert {r.word for r in word_rows(fresh, "content", stop).collect()} == {"abc", "déf", "hat"}


def brute(run, cost, unknown):
    """Cheapest of all ways to cut a run."""
    least = [0.0]  # of the last characters, one more each time
    for at in range(len(run) - 1, -1, -1):
        ways = [unknown + least[-1]]
        ways += [cost[run[at : at + i]] + least[-i] for i in range(1, len(run) - at + 1) if run[at : at + i] in cost]
        least.append(min(ways))
    return least[-1]


def test_dictionary_segmentation(spark):
    cost = {"连衣": 4.0, "连衣裙": 3.0, "裙子": 2.5, "子": 1.0, "好看": 2.0, "t恤": 2.0}
    for run in ("连衣裙子好看", "很好看的连衣裙", "t恤好看", "裙"):
        words = split_run(run, with_prefixes(cost), 9.0)
        assert "".join(words) == run
        assert sum(cost.get(w, 9.0) for w in words) == brute(run, cost, 9.0)
    dictionary = spark.createDataFrame([("连衣裙", 50), ("好看", 90), ("衬衫", 30), ("t恤", 10), ("abc", 5)], "word string, frequency long")
    comments = spark.createDataFrame([(1, "连衣裙好看abc, 衬衫 t恤 好看2"), (2, None)], "oid long, content string")
    got = [r.word for r in word_rows(comments, "content", ["衬衫"], dictionary).collect()]
    assert sorted(got) == sorted(["连衣裙", "好看", "t恤", "好看"])
    assert comments.select(F.col("oid")).count() == 2


@pytest.mark.parametrize("chars", [1 << 18, 40])
def test_segmentation_against_brute_force(spark, monkeypatch, chars):
    """Any words and runs, repeated rows and words, batches that end inside an Arrow batch, runs beyond every word."""
    monkeypatch.setattr(text, "BATCH_CHARS", chars)
    rng = random.Random(chars)
    letters = "一丁七万丈a1"
    words = [("".join(rng.choice(letters) for _ in range(rng.randint(1, 5))), rng.randint(0, 60)) for _ in range(60)] + [("一" * 30, 2), (None, 5), ("", 3)]
    frequency = {}
    for w, n in words:
        if w:
            frequency[w] = frequency.get(w, 0) + n
    whole = math.log(sum(frequency.values()))
    cost = {w: whole - math.log(max(n, 1)) for w, n in frequency.items()}
    texts = ["".join(rng.choice(letters + " ,") for _ in range(rng.randint(0, 14))) for _ in range(120)] + [None, "", "abc 12", "一" * 31, "丁丁"] + ["一丁七"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "oid long, content string").repartition(3)
    got = text.dictionary_words(df, "content", spark.createDataFrame(words, "word string, frequency long"), "words")
    assert got.columns == ["oid", "content", "words"]
    rows = {r.oid: r for r in got.collect()}
    assert rows.keys() == set(range(len(texts)))
    for i, t in enumerate(texts):
        assert rows[i].content == t
        if t is None:
            assert rows[i].words is None
            continue
        runs = [r for r in re.findall("[一-龥a-zA-Z0-9]+", t) if re.search("[一-龥]", r)]
        want = [w for r in runs for w in split_run(r, with_prefixes(cost), whole)]
        assert sum(cost.get(w, whole) for r in runs for w in split_run(r, with_prefixes(cost), whole)) == pytest.approx(sum(brute(r, cost, whole) for r in runs))
        assert rows[i].words == [w for w in want if re.search("[一-龥]", w) and not re.search("[0-9]", w)]


def test_segmentation_stores_texts_once(spark, monkeypatch, tmp_path):
    """Neither runs nor strings to look up are stored beside the texts, which are compressed."""
    rng = random.Random(5)
    parts = ["".join(rng.choices("一丁七万丈三上下", k=rng.randint(1, 4))) for _ in range(60)]
    words = sorted({"".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(20_000)})
    texts = ["".join(rng.choices(parts, k=300)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "oid long, content string").coalesce(2)
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    out = text.dictionary_words(df, "content", spark.createDataFrame([(w, 1 + len(w)) for w in words], "word string, frequency long"), "words")
    assert ["".join(r.words) for r in out.orderBy("oid").collect()] == texts
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert stored < len("".join(texts).encode()) / 2


@pytest.mark.parametrize("few", [1, 8, 10**9])
def test_runs_are_cut_as_one_by_one(monkeypatch, few):
    """Equal costs, runs of very different lengths, slices, hashes that two words share, words that the filter lets pass by chance."""
    monkeypatch.setattr(text, "FEW_RUNS", few)
    rng = random.Random(few)
    cost = {"".join(rng.choices("一丁七", k=rng.randint(1, 6))): float(rng.randint(1, 3)) for _ in range(150)}
    points, at = text._points(list(cost))
    hashes = np.zeros(len(cost), np.uint64)
    for _, i, h in text.beginnings(points, at[:-1], at[1:]):
        hashes[i] = h
    checks = text.string_checks(*text.hash_sums(points), at[:-1], at[1:])
    false = [(h, c ^ np.uint32(1), 0.0) for h, c in zip(hashes[:40], checks[:40])]  # other words of these hashes
    rows = sorted([*zip(hashes, checks, cost.values()), *false])
    words = text.Words()
    for part in (rows[:70], rows[70:]):
        h, c, p = (np.array(x) for x in zip(*part))
        words.add(pa.RecordBatch.from_pydict({"step": np.diff(h, prepend=np.uint64(0)), "check": c, "cost": p}))
    words.ready()
    runs = ["".join(rng.choices("一丁七万", k=n)) for n in [*range(1, 40), 700, 5000, 3]]
    points, at = text._points(runs)
    cut = text.split_runs(points, at[1:], np.full(1 << text.FILTER_BITS - 3, 255, np.uint8), words, 2.0)
    whole, ends = "".join(runs), [*cut.tolist()[1:], len(points)]
    assert [whole[a:b] for a, b in zip(cut.tolist(), ends)] == [w for r in runs for w in split_run(r, with_prefixes(cost), 2.0)]


def test_segmentation_without_a_dictionary(spark):
    df = spark.createDataFrame([(1, "一丁七")], "oid long, content string")
    none = spark.createDataFrame([], "word string, frequency long")
    assert text.dictionary_words(df, "content", none, "w").first().w == ["一", "丁", "七"]
    assert text.dictionary_words(df.limit(0), "content", none, "w").count() == 0


def test_segmentation_looks_up_in_a_table(spark):
    """The dictionary is joined, whatever its size; nothing but a bit map of fixed size is sent to the tasks."""
    many = spark.range(300_000).select(F.concat(F.lit("丁"), F.translate(F.conv(F.col("id").cast("string"), 10, 8), "01234567", "一七万丈三上下不")).alias("word"), F.lit(3).alias("frequency"))
    df = spark.createDataFrame([(i, "丁七万丈丈") for i in range(50)], "oid long, content string")
    out = text.dictionary_words(df, "content", many, "w")
    assert {tuple(r.w) for r in out.collect()} == {("丁七万丈丈",)}


def test_distinct_comments_move_no_whole_texts(spark):
    rows = [(1, "same text", 5), (1, "same text", 5), (1, "same text", 6), (2, "same text", None), (2, "same text", None), (3, "", 1), (4, "only", 0)]
    comments = spark.createDataFrame(rows, "oid long, content string, created int")
    fresh = new_comments(comments)
    assert sorted(map(tuple, fresh.collect()), key=str) == sorted(set(rows), key=str)
    single = spark.createDataFrame(rows[2:4] + rows[5:], comments.schema)
    assert new_comments(single).count() == 4
    assert "Exchange" not in plan_of(new_comments(single))  # no hash repeats, so no text moves


def test_counted_words_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(text, "WORDS_PER_TASK", 10)
    words = spark.range(1000).selectExpr("id % 300 as oid", "concat('w', id % 7) as word")
    counted = text.counted_words(words, "oid", "word")
    assert "REPARTITION_BY_NUM" in plan_of(counted) and counted.rdd.getNumPartitions() == 100
    assert counted.agg({"n": "sum"}).first()[0] == 1000 and counted.count() == words.distinct().count()


@pytest.mark.parametrize("bound", [1_000_000, 20])
def test_counted_words_move_as_lists(spark, monkeypatch, bound):
    """NULLs, empty words, words with the separator, keys whose rows lie apart, keys with more rows than a task gets."""
    monkeypatch.setattr(text, "WORDS_PER_TASK", bound)
    rows = [("x", i % 7 if i % 11 else None, ["a", "b", "", None, "a\x01b", "\x01", "ü"][i * i % 7]) for i in range(60)]
    rows += [("y" if i % 2 else None, 5, "only") for i in range(50)]
    words = spark.createDataFrame(rows, "batch string, oid long, word string").repartition(3)
    got = text.counted_words(words, "batch", "oid", "word")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*k, n) for k, n in Counter(rows).items()), key=str)


def test_counted_words_shuffle_no_single_words(spark):
    words = spark.range(2000).selectExpr("id div 500 as oid", "concat('w', id) as word")
    plan = text.counted_words(words, "oid", "word")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate explode") < plan.index("Exchange") < plan.index("MapInArrow")  # lists move


def test_handled_comments_move_no_texts(spark, tmp_path):
    rows = [(i, f"text {i}", i) for i in range(20)]
    spark.createDataFrame(rows, "oid long, content string, created int").write.parquet(str(tmp_path / "c"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = new_comments(spark.read.parquet(str(tmp_path / "c")), spark.range(0, 20, 2).withColumnRenamed("id", "oid"))
        assert "BroadcastHashJoin" in plan_of(fresh) and "SortMergeJoin" not in plan_of(fresh)
        assert sorted(r.oid for r in fresh.collect()) == list(range(1, 20, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
