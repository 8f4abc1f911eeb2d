"""Stages taken over by fingerprint, batches that run twice, snapshots by high-water mark."""

import copy
import datetime
import os
import shutil

import pytest

from cutline.operators.training import fit, raw_scores
from cutline.plans import flows
from cutline.plans.comment_flow import comment_job
from cutline.plans.flows import train_flow
from cutline.plans.queries import small_model_config, tables
from cutline.sources import sinks
from cutline.sources.sinks import path_exists, staged, write_batch
from cutline.sources.snapshots import fingerprint, latest_version, refresh_snapshot

FOLDER = "/root/testdata/sf0.001"


def test_fingerprint_tells_settings_plans_and_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    base = fingerprint({"a": 1, "b": 2}, {"t": df})
    assert base == fingerprint({"b": 2, "a": 1}, {"t": spark.read.parquet(path)})
    others = [fingerprint({"a": 2, "b": 2}, {"t": df}), fingerprint({"a": 1, "b": 2}, {"t": df.where("id > 1")}),
              fingerprint({"a": 1, "b": 2}, {"u": df})]
    spark.range(5, 9).write.mode("append").parquet(path)
    others.append(fingerprint({"a": 1, "b": 2}, {"t": spark.read.parquet(path)}))
    assert len({base, *others}) == 5
    made = [spark.createDataFrame([(i, {"k": i})], "a int, m map<string,int>") for i in (1, 1, 2)]
    one, same, other = (fingerprint({}, {"t": m}) for m in made)
    assert one == same != other


def test_a_stage_of_other_settings_is_made_again(spark, tmp_path):
    path, runs = str(tmp_path / "stage"), []

    def build(n):
        runs.append(n)
        return spark.range(n)

    assert [staged(lambda n=n: build(n), spark, path, True, mark=f"m{n}").count() for n in (3, 3, 4, 3)] == [3, 3, 4, 3]
    assert runs == [3, 4]


def test_a_changed_cutoff_is_computed_again(spark, tmp_path):
    config, folder = small_model_config("purchase"), str(tmp_path / "run")
    first = train_flow(spark, config, tables(spark, FOLDER), folder, with_evaluation=False, snapshot=True)
    assert path_exists(spark, f"{folder}/entities/orders")
    cutoffs = {r[0] for r in first.labels.select("time").distinct().collect()}
    changed = copy.deepcopy(config)
    changed["label_desc"]["cutoff_point"]["cutoff_num"] = 2
    again = train_flow(spark, changed, tables(spark, FOLDER), folder, with_evaluation=False, resume=True, snapshot=True)
    assert {r[0] for r in again.labels.select("time").distinct().collect()} < cutoffs
    assert {r[0] for r in again.features.select("time").distinct().collect()} < cutoffs
    assert {r[0] for r in first.labels.select("time").distinct().collect()} == cutoffs  # still readable


def test_a_resumed_run_takes_over_its_models(spark, tmp_path, monkeypatch):
    config, folder, fits = small_model_config("purchase"), str(tmp_path / "run"), []
    monkeypatch.setattr(flows, "fit", lambda *a, **k: fits.append(1) or fit(*a, **k))

    def scores(config, resume=True, **more):
        run = train_flow(spark, config, tables(spark, FOLDER), folder, with_evaluation=False, resume=resume, **more)
        model = run.models[None]
        return model.spec, model.facts, sorted(map(tuple, raw_scores(model, run.features).collect()))

    first = scores(config, resume=False)
    assert scores(config) == first and len(fits) == 1
    changed = copy.deepcopy(config)
    changed["model_desc"]["model_para"]["iterations"] = 2
    assert scores(changed)[0].rounds == 2 and len(fits) == 2
    assert scores(config) == first and len(fits) == 3  # the model there was of other settings
    shutil.rmtree(f"{folder}/model_facts")  # as after a save that failed
    assert scores(config) == first and len(fits) == 4
    scores(config, hook=lambda matrix: matrix)
    scores(config)
    assert len(fits) == 6


def test_a_repeated_batch_comes_in_once(spark):
    spark.sql("DROP TABLE IF EXISTS words_batched")
    rows = spark.createDataFrame([(1, "good dress", 10), (2, "bad fit", 30), (3, "nice cut", 20)], "oid long, content string, created int")
    comment_job(spark, rows.where("oid < 2"), "words_batched", batch="it's one")
    for _ in range(2):
        comment_job(spark, rows, "words_batched", batch="two")
    want = [(1, "dress", "it's one"), (1, "good", "it's one"), (2, "bad", "two"), (2, "fit", "two"), (3, "cut", "two"), (3, "nice", "two")]
    assert sorted(map(tuple, spark.table("words_batched").collect())) == want

    def fails(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception, match="lost"):
        write_batch(spark.range(3).mapInArrow(fails, "oid long, word string"), "words_batched", "two")
    assert sorted(map(tuple, spark.table("words_batched").collect())) == want
    write_batch(spark.createDataFrame([], "oid long, word string"), "words_batched", "two")
    assert sorted(map(tuple, spark.table("words_batched").collect())) == want[:2]
    spark.sql("DROP TABLE words_batched")


def test_a_batch_is_written_once(spark, monkeypatch):
    """Not beside the table and then into it; what a repeated batch replaces goes, also where the batch reads its own table."""
    def beside(df):
        raise AssertionError("written beside the table")

    monkeypatch.setattr(sinks, "checkpointed", beside, raising=False)
    spark.sql("DROP TABLE IF EXISTS words_once")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "Location long, word string")
    for batch in ("one", "two", "two"):
        write_batch(rows, "words_once", batch)
    home = next(r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED words_once").collect()[::-1] if r["col_name"] == "Location")
    assert len([f for f in os.listdir(home.removeprefix("file:")) if f.startswith("batch")]) == 2
    spark.sql("INSERT INTO words_once PARTITION (batch = 'three') SELECT 7, 'x'")
    write_batch(spark.table("words_once").where("batch = 'three'").selectExpr("Location + 1", "word"), "words_once", "three")
    assert sorted(map(tuple, spark.table("words_once").collect())) == [(1, "a", "one"), (1, "a", "two"), (2, "b", "one"), (2, "b", "two"), (8, "x", "three")]
    with pytest.raises(ValueError, match="columns"):
        write_batch(rows.select("word"), "words_once", "two")
    spark.sql("DROP TABLE words_once")


def test_snapshot_against_a_full_rebuild(spark, tmp_path):
    folder, schema = str(tmp_path / "s"), "k int, t timestamp, n int, v string"

    def day(n):
        return None if n is None else datetime.datetime(2024, 1, n)

    rows = [(1, 1, 0, "a"), (2, 2, 0, "b"), (None, 3, 0, "c"), (3, None, 0, "d"), (4, 3, 5, "e"),
            (4, 3, 6, "f"), (1, 3, 0, "g"), (None, 4, 0, "h"), (5, 5, 0, "i"), (5, 5, 0, "i")]
    data = [(k, day(t), n, v) for k, t, n, v in rows]
    for end in (5, 7, 7, 10):
        out = refresh_snapshot(spark.createDataFrame(data[:end], schema), folder, "k", "t", ["n"])
        want = {}
        for r in sorted(data[:end], key=lambda r: (r[1] or datetime.datetime.min, r[2])):
            want[r[0]] = r
        assert {r["k"]: tuple(r) for r in out.collect()} == want and out.count() == len(want)
    deltas = spark.createDataFrame([(4, day(5), 1, "late"), (6, day(6), 0, "new"), (1, day(2), 0, "too old")], schema)
    got = {r["k"]: r["v"] for r in refresh_snapshot(deltas, folder, "k", "t", ["n"]).collect()}
    assert got == {1: "g", 2: "b", 3: "d", 4: "late", 5: "i", 6: "new", None: "h"}
    before = latest_version(spark, folder)
    refresh_snapshot(spark.createDataFrame([], schema), folder, "k", "t")
    assert latest_version(spark, folder) == before
