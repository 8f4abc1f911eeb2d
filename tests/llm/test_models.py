import math
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_data import WORDS, awkward, clashing, docs_of, prose

from cutline.llm import common, language_id, quality

FRENCH = "le la de et un être avoir que pour dans ce il qui ne sur se pas plus pouvoir par".split()


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = language_id.Network.fresh(["a", "b", "c"], 4, 0)
    x, y = rng.integers(0, 257, (10, 6)).astype(np.int16), np.array([0, 1, 2, 0, 1, 2])
    _, grads = net.gradients(x, y)
    for w, g in zip(net.weights(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = net.gradients(x, y)[0]
        w[at] = old - 1e-2
        down = net.gradients(x, y)[0]
        w[at] = old
        assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.02)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predict(docs, language_id.train(docs))
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95


def test_language_of_awkward_texts(spark):
    more = [(100 + 2 * i + k, prose(50, i, w), lang, "s", 0) for i in range(20) for k, (lang, w) in enumerate([("en", WORDS), ("fr", FRENCH)])]
    docs = clashing(docs_of(spark, awkward() + more))
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5, 10))
    assert all(got[k]["lang_pred"] != "und" for k in (1, 6, 8, 13))
    nothing = docs_of(spark, [])
    assert language_id.train(nothing) is None
    assert language_id.predict(nothing, None).count() == 0
    unlabelled = docs_of(spark, [(1, "some words", None, "s", 0)])
    assert language_id.predict(unlabelled, language_id.train(unlabelled)).first()["lang_pred"] == "und"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute_perplexity(trusted, text):
    grams = {}
    for t in trusted:
        t = "^^^" + t
        for i in range(3, len(t)):
            grams[t[i - 3 : i + 1]] = grams.get(t[i - 3 : i + 1], 0) + 1
    levels, now = [], grams
    for _ in range(4):
        levels.append(now)
        rest = {}
        for g in now:
            rest[g[1:]] = rest.get(g[1:], 0) + 1
        now = rest

    def probability(gram, n):
        if n == 4:
            return 1 / quality.POINTS
        level = levels[n]
        cuts = quality.discounts({k: sum(v == k for v in level.values()) for k in (1, 2, 3, 4)})
        same = [v for g, v in level.items() if g[:-1] == gram[:-1]]
        lower = probability(gram[1:], n + 1)
        if not same:
            return lower
        own = level.get(gram, 0)
        cut = cuts[min(own, 3) - 1] if own else 0
        return (own - cut) / sum(same) + sum(cuts[min(v, 3) - 1] for v in same) / sum(same) * lower

    padded = "^^^" + text
    return math.exp(-sum(math.log(probability(padded[i - 3 : i + 1], 0)) for i in range(3, len(padded))) / len(text))


@pytest.mark.parametrize("counted, batch", [(1 << 20, 1 << 22), (7, 50)])
def test_perplexities_against_brute_force(spark, monkeypatch, counted, batch):
    monkeypatch.setattr(quality, "COUNTED", counted)
    monkeypatch.setattr(quality, "BATCH", batch)
    texts = [prose(12, i) for i in range(8)] + ["naïve café 日本語 日本", "z", "zzzzzz", "日本", "the\U0001F600of"]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(20, None, "en", "a", 0), (21, "", None, "a", 0)]
    trusted = [0, 1, 2, 3, 8]
    got = {r["doc_id"]: r for r in quality.judge(docs_of(spark, rows).repartition(3), labels_of(spark, [(i, 1, 0) for i in trusted])).collect()}
    assert got.keys() == {r[0] for r in rows} and got[20]["perplexity"] is None and got[21]["n_chars"] == 0
    for i, t in enumerate(texts):
        assert got[i]["perplexity"] == pytest.approx(brute_perplexity([texts[k] for k in trusted], t), rel=1e-6)
        assert got[i]["n_chars"] == len(t)


def test_texts_are_stored_once_and_not_shuffled_again(spark):
    docs = docs_of(spark, [(i, prose(300, i), "en", "a", 0) for i in range(40)]).repartition(2)
    tables = quality.shares(quality.gram_counts(docs))
    narrow = docs.select("doc_id", "lang", quality._mark(docs).alias("mark"), docs["text"].alias("__text"))
    plan = quality.scored(narrow, tables, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(batch") == 1 and "Bucketed: true" in plan


def test_a_large_object_goes_when_a_stage_does_not_use_it(spark):
    def seen(batches, builds):
        for batch in batches:
            if builds:
                common.heavy("large", lambda: bytearray(10))
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid() * 10 + len(common._heavy)] * batch.num_rows, pa.int64())], ["id"])

    def workers(builds, keeps):
        rows = common.text_batches(spark.range(64, numPartitions=8), lambda batches: seen(batches, builds), "id long", keeps=keeps)
        return {(r["id"] // 10, r["id"] % 10) for r in rows.collect()}

    built = {pid for pid, _ in workers(True, True)}
    kept = {n for pid, n in workers(False, True) if pid in built}
    dropped = {n for pid, n in workers(False, False) if pid in built}
    assert (kept <= {1}, dropped) == (True, {0}), (built, kept, dropped)


@pytest.mark.parametrize("dense", [1 << 22, 1 << 12, 0])
def test_distinct_grams_with_and_without_sorting(monkeypatch, dense):
    monkeypatch.setattr(quality, "DENSE", dense)
    s = np.array([quality.POINTS] * 3 + [ord(c) for c in prose(40, 1) + "日本語😀é日本"])
    grams, which = quality._ranked(s)
    assert (grams[which] == np.lib.stride_tricks.sliding_window_view(s, quality.ORDER)).all()
    assert list(map(tuple, grams.tolist())) == sorted(set(map(tuple, grams.tolist())))


def test_each_row_has_its_own_verdict(spark):
    good = [(i, prose(200, i), "en", "a", 0) for i in range(20)]
    junk = "".join(np.random.default_rng(1).choice(list("qxzjkvwpm"), 600))
    docs = docs_of(spark, [*good, (3, junk, "en", "a", 0), (None, junk, "en", "a", 0), (None, prose(200, 50), "en", "a", 0), (4, None, "en", "a", 0)])
    kept = quality.keep_good(clashing(docs), labels_of(spark, [(r[0], 1, 0) for r in good[5:]]), margin=1.5)
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect()) == [(r[0], r[1]) for r in good]
    assert [r["text"] for r in kept.where("doc_id is null").collect()] == [prose(200, 50)]


def test_junk_goes_and_clean_text_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs, labels).join(labels, "doc_id").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(clean) >= 0.97
    assert np.mean(junk) <= 0.35


def test_quality_takes_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "COUNTED", 1000)
    docs = clashing(docs_of(spark))
    labels = labels_of(spark, [(1, 1, 0), (2, 1, 0), (6, 1, 0), (11, 1, 0), (8, 1, 0), (8, 0, 0), (None, 1, 0), (12, 0, 0), (14, 1, None)])
    rows = quality.judge(docs, labels).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in awkward())
    got = {r["doc_id"]: r for r in rows}
    assert not got[3]["kept"] and not got[4]["kept"] and got[3]["perplexity"] is None
    assert got[1]["kept"] and got[6]["kept"] and got[9]["threshold"] is not None and not got[12]["kept"]
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert all(r["kept"] == (r["perplexity"] is not None) for r in quality.judge(docs, labels_of(spark, [])).collect())
    assert quality.judge(docs.limit(0), labels).count() == 0


def script(first, n, seed, letters=40):
    rng = np.random.default_rng(seed)
    words = ["".join(chr(first + c) for c in np.random.default_rng(k).integers(0, letters, 5)) for k in range(30)]
    return " ".join(words[k] for k in rng.integers(0, 30, n))


def test_several_alphabets_are_judged(spark):
    """Mostly Latin trusted text: two other scripts have perplexities of their own, shuffled letters go."""
    latin = "".join(chr(c) for c in range(33, 127))
    rows = [(i, prose(300, i) + latin, "en", "a", 0) for i in range(40)]
    junk = {}
    for k, (first, lang) in enumerate([(0x430, "ru"), (0x4E00, "zh")]):
        rows += [(100 * (k + 1) + i, script(first, 40, i), lang, "a", 0) for i in range(30)]
        for i in range(5):
            t = list(script(first, 40, 900 + i))
            np.random.default_rng(i).shuffle(t)
            junk[1000 * (k + 1) + i] = "".join(t)
            rows.append((1000 * (k + 1) + i, "".join(t), lang, "a", 0))
    docs, labels = docs_of(spark, rows + [(5000, None, "en", "a", 0), (5001, "", None, "a", 0)]), labels_of(spark, [(r[0], 1, 0) for r in rows if r[0] < 1000 and r[0] % 3])
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert not any(got[k]["kept"] for k in junk)
    assert np.mean([got[r[0]]["kept"] for r in rows if r[0] < 1000 and r[0] % 3]) >= 0.97
    for k in (1, 2):
        clean = [got[r[0]]["perplexity"] for r in rows if r[0] // 100 == k]
        assert min(got[i]["perplexity"] for i in junk if i // 1000 == k) > 2 * max(clean)
