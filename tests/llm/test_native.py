import hashlib
import zlib

import pytest
from llm_data import awkward, clashing, docs_of

from cutline.llm import exact_dedup, mixing, sharding


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 100, 5000])
def test_shards_follow_the_published_generator(spark, shards):
    keys = [0, 1, 2, -1, 7, 12345678901, 2**63 - 1, -(2**63), *range(100, 200)]
    got = sharding.with_shard(spark.createDataFrame([(k,) for k in keys], "k long"), "k", shards, grown="g").collect()
    assert {r["k"]: r["shard"] for r in got} == {k: jump(k, shards) for k in keys}
    assert all(r["g"] == jump(r["k"], shards + 1) and (r["g"] == r["shard"] or r["g"] == shards) for r in got)


def test_shards_of_documents(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 4)
    docs = clashing(docs_of(spark))
    rows = sharding.shard_documents(docs, 3).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in awkward())
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    texts = {r[0]: (r[1] or "").encode() for r in awkward()}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    assert sharding.shard_documents(docs.limit(0), 3).count() == 0


def test_copies_against_brute_force(spark):
    docs = clashing(docs_of(spark))
    rows = exact_dedup.mark_copies(docs).collect()
    texts = [(r[0], r[1] or "") for r in awkward()]
    for r in rows:
        text = dict(texts)[r["doc_id"]]
        same = [k for k, t in texts if t == text]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(same), len(same), r["doc_id"] == max(same))
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({max(k for k, t in texts if t == text) for _, text in texts})
    assert {r["kept"] for r in kept.collect()} == {"x"}
    assert exact_dedup.mark_copies(docs.limit(0)).count() == 0


def test_copies_with_shuffled_groups_and_equal_lengths(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_GROUPS", 0)
    prefix = "p" * exact_dedup.PREFIX
    rows = [(i, prefix + "ab"[i % 2] * (1 + i % 3), "en", "s", 0) for i in range(60)] + [(100 + i, "q" * (exact_dedup.PREFIX + 1), "en", "s", 0) for i in range(3)]
    got = exact_dedup.mark_copies(docs_of(spark, rows)).collect()
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t, []).append(i)
    want = {i: max(group) for group in by_text.values() for i in group}
    assert {r["doc_id"]: r["keep_id"] for r in got} == want


def raked(cells, targets, budget, rounds):
    now = {c: t * budget / sum(cells.values()) for c, t in cells.items()}
    for _ in range(rounds):
        for place, shares in enumerate(targets):
            sums = {}
            for c, w in now.items():
                sums[c[place]] = sums.get(c[place], 0) + w
            now = {c: min(cells[c], w * (shares.get(c[place], 0) * budget / sums[c[place]] if sums[c[place]] > 0 else 0)) for c, w in now.items()}
    return now


def test_raking_meets_the_targets(spark):
    cells = {("a", "en", "x"): 900, ("a", "fr", "x"): 300, ("b", "en", "y"): 200, ("b", "fr", "x"): 400, ("c", "en", "x"): 100, ("c", "fr", "y"): 700}
    frame = spark.createDataFrame([(*c, t) for c, t in cells.items()], "source string, lang string, topic string, tokens long")
    targets = [{"a": 0.3, "b": 0.3, "c": 0.4}, {"en": 0.4, "fr": 0.6}, {"x": 0.6, "y": 0.4}]
    frames = {m: spark.createDataFrame(list(t.items()), f"{m} string, share double") for m, t in zip(mixing.MARGINALS, targets)}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in mixing.rake(frame, frames, 0.4, 6).collect()}
    want = raked(cells, targets, 0.4 * sum(cells.values()), 6)
    assert got == pytest.approx(want)
    total = sum(got.values())
    assert sum(w for c, w in got.items() if c[2] == "x") / total == pytest.approx(0.6, abs=0.01)


def test_mixing_takes_awkward_rows(spark):
    docs = clashing(docs_of(spark))
    rows = mixing.mix(docs, rounds=2).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in awkward())
    assert all(0 <= r["probability"] <= 1 and r["kept"] == (r["draw"] < r["probability"]) for r in rows)
    assert {r["source"] for r in rows} >= {"(none)"} and {r["lang"] for r in rows} >= {"(none)"}
    assert mixing.mix(docs.limit(0), rounds=1).count() == 0
