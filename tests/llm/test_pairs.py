import random

import numpy as np
import pytest
from llm_data import awkward, clashing, docs_of, prose
from pyspark.sql import functions as F

from cutline.llm import embedding_dedup, ngram_join, shingles
from cutline.llm.components import components


class Union(dict):
    def top(self, k):
        while self.setdefault(k, k) != k:
            k = self[k]
        return k

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components_against_union_find(spark, shape):
    rng = random.Random(3)
    edges = {
        "random": [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)],
        "path": [(i, i + 1) for i in range(60)][::-1], "star": [(500, i) for i in range(100)] + [(7, 7)], "none": []}[shape]
    union = Union()
    for a, b in edges:
        if a != b:
            union.join(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: union.top(k) for k in list(union)}


def plain_shingles(text):
    words = [w for w in "".join(c if ord(c) not in (*range(9, 14), *range(28, 33)) else " " for c in text).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_shingles_count_like_tuples(monkeypatch):
    texts = [r[1] or "" for r in awkward()] + [prose(2000, 4), "a b c d e a b c d e", "a b c d", "a  b\nc\td"]
    before = [len(shingles.shingle_set(t)) for t in texts]
    assert before == [len(plain_shingles(t)) for t in texts]
    assert (shingles.shingle_set("a b c d") == shingles.shingle_set("a  b\nc\td ")).all()
    whole = shingles.shingle_set(texts[-4])
    monkeypatch.setattr(shingles, "CHUNK", 100)
    assert (shingles.shingle_set(texts[-4]) == whole).all()
    assert [len(shingles.shingle_set(t)) for t in texts] == before


def brute_links(rows, threshold=0.8):
    sets = [plain_shingles(t or "") for _, t in rows]
    links, union = [0] * len(rows), Union()
    for i in range(len(rows)):
        union.top(i)
        for j in range(i):
            if sets[i] and min(len(sets[i]), len(sets[j])) >= threshold * max(len(sets[i]), len(sets[j])):
                common = len(sets[i] & sets[j])
                if common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    union.join(i, j)
    classes = [min(rows[k][0] for k in range(len(rows)) if union.top(k) == union.top(i)) for i in range(len(rows))]
    return links, classes


def near_copies(n, words, seed, changes):
    base = prose(words, seed).split()
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [1024, 48])
def test_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    shared = prose(60, 77)
    texts = near_copies(150, 150, 1, 3) + near_copies(20, 40, 2, 1) + [shared + " " + prose(30, 100 + i) for i in range(120)]
    texts += [t for i in range(30) for t in near_copies(2, 200, 500 + i, 4)]
    rows = [(2000 + i, t, "en", "s", 0) for i, t in enumerate(texts)] + awkward()
    got = {}
    for r in ngram_join.near_duplicates(clashing(docs_of(spark, rows))).collect():
        got.setdefault(r["doc_id"], []).append(r)
    links, classes = brute_links([(r[0], r[1]) for r in rows])
    assert sum(links) > 5000
    for (key, *_), n, c in zip(rows, links, classes):
        assert {(r["n_links"], r["class_id"]) for r in got[key]} == {(n, c)}, key
    kept = [r["class_id"] for group in got.values() for r in group if r["kept"]]
    assert len(kept) == len(set(kept)) == len(set(classes))
    assert all(not r["kept"] or r["doc_id"] == r["class_id"] for group in got.values() for r in group)


def test_join_of_an_empty_table(spark):
    assert ngram_join.near_duplicates(docs_of(spark, [])).count() == 0
    assert ngram_join.near_duplicates(docs_of(spark, [(1, None, "en", "s", 0)])).first()["kept"]


def test_more_runs_for_more_recall():
    assert ngram_join.runs_for(0.9) < ngram_join.runs_for(0.999) < ngram_join.runs_for(0.999, 4)


def test_children_of_a_pair_at_the_threshold():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 1 << 32, (4000, 128), dtype=np.uint64).astype(np.uint32)
    rows, _ = ngram_join._children(np.arange(4000), tokens, 0.8)
    assert len(rows) / 4000 == pytest.approx(1.25, abs=0.1)


def vector_rows(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(120, 16))
    rows = [base[i] for i in range(120)]
    rows += [base[0] + rng.normal(scale=0.02, size=16) for _ in range(700)] + [base[1]] * 40 + [base[2] * 3.0]
    rows += [base[i] + rng.normal(scale=s, size=16) for i in range(3, 60) for s in (0.05, 0.25)]
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 100])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vector_rows()
    odd = [(9000, None, 0), (9001, [], 0), (9002, [0.0] * 16, 0), (9003, [1.0, None] + [0.0] * 14, 0), (9004, [float("nan")] * 16, 0),
           (9005, [float("inf")] + [1.0] * 15, 0), (9006, rows[0][1][:8], 0), (9007, [1e-300] * 16, 0), (9008, [2e300] * 16, 0)]
    frame = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int"))
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(frame).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    union = Union()
    for i, j in zip(*np.nonzero(near)):
        union.join(int(i), int(j))
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (near[i].sum() - 1, union.top(i)), i
        assert got[i]["kept"] == (union.top(i) == i)
    assert all(got[k]["n_links"] == 0 and got[k]["component_id"] == k for k in range(9000, 9007))
    assert got[9007]["component_id"] == got[9008]["component_id"] == 9007
    assert len(got) == len(rows) + len(odd)


def test_vectors_of_an_empty_table(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_recall_of_the_passes_alone(spark):
    """Pairs of single vectors, so that a link only counts if a window held it."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 64))
    other = base + rng.normal(scale=0.3, size=base.shape)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.concatenate([base, other]))]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    u = np.concatenate([base, other])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = int((u @ u.T >= 0.95).sum() - len(u))
    assert want > 1000
    assert got.agg(F.sum("n_links")).first()[0] >= 0.9 * want


def test_vectors_that_share_a_direction_against_brute_force(spark, monkeypatch):
    """A hot topic: any two vectors have a cosine near 0.9, planted pairs one just above the threshold."""
    rng = np.random.default_rng(8)
    topic = rng.normal(size=64) / 8

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    own = unit(rng.normal(size=(5000, 64)))
    other = 0.56 * own + np.sqrt(1 - 0.56**2) * unit(rng.normal(size=own.shape))
    v = unit(np.concatenate([np.sqrt(0.9) * topic / np.linalg.norm(topic) + np.sqrt(0.1) * x for x in (own, other)]))
    near = v @ v.T >= 0.95
    want = near.sum(axis=1) - 1
    assert want.sum() > 6000
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(frame).collect()}
    assert [got[i] for i in range(len(v))] == want.tolist()


@pytest.mark.parametrize("rows", [1, 4096])
def test_windows_reach_across_the_ends_of_tasks(spark, monkeypatch, rows):
    """One pass links the neighbours of its order, however many tasks share it."""
    monkeypatch.setattr(embedding_dedup, "TASK_ROWS", rows)
    monkeypatch.setattr(embedding_dedup, "WINDOW", 16)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    reps = spark.createDataFrame([(8, i, bytearray(x.tobytes())) for i, x in enumerate(v)], "dim int, uid long, vec binary")
    got = embedding_dedup._passes(reps, {8: np.zeros(8)}, len(v), 0.9, 0, 1)
    union = Union()
    for a, b in got.collect():
        union.join(a, b)
    order = np.argsort(embedding_dedup.pass_keys(v, 0), kind="stable")
    pairs = [(order[i], order[j]) for i in range(len(v)) for j in range(max(0, i - 16), i) if v[order[i]] @ v[order[j]] >= 0.9]
    assert len(pairs) > 500
    assert all(union.top(int(a)) == union.top(int(b)) for a, b in pairs)


def test_large_components_are_counted_block_against_block(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "TILE", 30)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(1, 32)) + rng.normal(scale=0.22, size=(600, 32))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    assert 0 < want.min() + want.max() < 2 * 599
    got = embedding_dedup.near_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    assert [r["n_links"] for r in got.orderBy("vec_id").collect()] == want.tolist()


def test_first_passes_grow_with_the_rows():
    few = [embedding_dedup.first_passes(10**e, 0.95) for e in (2, 4, 6, 9)]
    assert few == sorted(few) and few[0] == 2 and 50 < few[-1] < 100


def test_recall_of_pairs_whose_buckets_go_deep(spark, monkeypatch):
    """Pairs near the threshold share their tokens with many other sets, so that buckets are split five levels and more."""
    monkeypatch.setattr(ngram_join, "SMALL", 2)
    rng = np.random.default_rng(4)
    template = rng.integers(0, 1 << 32, 128, dtype=np.uint64).astype(np.uint32)

    def fresh(n):
        return rng.integers(0, 1 << 32, (n, 128), dtype=np.uint64).astype(np.uint32)

    def mixed(base, share):
        return np.where(rng.random(base.shape) < share, base, fresh(len(base)))

    one = mixed(np.tile(template, (1500, 1)), 0.5)
    two = np.concatenate([one[:500], fresh(1000)])
    for i in range(500):  # exactly the agreement of a pair at the threshold, and nothing beyond
        at = rng.permutation(128)[:26]
        two[i, at] = fresh(1)[0, at]
    tokens = np.concatenate([one, two[:500]])
    depths = []
    split = ngram_join._split

    def counted(*args):
        depths.append(args)
        return split(*args)

    monkeypatch.setattr(ngram_join, "_split", counted)
    paths = paths_of_sets(spark, tokens)
    met = [meet(paths, i, 1500 + i) for i in range(500)]
    assert len(depths) >= 4
    assert np.mean(met) >= 0.998


def paths_of_sets(spark, tokens):
    rows = [(i, t.tobytes(), np.packbits(t & 1).tobytes()) for i, t in enumerate(tokens)]
    reps = ngram_join.stored(spark.createDataFrame(rows, "uid long, tokens binary, bits binary"))
    paths = {}
    for r in ngram_join.leaves(reps, 0.8, 0.999).collect():
        bucket, asks = r["path"] >> 1, r["path"] & 1
        assert paths.setdefault(r["uid"], {}).setdefault(bucket, asks) == asks
    return paths


def meet(paths, i, j):
    a, b = paths.get(i, {}), paths.get(j, {})
    return any(a[p] or b[p] for p in a.keys() & b.keys())


@pytest.mark.parametrize("group", [300, 900])
def test_a_group_of_near_copies_is_compared_in_a_few_buckets(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "SMALL", 64)
    rng = np.random.default_rng(5)

    def fresh(n):
        return rng.integers(0, 1 << 32, (n, 128), dtype=np.uint64).astype(np.uint32)

    template = np.tile(fresh(1), (group, 1))
    tokens = np.concatenate([np.where(rng.random(template.shape) < 0.93, template, fresh(group)), fresh(1500)])
    paths = paths_of_sets(spark, tokens)
    pairs = [(i, j) for i, j in rng.integers(0, group, (4000, 2)) if i != j and (tokens[i] == tokens[j]).mean() >= 0.8]
    assert len(pairs) > 3000
    assert np.mean([meet(paths, i, j) for i, j in pairs]) >= 0.999
    assert np.mean([sum(paths[i].values()) for i in range(group)]) < 8  # buckets a set asks in, however large the group is


def test_mean_similarity_of_a_sample():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 32, 128, dtype=np.uint64).astype(np.uint32)
    sets = np.where(rng.random((400, 128)) < 0.9, base, rng.integers(0, 1 << 32, (400, 128), dtype=np.uint64).astype(np.uint32))
    bits = np.packbits((sets & 1).astype(np.uint8), axis=1)
    found = ngram_join.mean_similarity(bits, np.tile(bits[:32], (400, 1, 1)))
    exact = (sets[:, None] == sets[None, :32]).mean(axis=(1, 2))
    assert abs(found.mean() - exact.mean()) < 0.02 and np.abs(found - exact).max() < 0.25


def test_a_repeated_key_with_a_vector_that_is_not_valid(spark):
    rows = [(1, [1.0, 0.0]), (1, None), (1, [0.0, 0.0]), (2, [1.0, 0.01]), (2, [float("nan"), 1.0]), (None, [1.0, 0.0]), (None, None)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in got) == [(0, 0, 0), (0, 0, 0), (1, 0, 1), (1, 0, 1), (1, 1, 1), (2, 0, 2), (2, 1, 1)]
