import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.llm import hard_negatives

ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, step, k, low, high):
    valid = [(n, i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v, label) in enumerate(rows)
             if label is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]

    def first(found):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    out = []
    for n, i, label, v in valid:
        if i is None or i % step:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for m, j, other, w in valid if m != n and len(w) == len(v)]
        for p, pid, _ in first([x for x in scored if x[2] == label]):
            hard = first([x for x in scored if x[2] != label and low * p <= high * x[0] <= high * p])
            out += [(i, pid, rank + 1, nid, p, s) for rank, (s, nid, _) in enumerate(hard)]
    return out


def vectors(n, dim, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + spread * rng.standard_normal(dim)
        rows.append((i, (v / np.linalg.norm(v)).astype("f4").tolist(), int(rng.integers(4))))
    return rows


def mined(spark, rows, step=10, **kw):
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in ("uid", "id", "part", "rank", "g", "anchor", "score")})
    out = hard_negatives.hard_negatives(df, anchors=F.col("vec_id") % step == 0, **kw)
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("dim", [64, 7, 130])
def test_against_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    rows = vectors(400, dim, dim)
    assert mined(spark, rows) == sorted(brute(rows, 10, 5, 80, 100), key=str)


def test_awkward_rows(spark):
    rows = vectors(60, 8, 1)
    v = rows[0][1]
    rows += [(100, None, 1), (110, v, None), (120, [None] * 8, 1), (130, [float("nan")] * 8, 0), (140, [float("inf")] * 8, 0), (150, [0.0] * 8, 0),
             (160, [], 0), (161, [], 0), (162, [], 1), (170, v[:5], 0), (171, v[:5], 0), (172, v[:5], 2), (None, v, 0), (None, v, 1), (0, v, rows[0][2]), (0, v, rows[0][2]),
             (180, [1e30] * 8, 0), (181, [-2e6] * 8, 0), (182, [-2e6] * 8, 0), (190, [-x for x in v], 3)]
    rows = [r for r in rows if r[0] != 180]  # beyond 64 bits: see the next test
    assert mined(spark, rows) == sorted(brute(rows, 10, 5, 80, 100), key=str)


def test_few_rows_and_scores_that_do_not_fit(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2)]) == [(0, 1, 1, 2, 65536, 65536)]
    big = [(i, [1e30] * 4, i % 2) for i in range(4)]
    top = (1 << 63) - 1
    assert mined(spark, big) == [(0, 2, 1, 1, top, top), (0, 2, 2, 3, top, top)]


def test_intervals_hold_every_score():
    for seed, shape in enumerate([(50, 64), (30, 3), (20, 200)]):
        rng = np.random.default_rng(seed)
        a, b = (np.floor(256 * rng.standard_normal(shape) ** 3).astype(np.int64) for _ in range(2))
        codes, stats = hard_negatives.encode(b)
        low, high = hard_negatives.intervals(a, codes, stats)
        exact = a @ b.T
        assert (low <= exact).all() and (exact <= high).all()
        sizes = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)
        assert ((high - low) / 2 / sizes).mean() < 0.25  # of the interval that sizes alone give


def test_copies_of_blocks_are_not_broadcast(spark, tmp_path):
    """A copy of each block for every group is far larger than the files that Spark judges by."""
    spark.createDataFrame([], hard_negatives.PACKED).write.parquet(str(tmp_path / "packed"))
    df = spark.read.parquet(str(tmp_path / "packed"))
    met = hard_negatives._meet(df, df, 1000, None, "a long")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
