import hashlib
import random

import numpy as np
import pytest
from llm_data import awkward, clashing, docs_of, prose
from pyspark.sql import functions as F

from cutline.llm import passage_dedup, queries

LENGTH = 100


def brute(rows):
    """Spans by (key, text); rows that repeat both are one document, equal keys go by Spark's hash of the text, given as third."""
    seen, out = set(), {}
    for i, text, _ in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        raw, gone = (text or "").encode(), []
        for p in range(len(raw) - LENGTH + 1):
            if raw[p : p + LENGTH] in seen:
                gone.append(p)
            seen.add(raw[p : p + LENGTH])
        spans = []
        for p in gone:
            if spans and p <= spans[-1][1]:
                spans[-1][1] = p + LENGTH
            else:
                spans.append([p, p + LENGTH])
        out[i, text] = (len(raw), [tuple(s) for s in spans])
    return out


def compare(spark, rows, partitions=3):
    df = docs_of(spark, rows)
    hashes = {(r[0], r[1]): r[2] for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    want = brute([(r[0], r[1], hashes[r[0], r[1]]) for r in rows])
    left = passage_dedup.remove_repeats(clashing(df).repartition(partitions))
    assert left.columns == ["doc_id", "n_bytes", "spans", "kept"]
    got = sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in left.collect()), key=str)
    full = []
    for i, text, *_ in rows:
        n, spans = want[i, text]
        edges = [0, *(e for s in spans for e in s), n]
        raw = (text or "").encode()
        full.append((i, n, spans, b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))))
    assert got == sorted(full, key=str)


def shared(n, seed, passages=4):
    rng = random.Random(seed)
    common = [prose(rng.randint(12, 60), 1000 + seed * 10 + i) for i in range(passages)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(1, 40), 5000 + seed + i)]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(common)[rng.randint(0, 40) :], prose(rng.randint(0, 20), 9000 + i)]
        rows.append((i, " ".join(parts), "en", "a", 0))
    return rows


def test_passages_against_brute_force(spark):
    compare(spark, shared(150, 1))


@pytest.mark.parametrize("group", [1, 3])
def test_frequent_anchors_and_full_groups(spark, monkeypatch, group):
    monkeypatch.setattr(passage_dedup, "GROUP", group)
    monkeypatch.setattr(passage_dedup, "SHARD", 2000)
    monkeypatch.setattr(passage_dedup, "SAMPLE", 2)
    monkeypatch.setattr(passage_dedup, "FREQUENT", 2)
    monkeypatch.setattr(passage_dedup, "HELD_ROWS", 50)
    compare(spark, shared(120, 2, passages=2), partitions=6)


def test_awkward_documents(spark, monkeypatch):
    monkeypatch.setattr(passage_dedup, "PIECE", 700)
    line = "all work and no play makes jack a dull boy, " * 3
    rows = [r for r in awkward() if r[0] not in (6, 7)] + [(6, prose(2000, 9), "en", "a", 0), (7, prose(2000, 9) + " end", "en", "a", 0)] + [
        (20, line * 4, "en", "a", 0), (21, "ab" * 300, "en", "a", 0), (22, "é日本" * 120, "en", "a", 0), (23, "x" + "é日本" * 60, "en", "a", 0),
        (24, prose(99, 5)[:99], "en", "a", 0), (25, prose(99, 5)[:99], "en", "a", 0), (26, prose(99, 5)[:100], "en", "a", 0), (27, prose(99, 5)[:100], "en", "a", 0),
        (28, "z" + prose(99, 5)[:100], "en", "a", 0), (None, prose(300, 3), "en", "a", 0), (None, line + "other", "en", "a", 0), (None, None, "en", "a", 0),
        (30, prose(60, 7), "en", "a", 0), (30, prose(60, 7) + " " + line, "en", "a", 0), (30, prose(60, 7), "en", "a", 0)]
    compare(spark, rows)


def test_empty_tables(spark):
    assert passage_dedup.remove_repeats(docs_of(spark, [])).count() == 0
    compare(spark, [(1, None, None, None, None), (2, "", None, None, None)])


def test_windows_near_the_anchor_limit():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, rng.integers(0, 400)).astype(np.uint8)) for _ in range(60)]
    total = 0
    for numbers, bases, parts in passage_dedup.pieces_of(texts):
        piece, first, n, ahead, key, seg = passage_dedup.segments(parts)
        assert (ahead >= 0).all() and (ahead <= LENGTH - passage_dedup.GRAM).all() and (n >= 1).all() and (n <= ahead + 1).all()
        total += int(n.sum())
    assert total == sum(max(0, len(t) - LENGTH + 1) for t in texts)


def test_query_digests(spark, tmp_path):
    rows = shared(40, 5)
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op12_passage_dedup(spark, str(tmp_path)).collect()}
    for (i, text), (n, spans) in brute([(r[0], r[1], 0) for r in rows]).items():
        raw = bytearray(text.encode())
        for a, b in reversed(spans):
            del raw[a:b]
        assert tuple(got[i])[1:] == (n, n - len(raw), len(spans), hashlib.sha256(raw).hexdigest())
