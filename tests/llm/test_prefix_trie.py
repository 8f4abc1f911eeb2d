import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.llm import prefix_trie

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        convs[c] = said.get(base, [])[:h] + turns[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1]) if node else 0
    return sorted(((min(of), len(n), min(members[n[:-1]]) if n else None, len(of), len(children[n]), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, of in members.items()), key=str)


def trie(spark, rows, partitions=None, **kw):
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("c", "depth", "k1", "up", "band", "h", "i", "u", "n_convs")})
    out = prefix_trie.prefix_trie(df.repartition(partitions) if partitions else df, **kw)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def talks(n, seed, longest=9, words="abc"):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["u", "v"]) if rng.random() < 0.2 else "u", rng.choice(words) * rng.randint(1, 2))
            for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("rebuild", [True, False])
def test_against_brute_force(spark, rebuild):
    rows = talks(330, 1)
    assert trie(spark, rows, rebuild=rebuild) == brute(rows, rebuild)


@pytest.mark.parametrize("height", [2, 3])
def test_deep_conversations_over_several_bands(spark, monkeypatch, height):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", 4)
    rows = talks(30, 2, longest=8, words="ab") + [(c, t, "u", "ab"[t % 7 == c % 3]) for c in (100, 101, 140, 201) for t in range(70)]
    assert trie(spark, rows, height=height) == brute(rows)


def test_awkward_rows(spark):
    rows = [(5, None, None, None), (5, 1, "u", ""), (5, 0, "u", None), (6, 0, None, ""), (6, 1, "", "x"), (None, 0, "u", "x"), (None, None, None, None),
            (100, 0, "u", "é日"), (100, 0, "u", "é日"), (100, 0, "v", "tie"), (100, 3, "u", "z" * 50_000), (101, 7, "u", "é日"), (199, 0, "u", "q"), (299, 1, "u", "q"),
            (-5, 0, "u", "x"), (-150, 0, "u", "x"), (-100, 0, "u", "y")]
    assert [r[:6] for r in trie(spark, rows) if r[1] == 0] == [r[:6] for r in brute(rows) if r[1] == 0]  # equal turns go by hash
    without_ties = [r for r in rows if r != (100, 0, "v", "tie")]
    assert trie(spark, without_ties) == brute(without_ties)
    assert trie(spark, rows, partitions=7) == trie(spark, list(reversed(rows)))
    assert trie(spark, []) == []


def test_a_conversation_over_many_ranges(spark):
    rows = [(7, t, "u", str(t % 5)) for t in range(3000)] + [(7, 50, "u", "same")] * 500 + talks(20, 3)
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, TURNS).repartition(5), "conv_id", "turn", "role", "text")
    got = sorted((r["c"], r["i"]) for r in turns.collect())
    want = sorted((c, i + 1) for c in {r[0] for r in rows} for i in range(sum(r[0] == c for r in rows)))
    assert got == want
