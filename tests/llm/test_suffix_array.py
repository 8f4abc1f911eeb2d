import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cutline.llm import suffix_array
from cutline.llm.suffix_array import permuted_prefixes


def check(raw, sigma=256):
    s = np.frombuffer(raw, np.uint8).astype(np.int64) if isinstance(raw, bytes) else np.array(raw, np.int64)
    text = raw if isinstance(raw, bytes) else list(raw)
    sa = suffix_array.suffix_array(s, sigma)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: text[i:])
    plcp = permuted_prefixes(s, sa)
    want = [0] * len(s)
    for a, b in zip(sa.tolist(), sa[1:].tolist()):
        k = 0
        while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        want[b] = k
    assert plcp.tolist() == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60).map(bytes))
def test_against_sorted_suffixes(raw):
    check(raw)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_induction_one_by_one(s):
    check(s, sigma=5000)
    check(s * 100 if len(s) < 40 else s, sigma=3)


@pytest.mark.parametrize("raw", [b"", b"a", b"ab", b"ba", b"a" * 300, b"ab" * 150, b"mississippi", b"abcabcabcabcabd" * 20, bytes(range(255, -1, -1)), b"aab" * 9 + b"\xff" + b"aab" * 9])
def test_shapes(raw):
    check(raw)


def test_long_text_recurses():
    rng = random.Random(4)
    words = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 6))) for _ in range(40)]
    check(b" ".join(rng.choice(words) for _ in range(1500)))
