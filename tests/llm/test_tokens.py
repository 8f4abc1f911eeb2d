import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import awkward, clashing, docs_of, prose

from cutline.llm import encoding, packing, token_counts, token_output
from cutline.llm.queries import vocabulary


def greedy(word, first, later):
    at, n, pieces = 0, 0, first
    while at < len(word):
        best = max((k for k in range(1, len(word) - at + 1) if word[at : at + k] in pieces), default=0)
        if not best:
            return 1
        at, n, pieces = at + best, n + 1, later
    return n


words = st.binary(min_size=1, max_size=6).map(lambda b: bytes(97 + x % 3 for x in b))


@settings(max_examples=200, deadline=None)
@given(st.sets(words, max_size=12), st.sets(words, max_size=12), st.lists(words, max_size=8).map(b"".join))
def test_automaton_is_greedy(first, later, word):
    assert token_counts.Automaton(first, later).count(word) == greedy(word, first, later)
    assert token_counts.Automaton(first).count(word) == greedy(word, first, first)


def test_token_counts_against_pieces(spark):
    path = vocabulary("byte_bpe_50k.tiktoken")
    pieces = set(token_counts.rank_file(path))
    rows = token_counts.token_counts(clashing(docs_of(spark)), path).collect()
    texts = {r[0]: r[1] or "" for r in awkward()}
    for r in rows:
        if r["doc_id"] in (6, 7, 12):
            continue
        found = token_counts.WORDS.findall(texts[r["doc_id"]])
        assert "".join(found) == texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_words"]) == (sum(greedy(w.encode(), pieces, pieces) for w in found), len(found))
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert token_counts.token_counts(docs_of(spark, []), path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    own = encoding.Encoder(vocabulary(name))
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!!", "'s", "'ll", "12", "½", "_", "|", "%", "中", "́", " ", "\x1c", "\x01", "<|endoftext|>", "I'm", "İ", "Σ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", "x" * 5000, prose(500)]
    own.tokenizer.encode_special_tokens = True
    want = [np.array(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want
    assert own.encode(texts) == want


def test_encoder_with_a_full_memo(monkeypatch):
    monkeypatch.setattr(encoding, "MEMO", 20)
    own = encoding.Encoder(vocabulary("byte_bpe_50k.json"))
    texts = [prose(30, i) for i in range(20)]
    assert [own.encode([t])[0] for t in texts] == [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_looks_up_a_chunk_once_a_call(name):
    class Counted(encoding.Memo):
        looked = 0

        def __getitem__(self, chunk):
            self.looked += 1
            return super().__getitem__(chunk)

    own = encoding.Encoder(vocabulary(name))
    own.memo = Counted(own._ids)
    texts = [prose(200, i % 4) for i in range(40)]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want
    assert own.memo.looked == len(own.memo) < 1000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_cuts_bytes_at_text_and_word_ends(name, monkeypatch):
    monkeypatch.setattr(encoding, "GATHERED", 7)
    own = encoding.Encoder(vocabulary(name))
    texts = ["", "", "ab", ".cd", " ", "\n", "é", "×.", "a×.b", "ÿ÷!", "Ã. Ã", "ªa.", "aª.", "a1.b.c", "я. яa.", " \n\t", "Ø,ø  ", "😀.", "\xa0a. b", "", "x"]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want
    assert own.encode([]) == []


def test_chunks_of_texts():
    texts = ["One, two  three.", "", ".x", "a1.b\n", "ß× ß×."]
    parts, at = encoding.chunks(texts, True)
    assert parts.to_pylist() == ["One", ",", " two", "  three", ".", ".x", "a1.b", "\n", "ß×", " ß×."]
    assert at.tolist() == [0, 5, 5, 6, 8, 10]
    parts, at = encoding.chunks(texts, False)
    assert parts.to_pylist() == ["One", ",", "two", "three", ".", ".x", "a1.b", "ß×", "ß×."]
    assert at.tolist() == [0, 5, 5, 6, 7, 9]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("sizes", [[], [0], [1], [5, 0, 7], [100, 64, 3]])
def test_plane_files_round_trip(bits, sizes):
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4").tobytes() for n in sizes]
    index, ids = token_output.unpack_file(token_output.pack_file(list(range(len(sizes))), parts, bits, block=16))
    assert ids.tobytes() == b"".join(parts)
    assert index["n"].tolist() == sizes and index["key"].tolist() == list(range(len(sizes)))


def test_token_files_of_documents(spark, monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    monkeypatch.setattr(token_output, "RANGE_BYTES", 100_000)
    files = token_output.write_files(clashing(docs_of(spark)), path)
    got = sorted(tuple(r) for r in token_output.read_files(files).collect())
    own, want, start = encoding.Encoder(path), [], 0
    for k, t, *_ in sorted(awkward(), key=lambda r: r[0]):
        ids = own._plain([t or ""])[0] + b"\0\0\0\0"
        want.append((k, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == want
    assert files.count() > 1
    assert token_output.read_files(token_output.write_files(docs_of(spark, []), path)).count() == 0
    rows = [(None, "a b", "en", "s", 1), (-5, "c", "en", "s", 1), (3, "d", "en", "s", 1), (None, None, "en", "s", 1)]
    got = sorted((tuple(r) for r in token_output.read_files(token_output.write_files(docs_of(spark, rows), path)).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, -5, 3] and [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(4)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 255), max_size=300), st.integers(0, 3))
def test_plan_places_every_tail_once(lengths, skew):
    lengths = [max(1, n // (skew + 1)) for n in lengths]
    plan = packing.plan_tails(np.bincount(lengths, minlength=256)[:256], 256, 8)
    ranks, sequences = {}, {}
    for n in lengths:
        pieces = plan.place(n, ranks.get(n, 0))
        ranks[n] = ranks.get(n, 0) + 1
        assert pieces[0][0] == 0 and sum(p[1] for p in pieces) == n
        for _, size, sequence, offset in pieces:
            sequences.setdefault(sequence, []).append((offset, size))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 256
    assert sorted(sequences) == list(range(plan.sequences))


def test_least_squares_finds_an_exact_mix():
    matrix = np.array([[2.0, 0, 1], [0, 1, 1], [0, 1, 0]])
    assert packing.nnls(matrix, matrix @ np.array([3.0, 0, 2])) == pytest.approx([3, 0, 2])
    assert (packing.nnls(matrix, np.array([-1.0, -1, -1])) == 0).all()


def test_packed_documents(spark):
    path = vocabulary("word_bpe_49k.json")
    rows = [*awkward(), *[(1000 + i, prose(40 + 17 * i, i), "en", "s", 0) for i in range(80)]]
    docs = clashing(docs_of(spark, rows))
    got = packing.pack(docs, path).collect()
    own = encoding.Encoder(path)
    texts = {r[0]: r[1] or "" for r in rows}
    for key in {r["doc_id"] for r in got} - {11}:
        pieces = sorted((r for r in got if r["doc_id"] == key), key=lambda r: r["start"])
        ids = [x for r in pieces for x in r["ids"]]
        assert ids == np.frombuffer(own._plain([texts[key]])[0], "<u4").tolist() + [1]
        assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces]])[:-1].tolist()
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["doc_tokens"] == len(ids) for r in pieces)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 2048
    assert len(sequences) <= sum(r["length"] for r in got) / 2048 * 1.1 + 1
    assert packing.pack(docs.limit(0), path).count() == 0


def test_freed_memory_goes_back_after_a_task(monkeypatch):
    """Half of the blocks freed here lie between used ones, so only a trim gives their pages back."""
    from cutline.llm import common

    def resident() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    blocks = [bytearray(os.urandom(1) * 100_000) for _ in range(2000)]
    kept = blocks[1::2]
    del blocks
    before = resident()
    common._give_back()
    assert before - resident() > 50_000_000 and len(kept) == 1000
