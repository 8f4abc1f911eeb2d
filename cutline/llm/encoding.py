"""Exact token ids of whole texts, with a bounded memo of words in front of the tokenizer.

The pre-tokenizers of both vocabularies never join what stands before a blank to what stands after it, nor a letter run
that ends in a Latin letter to ASCII punctuation behind it. So a text can be cut there, each distinct chunk is encoded once per process, and the ids
of a text are those of its chunks in order. Texts with other white space than blank, tab and line ends are encoded whole.
Cuts are found in the bytes of all texts of a call, whose distinct chunks are then looked up once each.
"""

from __future__ import annotations

import itertools
import os
import re
import struct

import numpy as np
import pyarrow as pa

from cutline.llm.common import heavy

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO = 500_000  # chunks kept per process, some 100 MB; a full memo is halved
LONGEST = 64  # longer chunks are not kept
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
BEYOND_LATIN = re.compile("[^\x00-\xff]")
SIMPLE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")  # one pre-token of its own
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

OTHER, SPACE, LETTER, MARK = range(4)
KINDS = bytearray(256)  # of a byte; Latin letters beyond ASCII are 0xC3 and a byte behind it
for _kind, _bytes in ((SPACE, b" \n\t\r"), (LETTER, bytes([*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)])), (MARK, b".,!?%$&*#")):
    for _byte in _bytes:
        KINDS[_byte] = _kind
GATHERED = 1 << 18  # chunks whose ids are put in order at a time

PACKERS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def chunks(texts: list[str], spaces: bool) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts in order, and the place of each text's first chunk (one more at the end).

    A chunk is white space and what follows it up to the next, cut once more where a mark follows Latin letters alone.
    ``spaces=False`` leaves the white space out.
    """
    column = pa.array(texts, pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "<i8", len(texts) + 1)
    data = np.frombuffer(data, np.uint8, at[-1]) if at[-1] else np.zeros(0, np.uint8)
    kinds = np.frombuffer(data.tobytes().translate(KINDS), np.uint8).copy()
    sign = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the signs of multiplication and division
    kinds[1:][sign] = OTHER
    ends = np.flatnonzero(kinds != LETTER)
    kind = kinds[ends]
    after_space = np.concatenate([[True], kind[:-1] == SPACE])[: len(ends)]  # what ends here began behind white space
    letters = np.diff(ends, prepend=-1) > 1
    space = kind == SPACE
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    first[ends[(kind == MARK) & after_space & letters]] = True
    if spaces:
        first[ends[space & (letters | ~after_space)]] = True
    else:
        first[ends[space] + 1] = True
        kept = kinds != SPACE
        data, first = data[kept], np.append(first[:-1][kept], True)
        at = np.concatenate([[0], np.cumsum(kept)])[at]
    bounds = np.flatnonzero(first)
    found = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(data))
    return found, np.searchsorted(bounds, at)


def encoder(path: str) -> "Encoder":
    """One encoder per process and vocabulary file."""
    return heavy(("encoder", path), lambda: Encoder(path))


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, without special tokens; their strings are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memo = Memo(self._ids)
        self.spaces = bool(self._plain([" \n"])[0])  # else the vocabulary drops white space
        self.lower = self._plain(["AbC"]) == self._plain(["aBc"])
        self.letters = self._byte_letters()
        self.tokenize = self.tokenizer.model.tokenize  # each look at ``model`` would make a new object
        self.blank = self.letters[32]
        self.ascii = all(self.letters[i] == chr(i) for i in map(ord, "ABCXYZabcxyz")) and len(self.blank) == 1
        samples = [" word", " Über", " naïveté", "Straße", "ÀÿØ", " x"]
        self.direct = False
        self.direct = all(self._model(c) == self._plain([c])[0] for c in samples if self._fits(c))

    def _byte_letters(self) -> dict[int, str]:
        """The signs that stand for the bytes of Latin letters and the blank in the vocabulary."""
        from tokenizers import pre_tokenizers

        level, out = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), {}
        for text in (" ", *map(chr, range(65, 123)), *map(chr, range(128, 256))):
            signs = level.pre_tokenize_str(text)[0][0]
            out.update(zip(text.encode(), signs))
        return out

    def _fits(self, chunk: str) -> bool:
        return SIMPLE.fullmatch(chunk) is not None and (self.spaces or chunk[0] != " ")

    def _model(self, chunk: str) -> bytes:
        """Ids of a chunk that is one pre-token, from the merges alone."""
        if self.lower:
            chunk = chunk.lower()
        if self.ascii and chunk.isascii():
            signs = self.blank + chunk[1:] if chunk[0] == " " else chunk
        else:
            signs = chunk.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(signs)]
        return PACKERS[len(ids)](*ids) if len(ids) < len(PACKERS) else np.array(ids, "<u4").tobytes()

    def _plain(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _ids(self, chunk: str) -> bytes:
        """Ids of one chunk: plain words from the merges alone, all else by the whole tokenizer."""
        if not self.direct or not self._fits(chunk):
            if self.direct and self.spaces and chunk[0] in "\n\t" and LETTERS.fullmatch(chunk, 1):
                return self._plain([chunk[0]])[0] + self._model(chunk[1:])
            return self._plain([chunk])[0]
        return self._model(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        whole, cut = {}, []
        for i, text in enumerate(texts):
            if ODD_SPACE.search(text):
                whole[i], text = self._plain([text])[0], ""
            elif self.lower and not BEYOND_LATIN.search(text):
                text = text.lower()
            cut.append(text)
        found, at = chunks(cut, self.spaces)
        coded = found.dictionary_encode()
        known = [self.memo[chunk] for chunk in coded.dictionary.to_numpy(zero_copy_only=False)]  # faster than to_pylist
        if len(self.memo) > MEMO:
            self.memo.shrink()
        ids, ends = in_order(known, coded.indices.to_numpy())
        ends = (4 * ends[at]).tolist()
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(ends, ends[1:]))]


def in_order(known: list[bytes], order: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids of the chunks ``known[order[0]]``, ``known[order[1]]`` and so on, and the number of ids before each and after all."""
    flat = np.frombuffer(b"".join(known), "<u4")
    sizes = np.fromiter(map(len, known), "<i8", len(known)) >> 2
    starts = np.cumsum(sizes) - sizes
    ends, parts = np.concatenate([[0], np.cumsum(sizes[order])]), []
    for a in range(0, len(order), GATHERED):
        part = order[a : a + GATHERED]
        shift = starts[part] + ends[a] - ends[a : a + len(part)]
        places = np.repeat(shift, sizes[part])
        places += np.arange(len(places))
        parts.append(flat[places].tobytes())
    return b"".join(parts), ends


class Memo(dict):
    """Ids by chunk, filled on demand. A full memo loses what it met last: the frequent chunks came early."""

    def __init__(self, ids):
        super().__init__()
        self.ids = ids

    def __missing__(self, chunk: str) -> bytes:
        found = self.ids(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = found
        return found

    def shrink(self) -> None:
        kept = list(itertools.islice(self.items(), MEMO // 2))
        self.clear()
        self.update(kept)
