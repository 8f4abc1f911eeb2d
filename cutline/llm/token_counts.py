"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. A link leads from a node to where matching goes on once the longest piece on
the way has been taken, and carries how many pieces were taken ("popped"). So greedy longest-match-first lengths follow in
one pass over the bytes, without building a piece and without going back.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import heavy, text_batches

MEMO = 500_000  # words whose counts a process keeps
LONGEST = 64  # bytes; longer words are counted anew each time
DEAD = -1


class Automaton:
    """Longest-match counts over a byte vocabulary; ``continuing``: pieces allowed after the first (default: all)."""

    def __init__(self, pieces: Iterable[bytes], continuing: Iterable[bytes] | None = None):
        pieces = set(pieces) - {b""}
        self.go: dict[int, int] = {}  # node * 256 + byte
        ends = [False, False]
        parents: list[tuple[int, int]] = [(DEAD, 0), (DEAD, 0)]
        self.first, self.next = 0, 1  # roots of first and of continuing pieces
        if continuing is None:
            continuing, self.first = pieces, self.next
            pieces = set()
        for root, words in ((0, pieces), (1, set(continuing) - {b""})):
            for word in words:
                node = root
                for byte in word:
                    at = node << 8 | byte
                    child = self.go.get(at)
                    if child is None:
                        child = self.go[at] = len(ends)
                        ends.append(False)
                        parents.append((node, byte))
                    node = child
                ends[node] = True
        self.fail, self.popped = [DEAD] * len(ends), [0] * len(ends)
        depth = [0] * len(ends)
        for node in range(2, len(ends)):  # a child is made after its parent
            depth[node] = depth[parents[node][0]] + 1
        for node in sorted(range(2, len(ends)), key=depth.__getitem__):
            if ends[node]:
                self.fail[node], self.popped[node] = self.next, 1
                continue
            parent, byte = parents[node]
            z, pops = self.fail[parent], self.popped[parent]
            while z != DEAD and (z << 8 | byte) not in self.go:
                pops += self.popped[z]
                z = self.fail[z]
            if z != DEAD:
                self.fail[node], self.popped[node] = self.go[z << 8 | byte], pops

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (the unknown piece) if greedy matching fails, 0 for no bytes."""
        go, fail, popped = self.go, self.fail, self.popped
        node, pops = self.first, 0
        for byte in word:
            while (step := go.get(node << 8 | byte)) is None:
                if fail[node] == DEAD:
                    return 1
                pops += popped[node]
                node = fail[node]
            node = step
        if not word:
            return 0
        while node != self.next:
            if fail[node] == DEAD:
                return 1
            pops += popped[node]
            node = fail[node]
        return pops


#: Letters, digits or signs with the blank before them, and white space: words are counted one by one.
WORDS = re.compile(r" ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+|\w")

def rank_file(path: str) -> list[bytes]:
    """Pieces of a rank file: one base64 piece and its rank a line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Counter:
    def __init__(self, path: str):
        self.automaton = Automaton(rank_file(path))
        self.memo: dict[str, int] = {}

    def count(self, text: str) -> tuple[int, int]:
        """Pieces and words of a text."""
        words = WORDS.findall(text)
        counts = list(map(self.memo.get, words))
        if None in counts:
            if len(self.memo) > MEMO:
                self.memo.clear()
            for i, n in enumerate(counts):
                if n is None:
                    word = words[i]
                    n = self.memo.get(word)
                    if n is None:
                        n = self.automaton.count(word.encode("utf-8", "surrogatepass"))
                        if len(word) <= LONGEST:
                            self.memo[word] = n
                    counts[i] = n
        return sum(counts), len(words)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_tokens, n_words, n_bytes, by the vocabulary file at ``path`` (the same on every machine).

    Null and empty texts have no tokens. Rows may repeat; each is counted. No shuffle; a task holds one batch of texts and the
    bounded memo. Other columns are not read.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = heavy(("pieces", path), lambda: Counter(path))
        for batch in batches:
            found = [counter.count(t) if t else (0, 0) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64()), batch.column("__bytes")],
                [key, "n_tokens", "n_words", "n_bytes"])

    narrow = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("__text")).withColumn("__bytes", F.octet_length("__text").cast("long"))
    return text_batches(narrow, run, f"`{key}` {kind}, n_tokens long, n_words long, n_bytes long", keeps=True)
