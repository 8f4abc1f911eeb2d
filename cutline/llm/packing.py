"""Packing token sequences by non-negative least squares on the histogram of lengths.

A document is cut into full windows and one tail. Tails are counted by length class (steps of ``UNIT`` tokens). All
combinations of up to three classes that fill a window are enumerated, and non-negative least squares finds how often to
use each so that the histogram is met. Counts are rounded down; what they leave is packed greedily, one tail after the
other, cut where a window ends. Everything a tail needs to find its place follows from its length and its rank among the
tails of that length, so only counts are gathered: at most one per length and partition, 2,048 on the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import stored, text_batches
from cutline.llm.encoding import encoder

WINDOW = 2048
UNIT = 16
DEPTH = 3


def combinations(classes: int) -> np.ndarray:
    """Up to three class numbers (zero: none), descending, that sum to ``classes``."""
    out = [(classes, 0, 0)]
    out += [(a, classes - a, 0) for a in range((classes + 1) // 2, classes)]
    for a in range(1, classes):
        for b in range(1, a + 1):
            c = classes - a - b
            if 1 <= c <= b:
                out.append((a, b, c))
    return np.array(sorted(out), np.int64)


def nnls(matrix: np.ndarray, target: np.ndarray, limit: int = 2000) -> np.ndarray:
    """Active-set non-negative least squares: min |matrix x - target| with x >= 0."""
    m, n = matrix.shape
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).sum()))
    for _ in range(limit):
        gradient = matrix.T @ (target - matrix @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance or active.sum() >= m:
            break
        active[best] = True
        while True:
            columns = np.flatnonzero(active)
            solved = np.linalg.lstsq(matrix[:, columns], target, rcond=None)[0]
            if solved.size == 0 or solved.min() > 0:
                x[:] = 0
                x[columns] = solved
                break
            low = solved <= 0
            here = x[columns]
            step = np.min(here[low] / np.maximum(here[low] - solved[low], 1e-300))
            x[columns] = here + step * (solved - here)
            active[columns[x[columns] <= tolerance * 1e-3]] = False
            x[~active] = 0
    return x


@dataclass
class Plan:
    """Where the tail of a length and a rank goes; built from the histogram alone."""

    window: int
    counts: np.ndarray  # tails by length, 0 to window - 1
    combos: np.ndarray  # rows of class numbers
    repeats: np.ndarray  # how often each is used
    unit: int = UNIT

    def __post_init__(self):
        classes = self.window // self.unit
        self.of_class = (np.arange(self.window) + self.unit - 1) // self.unit
        self.before = np.zeros(self.window, np.int64)  # tails of shorter lengths in the same class
        self.lengths: list[np.ndarray] = [np.flatnonzero(self.of_class == c) for c in range(classes + 1)]
        for group in self.lengths:
            self.before[group] = np.concatenate([[0], np.cumsum(self.counts[group])[:-1]]) if len(group) else 0
        self.first = np.concatenate([[0], np.cumsum(self.repeats)])
        self.matched = int(self.first[-1])
        taken = np.zeros(classes + 1, np.int64)
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(classes + 1)]  # (rank from, combination, place)
        self.run_of = np.zeros(self.combos.shape, np.int64)
        for i, combo in enumerate(self.combos):
            for place, c in enumerate(combo):
                if c:
                    self.runs[c].append((int(taken[c]), i, place))
                    self.run_of[i, place] = taken[c]
                    taken[c] += self.repeats[i]
        self.taken = taken
        self.run_starts = [np.array([r[0] for r in runs], np.int64) for runs in self.runs]
        #: residual tails stand by class, then rank; tokens before each class
        left = np.zeros(classes + 1, np.int64)
        for c, group in enumerate(self.lengths):
            left[c] = self._tokens(c, int(self.counts[group].sum())) - self._tokens(c, int(taken[c])) if c else 0
        self.left_before = np.concatenate([[0], np.cumsum(left)[:-1]])
        self.residual_windows = int(-(-left.sum() // self.window))
        self.sequences = self.matched + self.residual_windows

    def _tokens(self, c: int, rank: int) -> int:
        """Tokens of the first ``rank`` tails of a class."""
        group = self.lengths[c]
        inside = np.clip(rank - self.before[group], 0, self.counts[group])
        return int((inside * group).sum())

    def length_at(self, c: int, rank: int) -> int:
        group = self.lengths[c]
        ends = self.before[group] + self.counts[group]
        return int(group[np.searchsorted(ends, rank, side="right")])

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Pieces of a tail: (start in the tail, tokens, sequence, offset there)."""
        c = int(self.of_class[length])
        at = int(self.before[length]) + rank
        if at < self.taken[c]:
            k = int(np.searchsorted(self.run_starts[c], at, side="right")) - 1
            start, combo, place = self.runs[c][k]
            copy = at - start
            offset = sum(self.length_at(int(self.combos[combo, p]), int(self.run_of[combo, p]) + copy) for p in range(place))
            return [(0, length, int(self.first[combo]) + copy, offset)]
        position = int(self.left_before[c]) + self._tokens(c, at) - self._tokens(c, int(self.taken[c]))
        sequence, offset = self.matched + position // self.window, position % self.window
        room = self.window - offset
        if length <= room:
            return [(0, length, sequence, offset)]
        return [(0, room, sequence, offset), (room, length - room, sequence + 1, 0)]


def plan_tails(counts: np.ndarray, window: int = WINDOW, unit: int = UNIT) -> Plan:
    """Fit the combinations to the histogram of tail lengths and round down."""
    classes = window // unit
    of_class = (np.arange(window) + unit - 1) // unit
    histogram = np.bincount(of_class, counts, classes + 1).astype(np.int64)
    combos = combinations(classes)
    matrix = np.zeros((classes + 1, len(combos)))
    for place in range(DEPTH):
        np.add.at(matrix, (combos[:, place], np.arange(len(combos))), 1.0)
    total = float(histogram.sum()) or 1.0
    solved = nnls(matrix[1:], histogram[1:] / total) * total
    left, used = histogram.copy(), []
    for i in np.argsort(-solved, kind="stable"):
        need = np.bincount(combos[i][combos[i] > 0], minlength=classes + 1)
        n = min(int(solved[i] + 1e-6), int(np.min(left[need > 0] // need[need > 0])))
        if n <= 0:
            continue
        left -= n * need
        used.append((int(i), n))
    chosen = combos[[i for i, _ in used]] if used else np.zeros((0, DEPTH), np.int64)
    return Plan(window, counts.astype(np.int64), chosen, np.array([n for _, n in used], np.int64), unit)


def tokenised(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored table of ids per document with its tail length and its ranks inside the task that wrote it."""
    kind = dict(docs.dtypes)[key]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        seen, full = np.zeros(window, np.int64), 0
        for batch in batches:
            rows: dict[str, list] = {"ids": [], "n": [], "tail": [], "rank": [], "full": []}
            for ids in encode(batch.column("__text").to_pylist()):
                ids += end
                n = len(ids) // 4
                tail = n % window
                wide = np.frombuffer(ids, "<u4")
                rows["ids"].append(wide.astype("<u2").tobytes() if n and wide.max() < 1 << 16 else ids)
                rows["n"].append(n)
                rows["tail"].append(tail)
                rows["rank"].append(int(seen[tail]))
                rows["full"].append(full)
                seen[tail] += 1
                full += n // window
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([part] * batch.num_rows, pa.int32()), pa.array(rows["ids"], pa.binary()),
                 *(pa.array(rows[c], pa.int64()) for c in ("n", "tail", "rank", "full"))], [key, "part", "ids", "n", "tail", "rank", "full"])

    narrow = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("__text"))
    return stored(text_batches(narrow, run, f"`{key}` {kind}, part int, ids binary, n long, tail long, rank long, full long", keeps=True))


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids_crc32 and (``with_ids``) the ids.

    Every document ends with ``end_id``, so it has one piece at least; null texts are empty. Each id lies in exactly one
    piece, offsets in a sequence have no gaps, and only what a class rounds up and the last residual window are padding.
    Rows may repeat and keys may be null; each row is packed. An empty table gives no rows. A document of more than 2**31
    bytes of ids does not fit a row.
    """
    rows = tokenised(docs, path, end_id, window, key, text)
    kind = dict(docs.dtypes)[key]
    per_part = stored(rows.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("c"), F.sum(F.expr(f"n div {window}")).alias("windows")))
    counts = np.zeros(window, np.int64)
    for r in per_part.where("tail > 0").groupBy("tail").agg(F.sum("c").alias("c")).collect():  # one row per length
        counts[r["tail"]] = r["c"]
    plan = plan_tails(counts, window)
    earlier = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_part.select("part", "tail", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("rank_before"))
    parts = per_part.groupBy("part").agg(F.sum("windows").alias("w"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    windows = parts.select("part", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("full_before"))
    placed = rows.join(ranks.join(windows, "part"), ["part", "tail"])
    extra = ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("ids", "n", "tail", "rank", "rank_before", "full", "full_before")}
            source, out, held = [], {c: [] for c in ("start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32")}, []
            for i, (raw, n, tail, rank, rank_before, full, full_before) in enumerate(zip(*columns.values())):
                ids = np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * n else np.frombuffer(raw, "<u4")
                pieces = [(w * window, window, plan.sequences + full_before + full + w, 0) for w in range(n // window)]
                if tail:
                    pieces += [(n - tail + a, b, s, o) for a, b, s, o in plan.place(tail, rank + rank_before)]
                for start, length, sequence, offset in pieces:
                    piece = ids[start : start + length]
                    source.append(i)
                    for c, v in zip(out, (start, length, n, sequence, offset, zlib.crc32(piece.tobytes()))):
                        out[c].append(v)
                    if with_ids:
                        held.append(piece.astype("i4"))
            arrays = [batch.column(key).take(pa.array(source, pa.int64())), *(pa.array(v, pa.int64()) for v in out.values())]
            if with_ids:
                arrays.append(pa.array(held, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [key, *out, *(["ids"] if with_ids else [])])

    return text_batches(placed, run, f"`{key}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long{extra}")
