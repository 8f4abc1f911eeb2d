"""Hard negatives by rotated one-bit codes: popcount estimates with certain intervals, integer scores for what they leave.

A vector is rotated by a fixed random rotation and written as ``x = a1*s1 + a2*s2 + ... + r``: each code ``s`` holds the signs
of what is left so far, its stored coefficient ``a`` is the alignment of the two, ``r`` is the rest. The query is cut to bit
planes, so its products with the codes are popcounts. What they miss is at most ``|e|*|x - r|`` for the planes' rounding ``e``
and, by Cauchy-Schwarz, ``|r|`` times the part of the query across the last code. So every score lies in a known interval, and
only rows whose interval can reach the best ones are scored, in integers.

Rows are packed into chunks, anchors into blocks. Blocks meet chunks in an equi-join on a chunk group, pair by pair, so a
task holds one chunk and one block; each pair gives its best few rows and windows with a rank limit reduce them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import _importable, stored

CHUNK = 2048  # rows of a chunk
BLOCK = 256  # anchors of a block
PAIRS = 4  # pairs of chunk and block in an Arrow batch
CODES = 5  # one-bit codes of a row: of random rows, three filter little, five leave a third
PLANES = 7  # bit planes of a query
SLACK = 1e-9  # share of |query|*|row| that covers rounding of doubles
GATHER = 1 << 15  # pairs that are scored at once

PACKED = "dim int, part long, n int, uids binary, ids binary, known binary, labels binary, parts binary, codes binary, stats binary"


@functools.lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    if not dim:
        return np.zeros((0, 0))
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def words_of(bits: np.ndarray) -> np.ndarray:
    """Bits of each row as unsigned 64-bit words."""
    packed = np.packbits(bits, axis=1)
    wide = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def encode(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, code, word) and stats (row: coefficient of each code, size of the coded part, size of the rest) of integer vectors."""
    rest = parts.astype(np.float64) @ rotation(parts.shape[1]).T
    whole, dim = rest.copy(), max(1, parts.shape[1])
    codes, stats = [], []
    for _ in range(CODES):
        up = rest >= 0
        a = np.abs(rest).sum(1) / dim
        rest = rest - np.where(up, a[:, None], -a[:, None])
        codes.append(words_of(up))
        stats.append(a)
    stats += [np.linalg.norm(whole - rest, axis=1), np.linalg.norm(rest, axis=1)]
    return np.stack(codes, 1), np.stack(stats, 1)


def intervals(queries: np.ndarray, codes: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of all inner products of integer ``queries`` with the rows behind ``codes`` and ``stats``."""
    turned = queries.astype(np.float64) @ rotation(queries.shape[1]).T
    n, dim = turned.shape
    low = turned.min(1) if dim else np.zeros(n)
    step = ((turned.max(1) if dim else low) - low) / ((1 << PLANES) - 1)
    step[step == 0] = 1
    cut = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    near = low[:, None] + step[:, None] * cut
    planes = [words_of((cut >> b & 1).astype(bool)) for b in range(PLANES)]
    lost, size, total = np.linalg.norm(turned - near, axis=1), np.linalg.norm(turned, axis=1), near.sum(1)
    centre = np.zeros((n, len(codes)))
    for j in range(CODES):
        code = codes[:, j]
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        held = np.zeros((n, len(codes)), np.int64)
        for b, plane in enumerate(planes):
            for w in range(code.shape[1]):
                held += np.bitwise_count(plane[:, w, None] & code[None, :, w]).astype(np.int64) << b
        product = 2 * (low[:, None] * ones + step[:, None] * held) - total[:, None]
        centre += stats[:, j] * product
    along = np.maximum(np.abs(product) - np.sqrt(dim) * lost[:, None], 0) ** 2 / max(1, dim)
    across = np.sqrt(np.maximum(size[:, None] ** 2 - along, 0))
    reach = np.hypot(stats[:, CODES], stats[:, CODES + 1])
    error = lost[:, None] * stats[:, CODES] + across * stats[:, CODES + 1] + SLACK * (1 + size[:, None] * (1 + reach))
    ends = -float(1 << 63), float(1 << 63)  # scores are cut to 64 bits as well
    return np.clip(centre - error, *ends), np.clip(centre + error, *ends)


def products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows ``a[i]`` and ``b[j]``; a score beyond 64 bits becomes the last one that fits."""
    out = np.zeros(len(i), np.int64)
    largest = [int(np.abs(x.astype(np.float64)).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * max(1, a.shape[1]) < 1 << 62:
        for at in range(0, len(i), GATHER):
            s = slice(at, at + GATHER)
            out[s] = np.einsum("ij,ij->i", a[i[s]].astype(np.int64), b[j[s]].astype(np.int64))
        return out
    ends = (-(1 << 63), (1 << 63) - 1)
    for at, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        out[at] = min(max(sum(u * v for u, v in zip(a[x].tolist(), b[y].tolist())), ends[0]), ends[1])
    return out


class Packed:
    """The rows of a chunk or block."""

    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.uids, self.ids = np.frombuffer(row["uids"], "<i8"), np.frombuffer(row["ids"], "<i8")
        self.known, self.labels = np.frombuffer(row["known"], "?"), np.frombuffer(row["labels"], "<i8")
        width = len(row["parts"]) // max(1, n * dim)
        self.parts = np.frombuffer(row["parts"], "<i8" if width == 8 else "<i4").reshape(n, dim)
        if "codes" in row:  # a chunk's; blocks travel without
            self.codes = np.frombuffer(row["codes"], "<u8").reshape(n, CODES, -1)
            self.stats = np.frombuffer(row["stats"], "<f8").reshape(n, CODES + 2)
        self.row = row


def packed(part: int, uids, ids, known, labels, parts: np.ndarray) -> dict:
    codes, stats = encode(parts)
    narrow = not parts.size or np.abs(parts.astype(np.float64)).max() < 1 << 31
    return {"dim": parts.shape[1], "part": part, "n": len(uids), "uids": uids.tobytes(), "ids": ids.tobytes(), "known": known.tobytes(),
            "labels": labels.tobytes(), "parts": parts.astype("<i4" if narrow else "<i8").tobytes(), "codes": codes.tobytes(), "stats": stats.tobytes()}


def _batch(rows: list[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=like)


_PACKED = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("uids", "ids", "known", "labels", "parts", "codes", "stats"))])


def _pack_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (uid, id, label, parts) to packed rows of at most ``size`` of them and of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("parts")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat, offsets = vectors.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
            uids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("uid", "label"))
            known = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                parts = flat[(offsets[at][:, None] + np.arange(dim)).reshape(-1)].reshape(len(at), dim).astype(np.int64)
                for s in range(0, len(at), size):
                    here = at[s : s + size]
                    yield _batch([packed(int(uids[here[0]]), uids[here], ids[here], known[here], labels[here], parts[s : s + size])], _PACKED)

    return run


def best(group: np.ndarray, score: np.ndarray, rows: Packed, j: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` first of each group: higher scores, then smaller ids (unknown last), then uid."""
    order = np.lexsort((rows.uids[j], rows.ids[j], ~rows.known[j], -score.astype(np.float64) if score.dtype != np.int64 else ~score, group))
    g = group[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[rank < k]


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def positives_of(block: Packed, chunk: Packed, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the first ``k`` rows of the chunk with the anchor's label, the anchor itself left out."""
    low, high = intervals(block.parts, chunk.codes, chunk.stats)
    same = (block.labels[:, None] == chunk.labels) & (block.uids[:, None] != chunk.uids)
    floor = kth_largest(np.where(same, low, -np.inf), k)
    i, j = np.nonzero(same & (high >= floor[:, None]))
    score = products(block.parts, chunk.parts, i, j)
    keep = best(i, score, chunk, j, k)
    return i[keep], j[keep], score[keep]


def negatives_of(block: Packed, chunk: Packed, scores: np.ndarray, given: np.ndarray, k: int, share: tuple[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each column of positive ``scores`` (where ``given``): (column, anchor, row, score) of the first ``k`` rows of another
    label whose score is at least ``share`` of the positive's and not above it."""
    low, high = intervals(block.parts, chunk.codes, chunk.stats)
    other = block.labels[:, None] != chunk.labels
    wanted = np.zeros(other.shape, bool)
    floors = scores.astype(np.float64) * share[0] / share[1]
    room = np.abs(scores) * SLACK + 1e-6
    for c in range(scores.shape[1]):
        top, bottom = (scores[:, c] + room[:, c])[:, None], (floors[:, c] - room[:, c])[:, None]
        inside = other & (low >= (floors[:, c] + room[:, c])[:, None]) & (high <= (scores[:, c] - room[:, c])[:, None])
        floor = kth_largest(np.where(inside, low, -np.inf), k)
        wanted |= given[:, c, None] & other & (high >= np.maximum(bottom, floor[:, None])) & (low <= top)
    i, j = np.nonzero(wanted)
    score = products(block.parts, chunk.parts, i, j)
    for c in range(scores.shape[1]):
        p = scores[i, c]
        at = np.flatnonzero(given[i, c] & (score <= p) & _at_least(score, p, share))
        keep = at[best(i[at], score[at], chunk, j[at], k)]
        yield c, i[keep], j[keep], score[keep]


def _at_least(score: np.ndarray, positive: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """share[0] * positive <= share[1] * score, exactly."""
    if max(np.abs(score.astype(np.float64)).max(initial=0), np.abs(positive.astype(np.float64)).max(initial=0)) < 1 << 52:
        return share[0] * positive <= share[1] * score
    return np.array([share[0] * p <= share[1] * s for s, p in zip(score.tolist(), positive.tolist())], bool)


def _meet(chunks: DataFrame, blocks: DataFrame, groups: int, func, schema: str) -> DataFrame:
    """``func(block, chunk)`` on every pair of equal dimension; a block is sent once to every group of chunks.

    Both sides are shuffled: Spark takes the blocks for as small as their files and would collect all copies on the driver.
    """
    left = chunks.select(*[F.col(c).alias(f"c_{c}") for c in chunks.columns]).withColumn("g", F.pmod(F.xxhash64("c_part"), F.lit(groups)))
    right = blocks.drop("codes", "stats").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = left.hint("merge").join(right, (left.g == right.g) & (left.c_dim == right.dim)).drop("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield func(Packed(row), Packed({c.removeprefix("c_"): v for c, v in row.items() if c.startswith("c_")}))
        pa.default_memory_pool().release_unused()

    _importable(chunks.sparkSession)
    return pairs.mapInArrow(run, schema)


def _first(df: DataFrame, by: list[str], score: str, prefix: str, k: int) -> DataFrame:
    """The ``k`` first rows of each group; Spark applies the limit before the shuffle too."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.col(f"{prefix}_id").asc_nulls_last(), f"{prefix}_uid")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
                   scale: float = 256.0, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's first ``positives`` rows of
    its label and, for each, the first ``negatives`` rows of other labels with ``share`` of the positive's score at least.

    A component x counts as floor(scale * x); a score is an integer inner product, higher ones come first, then smaller keys.
    ``anchors``: which rows are anchors (all by default). Rows with a null label, a null vector or a null or non-finite component
    take no part. Vectors of different lengths don't meet. Every row counts for itself, also where it repeats a key or a whole
    row: an anchor leaves out only its own row. A null key comes last in ties. Other columns are ignored; an empty table gives
    no rows. Scores beyond 64 bits count as the last that fits.
    """
    spark = vectors.sparkSession
    whole = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), (label if isinstance(label, Column) else F.col(label)).cast("long").alias("label"),
        (F.lit(True) if anchors is None else F.coalesce(anchors, F.lit(False))).alias("anchor"), F.col(vector).alias("v"), whole.alias("whole"))
    rows = rows.where("label IS NOT NULL AND v IS NOT NULL AND whole").select(
        "id", "label", "anchor", F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("parts"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()))
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("anchor").cast("long")), F.lit(0)).alias("a")).first()
    n_chunks, n_blocks = max(1, -(-count["n"] // CHUNK)), max(1, -(-count["a"] // BLOCK))
    _importable(spark)
    narrow = ["uid", "id", "label", "parts"]
    chunks = stored(rows.select(*narrow).repartition(n_chunks).mapInArrow(_pack_rows(CHUNK), PACKED), batch_rows=2 * CHUNK)
    blocks = stored(rows.where("anchor").select(*narrow).repartition(n_blocks).mapInArrow(_pack_rows(BLOCK), PACKED), batch_rows=2 * BLOCK)
    groups = min(n_chunks, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    found = pa.schema([("part", pa.int64()), ("at", pa.int32()), ("a_uid", pa.int64()), ("a_id", pa.int64()), ("p_uid", pa.int64()), ("p_id", pa.int64()), ("p_score", pa.int64())])

    def meet_positives(block: Packed, chunk: Packed) -> pa.RecordBatch:
        i, j, score = positives_of(block, chunk, positives)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(i), block.row["part"], "i8")), pa.array(i.astype("i4")), pa.array(block.uids[i]), _ids(block, i),
            pa.array(chunk.uids[j]), _ids(chunk, j), pa.array(score)], schema=found)

    near = _meet(chunks, blocks, groups, meet_positives, "part long, at int, a_uid long, a_id long, p_uid long, p_id long, p_score long")
    near = stored(_first(near, ["a_uid"], "p_score", "p", positives), batch_rows=PAIRS)
    lists = near.groupBy("part").agg(F.collect_list(F.struct("at", "rank", "p_uid", "p_id", "p_score")).alias("near"))
    asked = blocks.join(lists, "part")

    hard = pa.schema([(c, pa.int64()) for c in ("a_uid", "a_id", "p_uid", "p_id", "p_score", "n_uid", "n_id", "n_score")])

    def meet_negatives(block: Packed, chunk: Packed) -> pa.RecordBatch:
        scores, given = np.zeros((len(block.uids), positives), np.int64), np.zeros((len(block.uids), positives), bool)
        uids, ids = np.zeros_like(scores), np.zeros(scores.shape, object)
        for x in block.row["near"]:
            at = x["at"], x["rank"] - 1
            scores[at], given[at], uids[at], ids[at] = x["p_score"], True, x["p_uid"], x["p_id"]
        out = []
        for c, i, j, score in negatives_of(block, chunk, scores, given, negatives, share):
            out.append(pa.RecordBatch.from_arrays([
                pa.array(block.uids[i]), _ids(block, i), pa.array(uids[i, c]), pa.array(ids[i, c].tolist(), pa.int64()),
                pa.array(scores[i, c]), pa.array(chunk.uids[j]), _ids(chunk, j), pa.array(score)], schema=hard))
        return pa.Table.from_batches(out, hard).combine_chunks().to_batches(max_chunksize=None)[0] if any(len(b) for b in out) else _batch([], hard)

    far = _meet(chunks, asked, groups, meet_negatives, ", ".join(f"{c} long" for c in hard.names))
    far = _first(stored(far, batch_rows=PAIRS), ["a_uid", "p_uid"], "n_score", "n", negatives)
    return far.select(F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", F.col("n_id").alias("negative_id"),
                      F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))


def _ids(rows: Packed, at: np.ndarray) -> pa.Array:
    return pa.array(rows.ids[at], mask=~rows.known[at])
