"""Near-duplicate vectors by sorted projection passes.

Equal directions are one representative. Representatives are centred on their mean, so that a direction they share does not
fill the hashes. A pass orders them lexicographically by concatenated random hashes (signs of projections), compares each
with its neighbours in a bounded window of that order, across the ends of tasks too, and hands on links that span what it
verified. The first passes are as many as the number of vectors asks for; more follow, at least as many again each time,
until they unite nothing new. Inside each component all pairs are then counted exactly, block against block, so links that
no window held are counted too. Pairs never become rows. Products are taken in single precision; those within its error of
the threshold are taken again in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import _importable, by_group, stored
from cutline.llm.components import components

WINDOW = 256  # neighbours before a vector that a pass compares it with, at least
SIGNS = 62  # hashes concatenated in a pass
MISSED = 0.001  # share of the links at the threshold that the first passes may miss
BLOCK = 4096  # vectors of a block when a component is compared
TILE = 512  # of which so many at once
BUCKET = 1024  # vectors of small components that one group holds, about
TASK_ROWS = 1 << 16  # rows of a pass in one task
AGAIN = 1 << 22  # components of vectors whose products are taken again at once
SEAM = "dim int, turn int, sorted long, uid long, vec binary"
LINKS = f"a long, b long, doubt boolean, seam int, head boolean, {SEAM}"


def _unit(raw: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _single(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1)


def _valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, vec) of each row: vectors that can be compared, as bytes of doubles scaled by their largest component; dim
    and vec are null for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, raws = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                a = None if not v or i is None or any(x is None for x in v) else np.array(v, np.float64)
                if a is not None and np.isfinite(a).all() and (top := np.abs(a).max()) > 0:
                    dims.append(len(a))
                    raws.append((a / top + 0.0).tobytes())
                else:
                    dims.append(None)
                    raws.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())], ["id", "dim", "vec"])

    _importable(df.sparkSession)
    return df.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(run, "id long, dim int, vec binary")


def _error(dim: int) -> float:
    """How far a product of unit vectors in single precision may be off."""
    return 1e-6 + 2e-7 * dim


def _near(u: np.ndarray, v: np.ndarray, similarity: float, single: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which pairs of unit vectors are near. single: the same vectors in single precision."""
    products = single[0] @ single[1].T
    error = _error(u.shape[1])
    near = products >= similarity + error
    i, j = np.nonzero((products >= similarity - error) & ~near)
    step = max(1, AGAIN // u.shape[1])
    for at in range(0, len(i), step):
        a, b = i[at : at + step], j[at : at + step]
        near[a, b] = np.einsum("ij,ij->i", u[a], v[b]) >= similarity
    return near


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same ids as the links a - b do: the smallest id of each local component, and its other ids."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[i], label[j])
        now = label.copy()
        np.minimum.at(now, label[i], low)
        np.minimum.at(now, label[j], low)
        now = now[now]
        if (now == label).all():
            break
        label = now
    rest = label != np.arange(len(ids))
    return ids[label[rest]], ids[rest]


def first_passes(rows: int, similarity: float) -> int:
    """Passes after which a link at the threshold was in a window but for ``MISSED``, if directions are spread evenly: a
    pass holds it if the signs that tell windows of so many rows apart all agree."""
    signs = max(0.0, math.log2(max(rows, 1) / WINDOW))
    held = (1 - math.acos(min(max(similarity, -1.0), 1.0)) / math.pi) ** signs
    return max(2, math.ceil(math.log(MISSED) / math.log(1 - held))) if held < 1 - MISSED else 2


def pass_keys(v: np.ndarray, turn: int, seed: int = 9) -> np.ndarray:
    """The concatenated signs of centred vectors in one pass, as numbers."""
    signs = v @ np.random.default_rng([seed, turn, v.shape[1]]).normal(size=(v.shape[1], SIGNS)) > 0
    return signs @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))


def _centres(reps: DataFrame) -> dict[int, np.ndarray]:
    """The mean unit vector of each length: one row per length and coordinate is collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                v = _unit(batch.filter(pa.array(dims == dim)).column("vec").to_pylist())
                total, n = sums.get(int(dim), (0.0, 0))
                sums[int(dim)] = total + v.sum(axis=0), n + len(v)
        for dim, (total, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total), pa.array(np.full(dim, n))],
                ["dim", "at", "total", "n"])

    sums = reps.select("dim", "vec").mapInArrow(run, "dim int, at int, total double, n long").groupBy("dim", "at")
    out: dict = {}
    for r in sums.agg((F.sum("total") / F.sum("n")).alias("mean")).collect():
        out.setdefault(r["dim"], np.zeros(r["dim"]))[r["at"]] = r["mean"]
    return out


def _links(a: np.ndarray, b: np.ndarray, products: np.ndarray, similarity: float, dim: int) -> Iterator[pa.RecordBatch]:
    """Links that span the certain ones among vectors a and b, and the pairs that only double precision can tell."""
    error = _error(dim)
    for doubt, (i, j) in ((False, np.nonzero(products >= similarity + error)), (True, np.nonzero(np.abs(products - similarity) < error))):
        x, y = a[i], b[j]
        x, y = x[x != y], y[x != y]
        if len(x):
            x, y = (np.minimum(x, y), np.maximum(x, y)) if doubt else _spanning(x, y)
            yield _record(len(x), a=x, b=y, doubt=np.full(len(x), doubt))


def _record(rows: int, **columns) -> pa.RecordBatch:
    kinds = {"a": pa.int64(), "b": pa.int64(), "doubt": pa.bool_(), "seam": pa.int32(), "head": pa.bool_(), "dim": pa.int32(),
             "turn": pa.int32(), "sorted": pa.int64(), "uid": pa.int64(), "vec": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in kinds.items()], list(kinds))


def _seam(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between the last rows of a task and the first ones of the next."""
    out = []
    for (_, dim, _), part in frame.groupby(["seam", "dim", "turn"]):
        head = part["head"].to_numpy(bool)
        if head.all() or not head.any():
            continue
        v, uid = _single(list(part["vec"])), part["uid"].to_numpy()
        out += [r.to_pandas() for r in _links(uid[head], uid[~head], v[head] @ v[~head].T, similarity, int(dim))]
    return pd.concat(out)[["a", "b", "doubt"]].astype({"doubt": bool}) if out else pd.DataFrame({"a": [], "b": [], "doubt": []})


def _passes(reps: DataFrame, centres: dict[int, np.ndarray], rows: int, similarity: float, first: int, last: int) -> DataFrame:
    """(a, b): verified links that span what the windows of the passes first to last - 1 hold."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                v = _unit(part.column("vec").to_pylist())
                raw = pa.array([x.tobytes() for x in v.astype(np.float32)], pa.binary())
                v -= centres[int(dim)]
                for turn in range(first, last):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("dim"), pa.array(np.full(len(v), turn, np.int32)), pa.array(pass_keys(v, turn)), part.column("uid"), raw],
                        ["dim", "turn", "sorted", "uid", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, names = TaskContext.get().partitionId(), ["dim", "turn", "sorted", "uid", "vec"]
        at, held, heads, opening = None, None, 0, None  # this pass, its last rows, rows already handed to the task before
        for batch in batches:
            dims, turns = batch.column("dim").to_numpy(), batch.column("turn").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (turns[1:] != turns[:-1]) | (dims[1:] != dims[:-1]), True])
            for a, z in zip(cuts[:-1], cuts[1:]):
                if at != (dims[a], turns[a]):
                    at, held = (dims[a], turns[a]), None
                    opening = opening or at
                for low in range(a, z, WINDOW):
                    part = batch.slice(low, min(z, low + WINDOW) - low)
                    if at == opening and heads < WINDOW and task:
                        front = part.slice(0, WINDOW - heads)
                        heads += front.num_rows
                        yield _record(front.num_rows, seam=np.full(front.num_rows, task - 1), head=np.ones(front.num_rows, bool), **{n: front.column(n) for n in names})
                    both = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                    v, uid = _single(both.column("vec").to_pylist()), both.column("uid").to_numpy()
                    own = len(uid) - part.num_rows
                    yield from _links(uid[own:], uid, v[own:] @ v.T, similarity, int(at[0]))
                    held = both.slice(max(0, both.num_rows - WINDOW))
        if held is not None:
            n = held.num_rows
            yield _record(n, seam=np.full(n, task), head=np.zeros(n, bool), **{c: held.column(c) for c in names})

    spark, total, order = reps.sparkSession, rows * (last - first), ["dim", "turn", "sorted", "uid"]
    tasks = max(1, min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_ROWS), total // (4 * WINDOW)))
    ordered = reps.select("dim", "uid", "vec").mapInArrow(keyed, SEAM).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    found = stored(ordered.mapInArrow(compare, LINKS), batch_rows=4096)
    seams = by_group(found.where("seam is not null").select("seam", "head", "dim", "turn", "uid", "vec"), "seam", lambda f: _seam(f, similarity), "a long, b long, doubt boolean")
    links = stored(found.where("seam is null").select("a", "b", "doubt").unionByName(seams).distinct(), batch_rows=4096)
    return links.where("not doubt").select("a", "b").unionByName(_told(links.where("doubt").select("a", "b"), reps, similarity))


def _told(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                near = np.einsum("ij,ij->i", _unit(part.column("u").to_pylist()), _unit(part.column("v").to_pylist())) >= similarity
                yield part.filter(pa.array(near)).select(["a", "b"])

    first, other = reps.select(F.col("uid").alias("a"), "dim", F.col("vec").alias("u")), reps.select(F.col("uid").alias("b"), F.col("vec").alias("v"))
    return pairs.join(first, "a").join(other, "b").select("dim", "a", "b", "u", "v").mapInArrow(run, "a long, b long")


def _united(reps: DataFrame, similarity: float) -> DataFrame:
    """(uid, component) of all representatives: passes until they unite nothing new."""
    rows = reps.count()
    parts = reps.select("uid", F.col("uid").alias("component"))
    if not rows:
        return parts
    centres, done, more = _centres(reps), 0, first_passes(rows, similarity)
    while True:
        found = _passes(reps, centres, rows, similarity, done, done + more)
        done, more = done + more, max(more, done)
        a, b = (parts.select(F.col("uid").alias(x), F.col("component").alias(f"__{x}")) for x in "ab")
        fresh = stored(found.join(a, "a").join(b, "b").where("__a <> __b").select(F.col("__a").alias("a"), F.col("__b").alias("b")).distinct())
        if fresh.isEmpty():
            return parts
        now = stored(components(fresh)).select(F.col("id").alias("component"), F.col("component").alias("__now"))
        parts = stored(parts.join(now, "component", "left").select("uid", F.coalesce("__now", "component").alias("component")))


def _count(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links of each vector to those of its component in its group; of two blocks, to those of the other one."""
    out = []
    frame = frame.sort_values(["group", "component"], kind="stable", ignore_index=True)
    group, part = frame["group"].to_numpy(), frame["component"].to_numpy()
    cuts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (part[1:] != part[:-1]), True])
    uid, side, cross, weight, vec = (frame[c].to_numpy() for c in ("uid", "side", "cross", "weight", "vec"))
    for a, z in zip(cuts[:-1], cuts[1:]):
        v, links = _unit(list(vec[a:z])), np.zeros(z - a)
        v4, sides = v.astype(np.float32), side[a:z]
        for at in range(0, z - a, TILE):
            own = slice(at, at + TILE)
            near = _near(v[own], v, similarity, (v4[own], v4))
            near &= (sides[own, None] != sides[None, :]) if cross[a] else uid[a:z][own, None] != uid[None, a:z]
            links[own] = near @ weight[a:z]
        out.append(pd.DataFrame({"uid": uid[a:z], "links": links}))
    return pd.concat(out, ignore_index=True).astype("int64") if out else pd.DataFrame({"uid": [], "links": []}, dtype="int64")


def _counts(reps: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """(uid, links): vectors linked to each representative, exactly, among those of its component.

    Small components share groups; of a large one each pair of blocks is a group, so no group outgrows two blocks.
    """
    sizes = stored(parts.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    buckets = max(1, (sizes.agg(F.sum("size")).first()[0] or 0) // BUCKET)
    member = reps.join(parts.join(sizes, "component"), "uid").withColumn("__n", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
    small = member.where("__n = 1").withColumns({"group": F.pmod(F.xxhash64("component"), F.lit(buckets)).cast("long"), "side": F.lit(0), "cross": F.lit(False)})
    large = member.where("__n > 1").withColumn("__own", F.pmod(F.xxhash64("uid"), F.col("__n")).cast("int"))
    large = large.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - F.lit(1)))).withColumns({
        "group": F.xxhash64("component", F.least("__own", "__other"), F.greatest("__own", "__other")),
        "side": (F.col("__own") > F.col("__other")).cast("int"), "cross": F.col("__own") != F.col("__other")})
    columns = ["group", "component", "side", "cross", "uid", "weight", "vec"]
    counts = by_group(small.select(*columns).unionByName(large.select(*columns)), "group", lambda f: _count(f, similarity), "uid long, links long")
    return stored(counts.groupBy("uid").agg(F.sum("links").alias("links")), batch_rows=4096)


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", similarity: float = 0.95) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    n_links: other vectors linked directly; component_id: smallest key that links reach; kept: the vector with that key.
    Vectors that are null, empty, zero, or hold null or non-finite components, or whose key is null, link with nothing and
    are their own component. Vectors of different lengths never link. A repeated key is one vector more each time it occurs.
    A key that is no number is an error. Other columns are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = stored(_valid(df, key, vector), batch_rows=4096)
    vectors = rows.where("vec is not null")
    classes = vectors.groupBy("dim", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    reps = stored(classes.repartition(tasks).withColumn("uid", F.monotonically_increasing_id()))
    parts = _united(reps, similarity)
    total = _counts(reps, parts, similarity)
    slim = stored(reps.select("uid", "id", "weight").join(parts, "uid").join(total, "uid", "left"))
    first = slim.groupBy("component").agg(F.min("id").alias("component_id"))
    counts = stored(slim.join(first, "component").select("uid", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - F.lit(1)).alias("n_links")))
    per_rep = reps.select("dim", "vec", "uid").join(counts, "uid").drop("uid")
    of_vector = vectors.join(stored(per_rep), ["dim", "vec"]).select(F.col("id").alias("__id"), "n_links", "component_id")
    alone = rows.where("vec is null").select(F.col("id").alias("__id"))
    out = of_vector.unionByName(alone.select("__id", F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id")))
    return out.select(F.col("__id").alias(key), "n_links", "component_id", F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))
