"""Jaccard self-join of word n-grams by chosen paths.

Documents with equal shingle sets form one class. A class representative is embedded as 128 min-hash tokens. A run starts
with all representatives in one bucket and splits buckets: a token that is shared inside a bucket is chosen by a hash of
the path so far with probability 1 / (similarity * tokens), and each chosen token makes a bucket of the sets that hold it.
So a pair at the threshold follows one common path on average, and unrelated sets part. Small buckets are compared by brute
force. In a larger one every set estimates its mean similarity to the bucket; a set near the threshold on average would stay
together with the others for many levels, so it asks: it is compared with the whole bucket and leaves it, and the others go on.
A set that asked in so many buckets that a link of it is in one of them with the target probability asks no more. Runs repeat
until a pair at the threshold is met with that probability: some runs of all sets do for pairs whose buckets end after
``SHALLOW`` levels, and sets whose buckets went deeper make the runs more that ``DEPTH`` levels take. Every pair is checked on
the whole shingle sets, in one bucket only: the smallest that both are in and one of them asks in. Large buckets are compared
block against block; pairs are counted in the blocks and never become rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import by_group, by_keys, stored, text_batches
from cutline.llm.components import components
from cutline.llm.shingles import min_hashes, mix, shingle_set

TOKENS = 128
SMALL = 1024  # buckets of so many sets are compared
STEP = 64  # groups of so many sets are compared many at a time
NEAR = 0.9  # share of the threshold from which a set's mean similarity to its bucket makes it ask
SAMPLE = 32  # sets of a bucket that the mean is estimated from
DEPTH = 10  # levels after which a bucket is compared whatever its size
SHALLOW = 2  # levels that the runs of all sets are counted for
DEEP_SHARE = 0.45  # part of the probability of a miss that is left to pairs whose buckets go deeper
MARGIN = 1.25  # a set asks in so many times the buckets that the recall takes, since two runs may choose the same token
BLOCK = 1024  # sets of a block
SLACK = 0.2  # min-hash estimates so far below the threshold end a pair (over five standard deviations)
BIT_SLACK = 0.27  # the same for estimates from one bit of each token
BATCH = 20_000


def runs_for(recall: float, depth: int = 2) -> int:
    """Runs until a pair at the threshold, with one common path on average, has met with probability ``recall``."""
    survive = 1.0
    for _ in range(depth):
        survive = 1 - math.exp(-survive)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survive)))


def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sets, tokens, bits = [], [], [], []
            for t in batch.column("__text").to_pylist():
                s = shingle_set(t) if t else ()
                n.append(len(s))
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                held = min_hashes(s, TOKENS) if len(s) else None
                tokens.append(held.tobytes() if len(s) else None)
                bits.append(np.packbits(held & 1).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("mark"), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in (sets, tokens, bits))],
                [key, "mark", "n", "set_hash", "tokens", "bits"])

    narrow = docs.select(F.col(key), F.xxhash64(text).alias("mark"), F.col(text).alias("__text"))
    schema = f"`{key}` {kind}, mark long, n long, set_hash binary, tokens binary, bits binary"
    return stored(text_batches(narrow, run, schema).withColumn("uid", F.monotonically_increasing_id()))


def _children(paths: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and path hashes of the chosen children. paths: one per row; tokens: rows x TOKENS."""
    cells = mix(tokens.astype(np.uint64) | (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)))
    child = mix(cells ^ mix(paths.astype(np.uint64))[:, None])
    rows, columns = np.nonzero((child >> np.uint64(11)).astype(np.float64) * 2.0**-53 < 1 / (similarity * TOKENS))
    return rows, mix(child[rows, columns] + np.uint64(1)).view(np.int64)


def _first_split(reps: DataFrame, similarity: float, runs: range) -> DataFrame:
    """Children (path, uid) of the root in each of ``runs``, or in those of them below a set's own ``until``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
            uid = batch.column("uid").to_numpy()
            until = batch.column("until").to_numpy() if "until" in batch.schema.names else np.full(len(uid), runs.stop)
            for r in runs:
                here = np.flatnonzero(until > r)
                picked, child = _children(np.full(len(here), r + 1, np.uint64), tokens[here], similarity)
                yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(uid[here][picked])], ["path", "uid"])

    return reps.mapInArrow(run, "path long, uid long")


def mean_similarity(own: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Estimated mean similarity of sets (one bit of each token: sets x TOKENS / 8) to those of a sample (sets x sample x TOKENS / 8)."""
    apart = np.bitwise_count(own[:, None] ^ sample).sum(axis=(1, 2), dtype=np.int64)
    return 1 - 2 * apart / (TOKENS * sample.shape[1])  # different sets agree in half of their bits


def _split(rows: DataFrame, similarity: float) -> DataFrame:
    """Sets that ask in a bucket (its path, asks) and the children of the others. rows: (path, uid, tokens, bits, sample)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
            path, uid = batch.column("path").to_numpy(), batch.column("uid").to_numpy()
            own = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(len(uid), -1)
            samples = batch.column("sample").to_pylist()
            sizes = np.array([len(x) for x in samples])
            asks = np.zeros(len(uid), bool)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                other = np.frombuffer(b"".join(samples[i] for i in at.tolist()), np.uint8).reshape(len(at), -1, TOKENS // 8)
                asks[at] = mean_similarity(own[at], other) >= NEAR * similarity
            stay = np.flatnonzero(~asks)
            picked, child = _children(path[stay].view(np.uint64), tokens[stay], similarity)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([path[asks], child])), pa.array(np.concatenate([uid[asks], uid[stay][picked]])),
                pa.array(np.repeat([True, False], [int(asks.sum()), len(child)]))], ["path", "uid", "asks"])

    return rows.mapInArrow(run, "path long, uid long, asks boolean")


def _samples(wide: DataFrame, reps: DataFrame) -> DataFrame:
    """(path, sample): the bits of up to ``SAMPLE`` sets of each bucket; the limit holds before the shuffle too."""
    order = Window.partitionBy("path").orderBy(F.xxhash64("uid", "path"), "uid")
    some = wide.select("path", "uid").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE)
    bits = some.join(reps.select("uid", "bits"), "uid").groupBy("path").agg(F.collect_list("bits").alias("all"))
    return bits.select("path", F.reduce("all", F.lit(b""), lambda a, b: F.concat(a, b)).alias("sample"))


def _asking(path: str, asks) -> Column:
    """The path with its lowest bit telling whether the set asks there."""
    return F.shiftleft(path, 1).bitwiseOR(asks.cast("long"))


def _descend(rows: DataFrame, reps: DataFrame, similarity: float, recall: float) -> tuple[DataFrame, DataFrame | None]:
    """Stored (path, uid, size): the buckets that first children end in or ask in, paths as of ``_asking``; and (uid, level): the
    sets in buckets that went deeper than ``SHALLOW`` levels and did not ask often enough, if there are any, with the level
    that the deepest ended at."""
    out, deep, asked, wides, depth = None, None, None, [], 1
    while True:
        sizes = stored(rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
        sized = stored(rows.join(sizes, "path"))
        done = F.lit(True) if depth >= DEPTH else F.col("size") <= SMALL
        found = sized.where(done).select(_asking("path", F.lit(True)).alias("path"), "uid", "size")
        out = found if out is None else out.unionByName(found)
        wide = sized.where(~done)
        if depth >= DEPTH or wide.isEmpty():
            break
        split = wide.select("path", "uid").join(reps.select("uid", "tokens", "bits"), "uid").join(stored(_samples(wide, reps)), "path")
        split = stored(_split(split, similarity), batch_rows=2048)
        asks = split.where("asks").select("path", "uid", F.lit(depth).alias("depth"))
        if depth >= SHALLOW:
            stay = wide.join(asks, ["path", "uid"], "left_anti").select("uid", F.lit(depth + 1).alias("level")).distinct()
            deep = stay if deep is None else deep.unionByName(stay)
        asked = asks if asked is None else asked.unionByName(asks)
        wides.append(wide)
        rows = split.where("not asks").select("path", "uid")
        depth += 1
    if asked is None:
        return out, None
    earlier = Window.partitionBy("uid").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    sure = -F.log(F.lit(1.0) - F.pow(F.lit(similarity), F.col("depth")))
    need = MARGIN * -math.log(1 - recall)
    held = stored(asked.withColumn("gain", sure).withColumn("before", F.coalesce(F.sum("gain").over(earlier), F.lit(0.0))).where(F.col("before") < need))
    paths = stored(held.select("path").distinct())
    for wide in wides:
        members = by_keys(wide, paths, ["path"], "left_semi").join(held.select("path", "uid", F.lit(True).alias("asks")), ["path", "uid"], "left")
        out = out.unionByName(members.select(_asking("path", F.coalesce("asks", F.lit(False))).alias("path"), "uid", "size"))
    if deep is not None:
        sure_sets = held.where(F.col("before") + F.col("gain") >= need).select("uid")
        deep = stored(deep.groupBy("uid").agg(F.max("level").alias("level")).join(sure_sets, "uid", "left_anti"))
    return stored(out), None if deep is None or deep.isEmpty() else deep


def leaves(reps: DataFrame, similarity: float, recall: float) -> DataFrame:
    """Stored (path, uid, size): the buckets to compare, paths as of ``_asking``. reps: stored (uid, tokens, bits).

    A pair at the threshold is missed if no run of all sets takes it to the end of ``SHALLOW`` levels, or if it is taken
    deeper, so that both sets make the further runs that the level takes which their buckets reached, and none of all these
    runs takes it to that level's end. The second has ``DEEP_SHARE`` of the probability that ``recall`` leaves.
    """
    first = runs_for(1 - (1 - recall) * (1 - DEEP_SHARE), SHALLOW)
    out, deep = _descend(stored(_first_split(reps, similarity, range(first)), batch_rows=2048), reps, similarity, recall)
    if deep is None:
        return out
    until = [max(first + 1, runs_for(1 - (1 - recall) * DEEP_SHARE, d)) for d in range(1, DEPTH + 1)]
    some = stored(reps.join(deep, "uid").withColumn("until", F.element_at(F.array(*map(F.lit, until)), F.col("level"))).drop("level"))
    more, _ = _descend(stored(_first_split(some, similarity, range(first, until[-1])), batch_rows=2048), some, similarity, recall)
    return out.unionByName(more)


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest common bucket that one of both asks in, for two tables of paths with ascending rows; filled places never meet."""
    hit = ((a[:, :, None] >> 1 == b[:, None, :] >> 1) & ((a[:, :, None] | b[:, None, :]) & 1 == 1)).any(axis=2)
    first = hit.argmax(axis=1)
    return np.where(hit.any(axis=1), a[np.arange(len(a)), first] >> 1, np.iinfo(np.int64).max)


def _met_before(order: np.ndarray, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit sets (sets x words) of the smaller buckets that two or more of the sets share, and of those each set asks in."""
    rows, columns = np.nonzero(order >> 1 < bucket)
    held = order[rows, columns]
    _, at, counts = np.unique(held >> 1, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    shared = counts[at] > 1
    rows, bit, asks = rows[shared], number[at[shared]], (held[shared] & 1).astype(bool)
    member = np.zeros((len(order), int((counts > 1).sum()) + 63 >> 6), np.uint64)
    asking = member.copy()
    mark = np.uint64(1) << (bit & 63).astype(np.uint64)
    np.bitwise_or.at(member, (rows, bit >> 6), mark)
    np.bitwise_or.at(asking, (rows[asks], bit[asks] >> 6), mark[asks])
    return member, asking


def _pairs(frame: pd.DataFrame, similarity: float, sketch: bool, need: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of each bucket that are to be checked here: sizes fit, sketches agree, no smaller common bucket.

    A frame holds whole groups, sorted by group; a group is a bucket, or two blocks of one (then only pairs between its
    blocks count). Pairs of two rows of ``need``, which the caller may fill meanwhile, are left out.
    """
    group, side, cross, n, path = (frame[c].to_numpy() for c in ("group", "side", "cross", "n", "path"))
    lists = frame["paths"].tolist()
    order = np.full((len(frame), max(map(len, lists))), np.iinfo(np.int64).max)
    for i, own in enumerate(lists):
        order[i, : len(own)] = own
    filled = order == np.iinfo(np.int64).max
    right = np.where(filled, np.iinfo(np.int64).max - 2, order)
    bucket = path >> 1
    marks = np.frombuffer(b"".join(frame["marks"]), np.uint8).reshape(-1, TOKENS) if sketch else None

    def check(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
        keep &= ((path[i] | path[j]) & 1).astype(bool)
        if need is not None:
            keep &= ~(need[i] & need[j])
        same = (order[i, 0] >> 1 == order[j, 0] >> 1) & ((order[i, 0] | order[j, 0]) & 1 == 1)
        keep &= ~same | (order[i, 0] >> 1 == bucket[i])
        i, j, same = i[keep], j[keep], same[keep]
        if sketch and len(i):
            agree = (marks[i] == marks[j]).mean(axis=1)
            keep = agree >= similarity - SLACK
            i, j, same = i[keep], j[keep], same[keep]
        if not same.all():
            ok = same.copy()
            rest = np.flatnonzero(~same)
            for at in range(0, len(rest), 2048):
                some = rest[at : at + 2048]
                ok[some] = _first_common(order[i[some]], right[j[some]]) == bucket[i[some]]
            i, j = i[ok], j[ok]
        return i, j

    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], len(group)]
    lengths = ends - starts
    small = np.repeat(lengths <= STEP, lengths)
    for d in range(1, int(min(STEP, lengths.max()))):
        i = np.flatnonzero(small[:-d] & (group[d:] == group[:-d]))
        if not len(i):
            break
        i = i[(cross[i] == 0) | (side[i] != side[i + d])]
        i, j = check(i, i + d)
        if len(i):
            yield i, j
    bits = np.frombuffer(b"".join(frame["bits"]), np.uint64).reshape(len(frame), -1) if (lengths > STEP).any() else None
    apart = int((1 - similarity + BIT_SLACK) / 2 * TOKENS)
    asks = (path & 1).astype(bool)
    for a, z in zip(starts[lengths > STEP], ends[lengths > STEP]):
        rows = np.arange(a, z)
        ones, twos = (rows[side[a:z] == 0], rows[side[a:z] == 1]) if cross[a] else (rows, rows)
        member, asking = _met_before(order[a:z], int(bucket[a]))
        for at in range(0, len(ones), 64):
            own = ones[at : at + 64]
            ok = np.bitwise_count(bits[own][:, None] ^ bits[twos]).sum(axis=2, dtype=np.int16) <= apart
            ok &= asks[own][:, None] | asks[twos]
            low, high = np.minimum(n[own][:, None], n[twos]), np.maximum(n[own][:, None], n[twos])
            ok &= low >= similarity * high
            if twos is rows:
                ok &= own[:, None] < twos
            if need is not None:
                ok &= ~(need[own][:, None] & need[twos])
            i, j = np.nonzero(ok)
            i, j = own[i], twos[j]
            for w in range(member.shape[1]):
                if not len(i):
                    break
                x, y = i - a, j - a
                new = member[x, w] & member[y, w] & (asking[x, w] | asking[y, w]) == 0
                i, j = i[new], j[new]
            if sketch and len(i):
                keep = (marks[i] == marks[j]).mean(axis=1) >= similarity - SLACK
                i, j = i[keep], j[keep]
            if len(i):
                yield i, j


def _blocks(rows: DataFrame) -> DataFrame:
    """Add group, side, cross: a bucket is a group; of one with more than ``BLOCK`` sets each pair of blocks is one (cross: two blocks)."""
    bucket = F.shiftright("path", 1)
    cut = rows.withColumn("__n", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")).withColumn("__own", F.pmod(F.xxhash64("uid"), F.col("__n")).cast("int"))
    small = cut.where("__n = 1").withColumn("group", F.xxhash64(bucket, F.lit(0), F.lit(0))).withColumn("side", F.lit(0)).withColumn("cross", F.lit(0))
    large = cut.where("__n > 1").withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - F.lit(1))))
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    large = large.withColumn("group", F.xxhash64(bucket, low, high)).withColumn("side", (F.col("__own") > F.col("__other")).cast("int")).withColumn("cross", (F.col("__own") != F.col("__other")).cast("int"))
    return small.unionByName(large.drop("__other")).drop("__n", "__own")


def _needed(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    need = np.zeros(len(frame), bool)
    for i, j in _pairs(frame, similarity, True, need):
        need[i] = need[j] = True
    return frame.loc[need, ["group", "side", "cross", "path", "uid", "n", "paths", "bits"]]


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    used = np.unique(np.concatenate([i, j]))
    if len(i) <= 2 * len(used) or len(used) <= 16:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    flat = np.concatenate([sets[k] for k in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    _, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[at] > 1
    column = (np.cumsum(counts > 1) - 1)[at[shared]]
    owner = owner[shared]
    place = np.searchsorted(used, i), np.searchsorted(used, j)
    rows, others = np.unique(place[0]), np.unique(place[1])
    total = np.zeros((len(rows), len(others)), np.float64)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, z = np.searchsorted(column, [at, at + 4096])
        dense = np.zeros((len(used), 4096), np.float32)
        dense[owner[a:z], column[a:z] - at] = 1
        total += dense[rows] @ dense[others].T
    return total[np.searchsorted(rows, place[0]), np.searchsorted(others, place[1])].astype(np.int64)


def _verified(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Per set and group: the documents it links to (by weight) and the smallest set its links reach here."""
    frame = frame.drop_duplicates(["group", "side", "uid"], ignore_index=True)  # a repeated row brings its text twice
    sets = [shingle_set(t) for t in frame["text"]]
    n, weight, uid, group = (frame[c].to_numpy() for c in ("n", "weight", "uid", "group"))
    links, root = np.zeros(len(frame), np.int64), np.arange(len(frame))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    held_i, held_j = [], []
    for i, j in _pairs(frame, similarity, False):
        held_i.append(i)
        held_j.append(j)
    if held_i:
        i, j = np.concatenate(held_i), np.concatenate(held_j)
        order = np.argsort(group[i], kind="stable")
        i, j = i[order], j[order]
        cuts = np.flatnonzero(np.r_[True, group[i][1:] != group[i][:-1], True])
        common = np.concatenate([_overlaps(sets, i[a:z], j[a:z]) for a, z in zip(cuts[:-1], cuts[1:])])
        hit = common >= similarity * (n[i] + n[j] - common) - 1e-9
        i, j = i[hit], j[hit]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        for a, b in zip(i.tolist(), j.tolist()):
            x, y = top(a), top(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    seen = np.flatnonzero(links)
    return pd.DataFrame({"uid": uid[seen], "links": links[seen], "root": [int(uid[top(k)]) for k in seen]}, columns=["uid", "links", "root"]).astype("int64")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row per document: key, class_id, n_links, n_copies, kept.

    Links join documents whose sets of five-word shingles have a Jaccard similarity of ``similarity`` or more (fewer than five
    words: one shingle of all words). n_links: other documents linked directly; n_copies: documents with the same set;
    class_id: the smallest key that links reach; kept: one row of each class, the first with that key. Documents without
    words (null, empty, white space) link with nothing. Repeated rows are copies of each other. Other columns are not read.
    ``recall``: probability that a pair at the threshold is met; above the threshold it is higher. An empty table gives no rows.
    """
    return _judged(docs, key, text, similarity, recall).drop("mark")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their columns: one document of each class.

    A row is told by its key and a hash of its text, so documents that share a key, or have none, are judged one by one; rows
    that repeat key and text are one document and stay or go together.
    """
    seen = _judged(docs, key, text, similarity, recall).groupBy(key, "mark").agg(F.max("kept").alias("kept"))
    gone = stored(seen.where("not kept").select(F.col(key).alias("__gone"), F.col("mark").alias("__of")))
    same = F.col(key).eqNullSafe(F.col("__gone")) & (F.col("__mark") == F.col("__of"))
    return by_keys(docs.withColumn("__mark", F.xxhash64(text)), gone, same, "left_anti").drop("__mark")


def _judged(docs: DataFrame, key: str, text: str, similarity: float, recall: float) -> DataFrame:
    """``near_duplicates`` with mark, a hash of the text."""
    sketches = _sketches(docs, key, text)
    worded = sketches.where("set_hash is not null")
    classes = stored(worded.groupBy("set_hash").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("weight")))
    several = stored(classes.where("weight > 1"))
    copies = stored(worded.select("uid", "set_hash").join(several, "set_hash").where("uid <> rep").select("uid"))
    weights = stored(several.select(F.col("rep").alias("uid"), "weight"))
    alone = by_keys(worded, copies, "uid", "left_anti")
    reps = stored(by_keys(alone, weights, "uid", "left").withColumn("weight", F.coalesce("weight", F.lit(1))))
    found = leaves(reps.select("uid", "tokens", "bits"), similarity, recall)
    own = stored(found.groupBy("uid").agg(F.sort_array(F.collect_list("path")).alias("paths")))
    member = stored(_marked(own.join(reps.select("uid", "n", "tokens", "bits"), "uid")))
    group_rows = _blocks(found.join(member, "uid"))
    schema = "group long, side int, cross int, path long, uid long, n long, paths array<long>, bits binary"
    needed = stored(by_group(group_rows, "group", lambda f: _needed(f, similarity), schema), batch_rows=BATCH)
    wanted = needed.join(reps.select("uid", key, "weight", "set_hash"), "uid")
    keys = stored(wanted.select(F.col(key).alias("__wanted")).distinct())
    texts = by_keys(docs.select(F.col(key), F.col(text).alias("text")), keys, F.col(key).eqNullSafe(F.col("__wanted")), "left_semi")
    checked = _texts(wanted, texts, key)
    links = stored(by_group(checked, "group", lambda f: _verified(f, similarity), "uid long, links long, root long"), batch_rows=2048)
    counts = stored(links.groupBy("uid").agg(F.sum("links").alias("links")))
    parts = stored(components(links.select(F.col("root").alias("a"), F.col("uid").alias("b"))))
    return _result(sketches, classes, counts, parts, key)


def _marked(member: DataFrame) -> DataFrame:
    """Replace the tokens by one byte of each, enough to tell sets far below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("tokens").to_pylist())
            low = np.frombuffer(raw, np.uint32).astype(np.uint8).tobytes()
            marks = [low[k : k + TOKENS] for k in range(0, len(low), TOKENS)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "paths", "n", "bits")), pa.array(marks, pa.binary())], ["uid", "paths", "n", "bits", "marks"])

    return member.mapInArrow(run, "uid long, paths array<long>, n long, bits binary, marks binary")


def _texts(wanted: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Rows with their text. Keys may repeat with other texts: the one whose set is meant is taken by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [hashlib.blake2b(shingle_set(t).tobytes(), digest_size=16).digest() == h
                    for t, h in zip(batch.column("text").to_pylist(), batch.column("set_hash").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    joined = wanted.join(texts, wanted[key].eqNullSafe(texts[key])).drop(wanted[key]).drop(texts[key])
    joined = joined.where("text is not null").select("group", "side", "cross", "path", "uid", "n", "paths", "bits", "weight", "set_hash", "text")
    return joined.mapInArrow(run, joined.schema)


def _result(sketches: DataFrame, classes: DataFrame, counts: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    reached = classes.join(counts.withColumnRenamed("uid", "rep"), "rep", "left").join(parts.select(F.col("id").alias("rep"), "component"), "rep", "left")
    per_class = stored(reached.select(
        "set_hash", F.coalesce("component", "rep").alias("component"), F.col("weight").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - F.lit(1)).alias("n_links")))
    rows = stored(sketches.select(F.col(key), "mark", "uid", "set_hash").join(per_class, "set_hash", "left").select(
        F.col(key), "mark", "uid", F.coalesce("component", "uid").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")))
    first = stored(rows.groupBy("component").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("uid").alias("uid"))).alias("first")))
    out = rows.join(first, "component")
    return out.select(F.col(key), "mark", F.col("first.key").alias("class_id"), "n_links", "n_copies", (F.col("uid") == F.col("first.uid")).alias("kept"))
