"""Repeated passages by suffix arrays: every byte of a 100-byte string that also starts earlier goes.

Copies of whole texts are one text first. Each window of 100 bytes names an anchor, the 24 bytes in it with the smallest hash, so
equal windows name equal anchors at the same distance. Consecutive windows with one anchor form a segment, and a segment
moves by its anchor as two hashes and a place, without its bytes. Equal segments are one string whose first place stays. Only
anchors with different segments can hide more equal windows: the bytes of those segments are fetched and dealt by anchor into shards.
Each shard gets a suffix array by induced sorting and permuted common prefixes; neighbours that share 100 bytes are equal
windows, and all but the first place repeat.

Rows of anchors that a sample of documents shows to be frequent are dealt by anchor and segment, and an anchor with more
different segments than a shard takes is dealt again by longer common strings, down to whole windows, so no anchor fills a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import bucketed, by_keys, stored, text_batches
from cutline.llm.shingles import _tables, mix
from cutline.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 100  # bytes of a window
GRAM = 24  # bytes of an anchor
PIECE = 1 << 16  # bytes whose windows are hashed at once
HELD_ROWS = 1 << 18  # segments of a task that are compared before they move
SHARD = 1 << 17  # bytes of a shard, about
GROUP = 2048  # different segments of one anchor that a shard takes
SALTS = 64  # equal parts of an anchor's segments that meet in a task first
CELLS = (8, 1)  # distances to the anchor that share a longer string, for anchors with more
SAMPLE, FREQUENT = 64, 32  # one document in so many is looked at for frequent anchors, which have so many segments there
FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
BUCKET = 64 << 20  # text bytes of a bucket, about
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ROW = "key long, seg long, d long, t long, x long"
FIELDS = pa.schema([(c, pa.int64()) for c in ("key", "seg", "d", "t", "x")])


# x holds the place of a segment: first window << 16 | frequent << 14 | anchor's distance from the first window << 7 | windows


def place(first: np.ndarray, ahead: np.ndarray, n: np.ndarray) -> np.ndarray:
    return first << 16 | ahead << 7 | n


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position on."""
    w = raw.astype(np.uint64)
    for by in (1, 2, 4):
        w = w[:-by] | w[by:] << np.uint64(8 * by)
    m = len(raw) - GRAM + 1
    return mix(sum(w[8 * i : 8 * i + m] * f for i, f in enumerate(FACTORS)))


def byte_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def span_hashes(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)).view(np.int64)


def segments(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """(piece, first window, windows, anchor's distance, anchor hash, segment hash) of all segments. 48 bits do for the anchor:
    two that share a hash are only compared in vain."""
    raw = np.frombuffer(b"\xff".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    width = LENGTH - GRAM + 1
    hashes = gram_hashes(raw)
    at = hashes & ~np.uint64(0xFFFFFF) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        at, span = np.minimum(at[:-span], at[span:]), span * 2
    count = len(raw) - LENGTH + 1
    if span < width:
        at = np.minimum(at[:count], at[width - span : width - span + count])
    anchor = (at & np.uint64(0xFFFFFF)).astype(np.int64)
    turns = np.zeros(count + 1, np.int8)
    long = sizes >= LENGTH
    turns[starts[long]] = 1
    turns[starts[long] + sizes[long] - LENGTH + 1] -= 1
    inside = np.cumsum(turns[:count], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    piece = np.searchsorted(starts, first, side="right") - 1
    last = np.minimum(np.append(first[1:], count), starts[piece] + sizes[piece] - LENGTH + 1)
    a = anchor[first]
    seg = span_hashes(*byte_sums(raw), first, last + LENGTH - 1)
    return piece, first - starts[piece], last - first, a - first, (hashes[a] >> np.uint64(16)).view(np.int64), seg


def pieces_of(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(text number, first byte, bytes) in lists of about ``PIECE`` bytes; a longer text is cut so that each window is in one piece."""
    numbers, bases, parts, held = [], [], [], 0
    for i, raw in enumerate(texts):
        for base in range(0, max(1, len(raw) - LENGTH + 1), PIECE):
            part = raw[base : base + PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            numbers.append(i)
            bases.append(base)
            parts.append(part)
            held += len(part)
            if held >= PIECE:
                yield numbers, bases, parts
                numbers, bases, parts, held = [], [], [], 0
    if parts:
        yield numbers, bases, parts


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _segment_rows(frequent: np.ndarray):
    """Texts (d, t, text) to segment rows. Of equal segments that a task meets together only the first place goes on by anchor;
    the others, repeats for certain, go without a key."""

    def closed(held: list[np.ndarray]) -> pa.RecordBatch:
        key, seg, d, t, x = np.concatenate(held, axis=1)
        order = np.lexsort((x, t, d, seg, key))
        key, seg, d, t, x = (c[order] for c in (key, seg, d, t, x))
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (seg[1:] == seg[:-1])
        same = np.zeros(len(key), bool)
        same[1:] = again[1:] & (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (x[1:] == x[:-1])  # a repeated row is one document
        keep = ~same
        x = np.where(np.isin(key, frequent), x | 1 << 14, x) if len(frequent) else x
        return pa.RecordBatch.from_arrays([pa.array(key[keep], mask=again[keep]), *(pa.array(c[keep]) for c in (seg, d, t, x))], schema=FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            d, t = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "t"))
            for numbers, bases, parts in pieces_of(_bytes(batch.column("text"))):
                piece, first, n, ahead, key, seg = segments(parts)
                of = np.array(numbers)[piece]
                held.append(np.stack([key, seg, d[of], t[of], place(first + np.array(bases, np.int64)[piece], ahead, n)]))
                rows += len(key)
            if rows >= HELD_ROWS:
                yield closed(held)
                held, rows = [], 0
        if rows:
            yield closed(held)

    return run


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, seg, d, t, x): repeats come out without a key, first places keep theirs where their key has another
    segment (or is frequent, so that its segments lie elsewhere too), all other first places are done with."""
    last = last_place = waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        null = batch.column("key").is_null().to_numpy(zero_copy_only=False)
        if null.any():
            yield batch.filter(pa.array(null))
            batch = batch.filter(pa.array(~null))
            if not batch.num_rows:
                continue
        key, seg, d, t, x = (batch.column(c).to_numpy(zero_copy_only=False) for c in FIELDS.names)
        new_key, new_seg = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        if last is not None:
            new_key[0] = key[0] != last[0]
        new_seg[1:] = seg[1:] != seg[:-1]
        if last is not None:
            new_seg[0] = seg[0] != last[1]
        new_seg |= new_key
        firsts = np.flatnonzero(new_seg)
        of = np.searchsorted(firsts, np.arange(len(key)), side="right") - 1
        same = np.zeros(len(key), bool)  # the place of the first one itself, from a repeated row
        known = of >= 0
        f = firsts[of[known]] if len(firsts) else np.zeros(0, np.int64)
        same[known] = (d[known] == d[f]) & (t[known] == t[f]) & (x[known] == x[f])
        if last_place is not None:
            same[~known] = (d[~known] == last_place[0]) & (t[~known] == last_place[1]) & (x[~known] == last_place[2])
        again = ~new_seg & ~same
        multi = new_seg & (~new_key | (x >> 14 & 1).astype(bool))
        if len(firsts):
            followed = np.append(~new_key[firsts[1:]], False)
            multi[firsts[followed]] = True
            if waiting is not None and not new_key[firsts[0]]:
                yield waiting
            end = firsts[-1]
            waiting = None if multi[end] else batch.slice(end, 1)
            last_place = d[end], t[end], x[end]
        last = key[-1], seg[-1]
        out = np.flatnonzero(again | multi)
        if len(out):
            found = batch.take(pa.array(out))
            columns = [pa.array(key[out], mask=again[out]), *found.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def first_places(rows: DataFrame, schema: str, salts: int = 1) -> DataFrame:
    """``_first_places`` of rows dealt by key, or by key, segment and one of ``salts`` where the key is frequent. With several salts
    a segment keeps a place for each, and another pass has to follow."""
    apart = F.xxhash64("key", "seg", F.pmod(F.xxhash64("d", "x"), F.lit(salts)))
    dealt = F.when(F.col("key").isNull(), F.xxhash64("d", "x")).when(F.col("x").bitwiseAND(1 << 14) != 0, apart).otherwise(F.col("key"))
    moved = rows.repartition(dealt).sortWithinPartitions("key", "seg", "d", "t", "x")
    return moved.mapInArrow(_first_places, schema)


def cells(n: np.ndarray, ahead: np.ndarray, cell: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, core start, core end) of the windows of segments whose distance to the anchor is in a cell; all
    such windows hold the core. Positions count from the first window; no window where first > last."""
    low = cell * width
    return np.maximum(ahead - low - width + 1, 0), np.minimum(ahead - low, n - 1), ahead - low, ahead - low - width + 1 + LENGTH


def candidates(keys: np.ndarray, blobs: list[bytes], n: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) that may be repeated in another segment of the same key: those near and those far from the anchor
    share a core of 62 bytes each, which has to occur twice. No windows: zero."""
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    size = np.array([len(b) for b in blobs], np.int64)
    base = np.cumsum(size) - size
    sums, down = byte_sums(raw)
    half = (LENGTH - GRAM + 2) // 2
    first, last = np.full(len(keys), 1 << 30, np.int64), np.full(len(keys), -1, np.int64)
    for c in (0, 1):
        a, b, start, end = cells(n, ahead, np.int64(c), half)
        here = np.flatnonzero(a <= b)
        core = span_hashes(sums, down, base[here] + start[here], base[here] + end[here])
        order = np.lexsort((core, keys[here]))
        k, h = keys[here][order], core[order]
        twice = np.zeros(len(k) + 1, bool)
        twice[1:-1] = (k[1:] == k[:-1]) & (h[1:] == h[:-1])
        kept = here[order[twice[1:] | twice[:-1]]]
        first[kept], last[kept] = np.minimum(first[kept], a[kept]), np.maximum(last[kept], b[kept])
    return first, np.maximum(last - first + 1, 0)


def repeats(blobs: list[bytes], d: np.ndarray, t: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blob, first window, windows) of runs of windows that an earlier window of a blob equals; blob i starts at byte ``first[i]`` of
    document (d, t). One suffix array holds all blobs."""
    raw = np.frombuffer(b"\xff".join(blobs) + b"\xff", np.uint8)
    size = np.array([len(b) for b in blobs], np.int64)
    base = np.cumsum(size + 1) - size - 1
    sa = suffix_array(raw)
    joined = permuted_prefixes(raw, sa)[sa] >= LENGTH  # with the suffix before; no window holds the sign between blobs
    inside = np.arange(len(raw)) - np.repeat(base, size + 1)
    whole = inside + LENGTH <= np.repeat(size, size + 1)
    order = np.lexsort((t, d))
    step = np.concatenate([[0], (d[order][1:] != d[order][:-1]) | (t[order][1:] != t[order][:-1])]) if len(d) else np.zeros(0)
    rank = np.empty(len(d), np.int64)
    rank[order] = np.cumsum(step)
    where = np.repeat(rank << 32 | first, size + 1) + inside
    joined &= whole[sa] & np.concatenate([[False], whole[sa[:-1]]])
    starts = np.flatnonzero(~joined)
    earliest = np.minimum.reduceat(where[sa], starts)
    again = np.zeros(len(raw), bool)
    again[sa] = where[sa] > np.repeat(earliest, np.diff(np.append(starts, len(raw))))
    again &= whole
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    blob = np.searchsorted(base, begin, side="right") - 1
    return blob, begin - base[blob], end - begin


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, whole keys at a time, to places of repeated windows."""
    held, size = [], 0

    def solved(table: pa.Table) -> pa.RecordBatch:
        key, d, t, x = (table.column(c).to_numpy() for c in ("key", "d", "t", "x"))
        blobs = table.column("blob").to_pylist()
        n, ahead, start = x & 127, x >> 7 & 127, x >> 16
        first, count = candidates(key, blobs, n, ahead)
        at = np.flatnonzero(count)
        parts = [blobs[i][a : a + c + LENGTH - 1] for i, a, c in zip(at.tolist(), first[at].tolist(), count[at].tolist())]
        blob, begin, runs = repeats(parts, d[at], t[at], start[at] + first[at]) if parts else (at, at, at)
        of = at[blob]
        found = place(start[of] + first[of] + begin, np.zeros(len(of), np.int64), runs)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (d[of], t[of], found)], ["d", "t", "x"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy(zero_copy_only=False)
        turns = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and key[0] != held[-1].column("key")[-1].as_py():
            turns = np.concatenate([[0], turns])
        at = 0
        for cut in turns.tolist():
            part = batch.slice(at, cut - at)
            if part.num_rows:
                held.append(part)
                size += part.column("blob").nbytes
                at = cut
            if size >= SHARD:
                yield solved(pa.Table.from_batches(held))
                held, size = [], 0
        held.append(batch.slice(at))
        size += held[-1].column("blob").nbytes
    if held:
        yield solved(pa.Table.from_batches(held))


def _cells_of(width: int):
    """Segments to the parts whose windows lie in one cell; the key is the hash of the core, the segment hash that of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, d, t, x = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "d", "t", "x"))
            blobs = batch.column("blob").to_pylist()
            raw = np.frombuffer(b"".join(blobs), np.uint8)
            size = np.array([len(b) for b in blobs], np.int64)
            base = np.cumsum(size) - size
            sums, down = byte_sums(raw)
            n, ahead, start = x & 127, x >> 7 & 127, x >> 16
            for cell in range(-(-(LENGTH - GRAM + 1) // width)):
                a, b, left, right = cells(n, ahead, np.int64(cell), width)
                here = np.flatnonzero(a <= b)
                if not len(here):
                    continue
                a, b = a[here], b[here]
                core = span_hashes(sums, down, base[here] + left[here], base[here] + right[here])
                new = mix(key[here].view(np.uint64) * FACTORS[0] + core.view(np.uint64) + np.uint64(cell)).view(np.int64)
                seg = span_hashes(sums, down, base[here] + a, base[here] + b + LENGTH)
                moved = place(start[here] + a, ahead[here] - a, b - a + 1) | 1 << 14
                parts = [blobs[i][u : v + LENGTH] for i, u, v in zip(here.tolist(), a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (new, seg, d[here], t[here], moved)), pa.array(parts, pa.binary())], [*FIELDS.names, "blob"])

    return run


def _solved(rows: DataFrame) -> DataFrame:
    """Places of repeated windows of segment rows with bytes."""
    moved = rows.select("key", "d", "t", "x", "blob").repartition("key").sortWithinPartitions("key")
    return moved.mapInArrow(_shards, "d long, t long, x long")


def covered(x: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes (start, end) of all windows of the given places."""
    if not len(x):
        return []
    x = np.sort(x)
    start, end = x >> 16, (x >> 16) + (x & 127) + LENGTH - 1
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return list(zip(start[new].tolist(), reach[np.append(new[1:], len(x)) - 1].tolist()))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(d, t, x) of all segments of ``texts`` (d, t, text) whose windows repeat an earlier one, from stored tables."""
    spark = texts.sparkSession
    sampled = text_batches(texts.where(F.pmod(F.xxhash64("d", "t"), F.lit(SAMPLE)) == 0), _segment_rows(np.zeros(0, np.int64)), ROW)
    counts = stored(sampled.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    least = total // (20 * int(spark.conf.get("spark.sql.shuffle.partitions")))  # so at most 20 a partition are sent to the tasks
    frequent = np.sort(np.array([r["key"] for r in counts.where(F.col("n") >= least).select("key").collect()], np.int64))
    found = stored(first_places(text_batches(texts, _segment_rows(frequent), ROW), ROW))
    out = [found.where("key IS NULL").select("d", "t", "x")]
    open_rows = found.where("key IS NOT NULL").select("key", "d", "t", "x")
    if open_rows.isEmpty():
        return out[0]
    wanted = open_rows.groupBy("d", "t").agg(F.collect_list(F.struct("key", "x")).alias("asked"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked")
            of = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy(zero_copy_only=False))
            flat = asked.flatten()
            key, x = (flat.field(c) for c in ("key", "x"))
            raw = _bytes(batch.column("text"))
            blobs = [raw[i][v >> 16 : (v >> 16) + (v & 127) + LENGTH - 1] for i, v in zip(of.tolist(), x.to_pylist())]
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays([key, key, batch.column("d").take(take), batch.column("t").take(take), x, pa.array(blobs, pa.binary())], [*FIELDS.names, "blob"])

    rows = stored(text_batches(texts.join(wanted, ["d", "t"]), fetch, f"{ROW}, blob binary"))
    for width in (*CELLS, None):
        large = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("key"))
        if large.isEmpty():
            out.append(stored(_solved(rows)))
            break
        out.append(stored(_solved(by_keys(rows, large, ["key"], "left_anti"))))
        if width is None:
            raise AssertionError("equal windows are one segment")
        finer = text_batches(by_keys(rows, large, ["key"], "left_semi"), _cells_of(width), f"{ROW}, blob binary")
        for salts in (SALTS, 1):
            finer = stored(first_places(finer, f"{ROW}, blob binary", salts))
            out.append(finer.where("key IS NULL").select("d", "t", "x"))
            finer = finer.where("key IS NOT NULL")
        several = stored(finer.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
        rows = by_keys(finer, several, ["key"], "left_semi")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, spans (start and end of the maximal runs of bytes removed) and kept (the bytes left).

    A byte goes if a string of 100 bytes that covers it also starts earlier, in a document of smaller key or further up in the same
    one; strings never cross documents and are judged on the input. Texts count as UTF-8, null as empty. Keys are integers; a null
    key counts as the smallest. Documents that share a key are ordered by a hash of their text; rows that repeat key and text
    are one document and get the same result each. A cut may split a character, so ``kept`` is binary. Other columns are
    ignored; an empty table gives no rows.
    """
    base = _texts(docs, key, text)
    hashed = base.withColumn("sha", F.unhex(F.sha2("text", 256)))
    copies = stored(hashed.groupBy("sha").agg(F.min("d").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first"))
    shared = hashed.groupBy("d").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).where("a <> b")
    tie = F.xxhash64("text") if not shared.isEmpty() else F.lit(0).cast("long")
    marked = by_keys(hashed, copies, ["sha"], "left").withColumn("t", tie).withColumn("copy", F.coalesce(F.col("d") > F.col("first"), F.lit(False)))
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    texts = bucketed(marked.where("not copy").select("id", "d", "t", "text"), ["d", "t"], buckets)
    spans = repeated_windows(texts.select("d", "t", "text")).groupBy("d", "t").agg(F.collect_list("x").alias("runs"))
    kind = dict(docs.dtypes)[key]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, runs in zip(_bytes(batch.column("text")), batch.column("runs").to_pylist()):
                spans = covered(np.array(runs or [], np.int64))
                edges = [0, *(e for s in spans for e in s), len(raw)]
                out.append((len(raw), [{"start": a, "end": b} for a, b in spans], b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))))
            sizes, spans, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.binary())], [key, "n_bytes", "spans", "kept"])

    span = "array<struct<start: long, end: long>>"
    firsts = text_batches(texts.join(spans, ["d", "t"], "left").select("id", "text", "runs"), cut, f"`{key}` {kind}, n_bytes long, spans {span}, kept binary")
    n, raw = F.octet_length("text").cast("long"), F.col("text").cast("binary")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end"))).cast(span)
    again = marked.where("copy").select(
        F.col("id").alias(key), n.alias("n_bytes"), F.when(n >= LENGTH, whole).otherwise(F.array().cast(span)).alias("spans"),
        F.when(n >= LENGTH, F.lit(b"")).otherwise(raw).alias("kept"))
    return firsts.unionByName(again)
