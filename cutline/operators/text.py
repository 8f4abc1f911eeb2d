"""Comments to words: select new comments, split them, one row per kept word."""

from __future__ import annotations

import functools
import math
import tempfile
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.session import checkpointed

# fixed values: comments the shop writes itself
BOILERPLATE = ("评价方未及时做出评价,系统默认好评!", "好评！", " ")

LETTERS = r"[\p{L}]+"
CJK = "[一-龥]"
WORD_RUN = "[一-龥a-zA-Z0-9]+"
LITERAL_STOP_WORDS = 10_000
FILTER_BITS = 27  # two to this power is the size of the filter of beginnings of words in bits
MAP_BYTES = 4096  # of Spark's bit maps
BATCH_CHARS = 1 << 18  # characters of texts that are stored and cut together
ARROW_BYTES = 1 << 22  # of an Arrow batch of texts; a longer row is a batch of its own
SLICE_WORDS = 1 << 16
INDEX_BITS = 22
FEW_RUNS = 8  # so many runs are cut together at least
GROUP_CHARS, CHARS_A_WORD = 1 << 23, 32  # characters of a group of texts at least, in all and for each word of the dictionary
BASE, UNBASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BROADCAST_MARKS = 500_000
BROADCAST_NUMBERS = 2_000_000  # handled keys that are whole numbers, about 60 bytes each
WORDS_PER_TASK = 1_000_000
BETWEEN = "\x01"  # between the words of a list that moves as one text
MARK, LIST = "__mark", "__list"


def new_comments(
    comments: DataFrame,
    processed: DataFrame | None = None,
    orders: DataFrame | None = None,
    key: str = "oid",
    content: str = "content",
    created: str = "created",
    boilerplate: Sequence[str] = BOILERPLATE,
    begin=None,
    end=None,
) -> DataFrame:
    """Distinct comments not handled before, with the columns of the matching orders, if given.

    ``begin`` and ``end`` limit ``created`` to a half-open range. A NULL text is no comment.
    """
    out = comments.where(~F.col(content).isin(*boilerplate))
    for bound, after in ((begin, True), (end, False)):
        if bound is not None:
            limit = F.lit(str(bound)).cast(comments.schema[created].dataType)
            out = out.where(F.col(created) >= limit if after else F.col(created) < limit)
    if processed is not None:
        handled = checkpointed(processed.select(key).distinct())
        few = BROADCAST_NUMBERS if isinstance(comments.schema[key].dataType, T.IntegralType) else BROADCAST_MARKS
        out = out.join(F.broadcast(handled) if handled.count() <= few else handled, key, "left_anti")  # texts stay put in the first case
    if orders is not None:
        out = out.join(orders, key, "left")
    return distinct_rows(out)


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows. Equal rows have equal hashes, so whole texts are only compared, and only move, where hashes repeat."""
    marked = rows.withColumn(MARK, F.xxhash64(*rows.columns))
    repeated = checkpointed(marked.groupBy(MARK).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(MARK))
    found = repeated.count()
    if not found:
        return rows
    side = F.broadcast(repeated) if found <= BROADCAST_MARKS else repeated
    once, again = marked.join(side, MARK, "left_anti"), marked.join(side, MARK, "left_semi")
    return once.drop(MARK).unionByName(again.drop(MARK).dropDuplicates())


def counted_words(words: DataFrame, *by: str) -> DataFrame:
    """Rows ``n`` per ``by`` of a written table of words, most of which differ: a task gets about ``WORDS_PER_TASK``.

    The last column is the word. Words move as lists of those that lie together, by the columns before; those of a key with more
    than ``WORDS_PER_TASK`` rows move one by one, by all columns.
    """
    *keys, word = by
    cores, rows = words.sparkSession.sparkContext.defaultParallelism, F.count(F.lit(1)).alias("n")
    sizes = words.groupBy(*keys).agg(rows)
    whole = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    tasks = max(cores, -(-whole["n"] // WORDS_PER_TASK))
    if not keys or not isinstance(words.schema[word].dataType, T.StringType):
        return words.repartition(tasks, *by).groupBy(*by).agg(rows)
    lists = _listed(words.select(*by), keys, word)
    if whole["most"] <= WORDS_PER_TASK:
        return _unlisted(lists.repartition(tasks, *keys), keys, word).groupBy(*by).agg(rows)
    frequent = checkpointed(sizes.where(F.col("n") > WORDS_PER_TASK).select(*[F.col(k).alias(f"__{k}") for k in keys]))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    few = F.broadcast(frequent)  # at most one of a million words each
    rest = _unlisted(lists.join(few, same, "left_anti").repartition(tasks, *keys), keys, word)
    return rest.groupBy(*by).agg(rows).unionByName(words.select(*by).join(few, same, "left_semi").repartition(tasks, *by).groupBy(*by).agg(rows))


def _listed(words: DataFrame, keys: Sequence[str], word: str) -> DataFrame:
    """One row per run of words with equal keys inside an Arrow batch: the words as one text, or (``LIST``) as they are where one is
    NULL or holds ``BETWEEN``."""
    schema = T.StructType([*(words.schema[k] for k in keys), T.StructField(word, T.StringType()), T.StructField(LIST, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            new[0] = True
            for k in keys:
                column = batch.column(k)
                new[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            own = batch.column(word)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype("i4")), own.cast(pa.string()))
            odd = own.null_count or pc.any(pc.match_substring(own, BETWEEN)).as_py()
            none = pa.nulls(len(starts), pa.list_(pa.string()) if not odd else pa.string())
            both = [none, lists] if odd else [pc.binary_join(lists, BETWEEN), none]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(starts)) for k in keys), *both], schema.names)

    return words.mapInArrow(run, schema)


def _unlisted(lists: DataFrame, keys: Sequence[str], word: str) -> DataFrame:
    return lists.select(*keys, F.explode(F.coalesce(LIST, F.split(word, BETWEEN, -1))).alias(word))


def letter_words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def with_prefixes(costs: Mapping[str, float]) -> dict[str, float]:
    """The costs, and an infinite cost for every beginning of a word that is no word itself."""
    out = dict.fromkeys((w[:i] for w in costs for i in range(1, len(w))), math.inf)
    out.update(costs)
    return out


def split_run(run: str, cost: Mapping[str, float], unknown: float) -> list[str]:
    """Cut a run into the dictionary words with the smallest total cost; unknown characters stand alone."""
    n = len(run)
    total, end = [0.0] * (n + 1), [0] * n
    for i in range(n - 1, -1, -1):
        least, at, j = unknown + total[i + 1], i + 1, i + 1
        while j <= n and (price := cost.get(run[i:j])) is not None:
            if price + total[j] <= least:
                least, at = price + total[j], j
            j += 1
        total[i], end[i] = least, at
    words, i = [], 0
    while i < n:
        words.append(run[i:end[i]])
        i = end[i]
    return words


def hash_sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of code points times powers, and the inverse powers: what ``string_checks`` takes."""
    up, down = np.full(len(points) + 1, BASE, np.uint64), np.full(len(points) + 1, UNBASE, np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * np.cumprod(up)[:-1], out=sums[1:])
    return sums, np.cumprod(down)


def string_checks(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32 bits of a polynomial hash of each string from ``starts`` to ``ends``."""
    x = (sums[ends] - sums[starts]) * down[starts]
    return ((x ^ x >> np.uint64(31)) * BASE >> np.uint64(32)).astype(np.uint32)


def longer(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings that are one character longer."""
    x = (hashes ^ points) * BASE
    return x ^ x >> np.uint64(32)


def _points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each starts (and the last ends)."""
    sizes = np.cumsum([0, *map(len, texts)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), sizes


def beginnings(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, hashes) of all beginnings of the strings, those of one length at a time."""
    at, hashes, n = np.arange(len(starts)), np.full(len(starts), BASE, np.uint64), 0
    while True:
        go = starts[at] + n < ends[at]
        at, hashes = at[go], hashes[go]
        if not len(at):
            return
        hashes = longer(hashes, points[starts[at] + n])
        n += 1
        yield n, at, hashes


def filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte and shift of the two bits of the filter for each hash."""
    bit = (hashes >> np.uint64(65 - FILTER_BITS) << np.uint64(1)).astype(np.int64)
    return bit >> 3, (bit & 7).astype(np.uint8)


def beginnings_filter(words: DataFrame) -> np.ndarray:
    """A bit map with two bits for a hash, of a beginning of a word and of a word, of a fixed size however many words there are.

    It only tells where to stop looking for longer words, and what to look up; the more words, the less it spares.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            points, at = _points(batch.column(0).to_pylist())
            for n, i, hashes in beginnings(points, at[:-1], at[1:]):
                byte, shift = filter_places(hashes)
                np.bitwise_or.at(held, byte, np.where(at[i + 1] - at[i] == n, np.uint8(3), np.uint8(1)) << shift)
        for start in range(0, len(held), MAP_BYTES):
            if held[start : start + MAP_BYTES].any():
                yield pa.RecordBatch.from_pydict({"start": [start], "map": [held[start : start + MAP_BYTES].tobytes()]})

    parts = words.select("word").mapInArrow(bits, "start long, map binary").groupBy("start").agg(F.bitmap_or_agg("map").alias("map"))
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for r in parts.collect():  # 4 KB of bits a row, 16 MB in all
        out[r["start"] : r["start"] + len(r["map"])] = np.frombuffer(r["map"], np.uint8)
    return out


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def dictionary_slices(entries: DataFrame, count: int, whole: float) -> DataFrame:
    """(slice, body) of the dictionary: hash, check and cost of its words by hash, about ``SLICE_WORDS`` in a row."""
    wide = max(0, (count // SLICE_WORDS).bit_length())

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, at = _points(batch.column("word").to_pylist())
            hashes = np.zeros(batch.num_rows, np.uint64)
            for _, i, h in beginnings(points, at[:-1], at[1:]):
                hashes[i] = h  # the last one that is written is the whole word's
            cost = [whole - math.log(max(n, 1.0)) for n in batch.column("frequency").to_pylist()]
            part = (hashes >> np.uint64(64 - wide)).astype(np.int32) if wide else np.zeros(len(hashes), np.int32)
            check = string_checks(*hash_sums(points), at[:-1], at[1:])
            yield pa.RecordBatch.from_pydict({"slice": part, "hash": hashes.view(np.int64), "check": check.view(np.int32), "cost": np.array(cost, float)})

    def packed(rows: pa.Table) -> pa.Table:
        hashes, check, cost = (rows.column(c).to_numpy() for c in ("hash", "check", "cost"))
        hashes, check = hashes.view(np.uint64), check.view(np.uint32)
        order = np.lexsort((check, hashes))
        body = pa.RecordBatch.from_pydict({"step": np.diff(hashes[order], prepend=np.uint64(0)), "check": check[order], "cost": cost[order]})
        return pa.table({"slice": rows.column("slice")[:1], "body": pa.array([_ipc(body)], pa.binary())})

    hashed = entries.mapInArrow(keyed, "slice int, hash long, check int, cost double")
    return checkpointed(hashed.groupBy("slice").applyInArrow(packed, "slice int, body binary"))


class Words:
    """A dictionary in a task: its slices lie one after another in files without a name, mapped, so its size takes no memory."""

    def __init__(self) -> None:
        self.files = [tempfile.TemporaryFile() for _ in range(3)]
        self.count = 0

    def add(self, body: pa.RecordBatch) -> None:
        step, check, cost = (body.column(c).to_numpy() for c in ("step", "check", "cost"))
        for file, values in zip(self.files, (np.cumsum(step, dtype=np.uint64), check, np.where(np.isnan(cost), math.inf, cost))):
            file.write(values.tobytes())
        self.count += len(step)

    def ready(self) -> None:
        for file in self.files:
            file.flush()
        kinds = (np.uint64, np.uint32, np.float64)
        self.hashes, self.checks, self.costs = (np.memmap(f, t, "r", shape=(self.count,)).view(np.ndarray) if self.count else np.zeros(0, t) for f, t in zip(self.files, kinds))
        self.shift = np.uint64(64 - min(INDEX_BITS, max(1, self.count.bit_length())))
        self.index = np.searchsorted(self.hashes, np.arange(1 << 64 - int(self.shift), dtype=np.uint64) << self.shift)

    def look_up(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Where each string stands in the dictionary, or -1."""
        found = np.full(len(hashes), -1)
        if not self.count:
            return found
        todo, at = np.arange(len(hashes)), self.index[hashes >> self.shift]
        while True:
            inside = at < self.count
            todo, at = todo[inside], at[inside]
            if not len(todo):
                return found
            there, wanted = self.hashes[at], hashes[todo]
            same = there == wanted
            equal = np.flatnonzero(same)
            equal = equal[self.checks[at[equal]] == checks[todo[equal]]]
            found[todo[equal]] = at[equal]
            same[equal] = False
            on = np.flatnonzero((there < wanted) | same)
            todo, at = todo[on], at[on] + 1


def _edges(points: np.ndarray, left: np.ndarray, held: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, cost) of all words inside runs, shorter ones first; ``left``: characters up to the end of the run."""
    sums, down = hash_sums(points)
    at, hashes, n = np.arange(len(points)), np.full(len(points), BASE, np.uint64), 0
    starts, lengths, costs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    while len(at):
        hashes = longer(hashes, points[at + n])
        n += 1
        byte, shift = filter_places(hashes)
        told = held[byte] >> shift
        maybe = np.flatnonzero(told & 2)
        own = at[maybe]
        found = words.look_up(hashes[maybe], string_checks(sums, down, own, own + n))
        hit = np.flatnonzero(found >= 0)
        starts.append(own[hit])
        lengths.append(np.full(len(hit), n))
        costs.append(words.costs[found[hit]])
        go = np.flatnonzero((told & 1).astype(bool) & (left[at] > n))
        at, hashes = at[go], hashes[go]
    return tuple(map(np.concatenate, (starts, lengths, costs)))


def _by_distance(left: np.ndarray, most: int) -> tuple[np.ndarray, list[int]]:
    """Positions by their distance up to ``most``, and where each distance starts; other positions are left out."""
    near = np.flatnonzero(left <= most)
    order = near[np.argsort(left[near].astype(np.uint16), kind="stable")]
    return order, np.concatenate([[0], np.cumsum(np.bincount(left[near], minlength=most + 1))]).tolist()


def split_runs(points: np.ndarray, stops: np.ndarray, held: np.ndarray, words: Words, unknown: float) -> np.ndarray:
    """Where the words of all runs start, cut as ``split_run`` does; a run ends at each of ``stops``.

    All runs are cut together, from their ends on, one character at a time; what only a few runs reach is cut run by run.
    """
    sizes = np.diff(stops, prepend=0)
    run = np.repeat(np.arange(len(stops)), sizes)
    left = stops[run] - np.arange(len(points))
    start, length, cost = _edges(points, left, held, words)
    slot = np.arange(len(points)) + run  # behind each run is a slot that costs nothing
    total, end = np.zeros(len(points) + len(stops)), np.zeros(len(points) + len(stops), np.int64)
    reached = np.bincount(left)
    most = min(int((reached[1:] >= FEW_RUNS).sum()), (1 << 16) - 1)
    distance = left[start]
    order, cuts = _by_distance(left, most)
    edges, edge_cuts = _by_distance(distance, most)
    own, first, last, price = slot[order], slot[start[edges]], slot[start[edges]] + length[edges], cost[edges]
    for d in range(1, most + 1):
        at = own[cuts[d] : cuts[d + 1]]
        total[at], end[at] = unknown + total[at + 1], at + 1
        s = slice(edge_cuts[d], edge_cuts[d + 1])
        i, j = first[s], last[s]
        sums = price[s] + total[j]
        np.minimum.at(total, i, sums)
        best = sums == total[i]
        end[i[best]] = j[best]  # the last of equal ones, the longest word, stays
    far = np.flatnonzero(left > most)
    if len(far):
        rest = np.flatnonzero(distance > most)
        rest = rest[np.lexsort((length[rest], start[rest], distance[rest]))]
        ways = zip(start[rest].tolist(), (slot[start[rest]] + length[rest]).tolist(), cost[rest].tolist())
        way, sums = next(ways, None), total.tolist()
        for p, at in zip(*(x[np.lexsort((far, left[far]))].tolist() for x in (far, slot[far]))):
            least, to = unknown + sums[at + 1], at + 1
            while way and way[0] == p:
                if way[2] + sums[way[1]] <= least:
                    least, to = way[2] + sums[way[1]], way[1]
                way = next(ways, None)
            sums[at], end[at] = least, to
    cut = np.zeros(len(total), bool)
    ends, at = stops + np.arange(len(stops)), (stops - sizes) + np.arange(len(stops))
    over = np.zeros(len(total), bool)
    over[ends] = True
    while len(at):
        cut[at] = True
        at = end[at]
        at = at[~over[at]]
    return np.flatnonzero(cut[slot])


def _texts(column: pa.Array) -> list[str]:
    try:
        return [t or "" for t in column.to_pylist()]
    except UnicodeDecodeError:  # as Java reads them
        return [(t or b"").decode(errors="replace") for t in column.cast(pa.binary()).to_pylist()]


def words_of_texts(column: pa.Array, held: np.ndarray, words: Words, unknown: float) -> pa.Array:
    """The words of each text that have a CJK character and no digit."""
    points, rows = _points(_texts(column))
    ideograph = (points >= 0x4E00) & (points <= 0x9FA5)  # CJK
    digit = (points >= 48) & (points <= 57)
    low = points | 32
    inside = ideograph | digit | (low >= 97) & (low <= 122) & (points < 128)  # WORD_RUN
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = rows[:-1][rows[:-1] < rows[1:]]
    first[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    seen = np.concatenate([[0], np.cumsum(ideograph)])
    own = seen[ends] > seen[starts]
    starts, ends = starts[own], ends[own]
    sizes = ends - starts
    stops = np.cumsum(sizes)
    place = np.repeat(starts - (stops - sizes), sizes) + np.arange(sizes.sum())
    points, ideograph, digit = points[place], ideograph[place], digit[place]
    missing = column.is_null()
    if not len(points):
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(column) + 1, "i4")), pa.array([], pa.string()), mask=missing)
    cut = split_runs(points, stops, held, words, unknown)
    bytes_of = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
    offsets = np.append(bytes_of[cut], bytes_of[-1]).astype("i4")
    found = pa.StringArray.from_buffers(len(cut), pa.py_buffer(offsets), pa.py_buffer(points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")))
    keep = np.logical_or.reduceat(ideograph, cut) & ~np.logical_or.reduceat(digit, cut)
    row = np.searchsorted(rows, place[cut[keep]], side="right") - 1
    lists = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(column)))]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(lists), found.filter(pa.array(keep)), mask=missing)


def dictionary_words(df: DataFrame, text: str, dictionary: DataFrame, out: str) -> DataFrame:
    """Words of unsegmented text by a (word, frequency) dictionary; words need a CJK character and no digit.

    The dictionary stays a table, of any size: hash, check and cost of its words go in compressed slices to each of a few groups
    of texts, so that the copies stay small beside the texts, and are mapped from disk there. A word is told by 96 bits.
    Texts are stored once, compressed. Each run is cut along the cheapest path. Frequencies of a repeated word add up. A NULL
    text has no words.
    """
    spark = df.sparkSession
    entries = checkpointed(dictionary.where("word IS NOT NULL AND word <> ''").groupBy("word").agg(
        F.sum(F.coalesce(F.col("frequency").cast("double"), F.lit(0.0))).alias("frequency")))
    facts = entries.agg(F.sum("frequency").alias("whole"), F.count(F.lit(1)).alias("n")).first()
    whole, count = math.log(facts["whole"] or 1.0), facts["n"]
    shared = spark.sparkContext.broadcast(beginnings_filter(entries))
    names, schema = df.columns, T.StructType([*df.schema, T.StructField(out, T.ArrayType(T.StringType()))])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1 if batch.num_rows else []
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if b > a:
                    chars = int(sizes[b - 1] - (sizes[a - 1] if a else 0))
                    yield pa.RecordBatch.from_pydict({"number": [number], "chars": [chars], "body": pa.array([_ipc(batch.slice(a, b - a))], pa.binary())})
                    number += 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, of, open_ = shared.value, None, None, False
        for batch in batches:
            for part, is_text, body in zip(*(batch.column(c) for c in ("part", "is_text", "body"))):
                if part.as_py() != of:
                    words, of, open_ = Words(), part.as_py(), True
                rows = pa.ipc.open_stream(body.as_buffer()).read_next_batch()
                if not is_text.as_py():
                    words.add(rows)
                    continue
                if open_:
                    words.ready()
                    open_ = False
                yield pa.RecordBatch.from_arrays([*rows.columns, words_of_texts(rows.column(text), held, words, whole)], [*names, out])

    conf, key = spark.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("b")) > ARROW_BYTES:  # read when a plan runs, so the session keeps it; it changes no result
        conf.set(key, str(ARROW_BYTES))
    texts = checkpointed(df.mapInArrow(packed, "number long, chars long, body binary"))
    size = texts.agg(F.coalesce(F.sum("chars"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    groups = max(1, min(size["rows"], max(spark.sparkContext.defaultParallelism, size["n"] // max(GROUP_CHARS, CHARS_A_WORD * count))))
    copies = dictionary_slices(entries, count, whole).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(False).alias("is_text"), "slice", "body")
    own = texts.select(F.pmod("number", F.lit(groups)).cast("int").alias("part"), F.lit(True).alias("is_text"), F.lit(0).alias("slice"), "body")
    dealt = copies.unionByName(own).repartitionById(groups, F.col("part")).sortWithinPartitions("part", "is_text", "slice")
    return dealt.select("part", "is_text", "body").mapInArrow(cut, schema)


def spread(scan: DataFrame) -> DataFrame:
    """Give a plain scan of a few files one partition per core; a scan of many files stays as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def word_rows(
    comments: DataFrame,
    text: str,
    stop_words: DataFrame | Sequence[str] = (),
    dictionary: DataFrame | None = None,
    word: str = "word",
    min_length: int = 2,
) -> DataFrame:
    """One row per word longer than one character that is no stop word; repeated words stay repeated."""
    if dictionary is None:
        split = comments.withColumn("__words", letter_words(F.col(text)))
    else:
        split = dictionary_words(comments, text, dictionary, "__words")
    keep = [c for c in comments.columns if c != text]
    rows = split.select(*keep, F.explode("__words").alias(word)).where(F.length(word) >= min_length)
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select(F.col(stop_words.columns[0]).alias(word)).distinct()
        few = [r[0] for r in listed.limit(LITERAL_STOP_WORDS + 1).collect()]
        if len(few) > LITERAL_STOP_WORDS:
            return rows.join(listed, word, "left_anti").select(*keep, word)
        stop_words = few
    stop_words = [w for w in stop_words if w is not None]
    return rows.where(~F.col(word).isin(*stop_words)) if stop_words else rows


def newest_first(words: DataFrame, created: str = "created") -> DataFrame:
    return words.orderBy(F.desc(created))
