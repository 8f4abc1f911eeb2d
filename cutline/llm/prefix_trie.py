"""Trie of conversation prefixes, with totals over subtrees by depth bands.

A prefix is known by a 128-bit key, the exclusive or of hashes of (position, role, text), so running windows make the keys of
all prefixes and texts never move. A node is named by its smallest member, and that conversation's own row stands for it.
Depths are cut into bands of a fixed height. A node adds its figures to its ancestors inside its band only; the band roots,
with the totals of their bands, form a trie that is lower by the height, and are rolled up by the same step; at last every
band root hands its whole total to its ancestors in the band above. So a node becomes ``height`` rows at most and the steps grow
with the logarithm of the depth. Every aggregation combines before its shuffle, so a first turn that a third of all
conversations share arrives as one row from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import _importable, by_keys, stored, text_batches

HEIGHT = 8  # depths of a band
STRETCH = 4096  # turns whose keys one window makes; a longer conversation has several
ID_RANGE = 1 << 16  # conversation ids that are joined to one string in one row
KEY = ["k1", "k2"]
WEIGHTS = ["leaves", "saved"]


def numbered(rows: DataFrame, by: str, order: list[Column], out: str) -> DataFrame:
    """``rows`` with the position (from 1) of each among the rows of ``by`` in ``order``, stored.

    Rows go to ranges of (by, order), where ``order`` has to be total, so one value of ``by`` can fill many tasks. Positions
    inside a range come from its sort; only a value that a range shares with earlier ones needs what they hold of it.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, F.col(by), *order).sortWithinPartitions(F.col(by), *order).withColumn("__range", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            values = batch.column(by).to_numpy(zero_copy_only=False)
            if not len(values):
                continue
            first = np.concatenate([[True], values[1:] != values[:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))
            at = np.arange(1, len(values) + 1) - start
            if values[0] == last:
                at[start == 0] += held
            last, held = values[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "__at"])

    _importable(spark)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    local = stored(ranged.mapInArrow(run, f"{fields}, __at long"))
    ends = local.groupBy("__range").agg(F.min(F.struct(by, -F.col("__at"))).alias("a"), F.max(F.struct(by, "__at")).alias("b"))  # a row per range
    counts = ends.select("__range", "a.*").toDF("__range", by, "n").select("__range", by, (-F.col("n")).alias("n"))
    counts = counts.unionByName(ends.where(f"a.`{by}` <> b.`{by}`").select("__range", "b.*").toDF("__range", by, "n"))
    before = Window.partitionBy(by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.withColumn("__before", F.sum("n").over(before)).where("__before > 0").select("__range", by, "__before"))
    placed = local.join(F.broadcast(offsets), ["__range", by], "left")  # one row per range at most
    return placed.select(*[c for c in rows.columns], (F.col("__at") + F.coalesce("__before", F.lit(0))).alias(out))


def turns_of(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, i, h1, h2, chars): position of each turn, two hashes of its role and text, code points of its text."""
    said = [F.coalesce(F.col(x), F.lit("")) for x in (role, text)]
    rows = conversations.select(
        F.col(key).cast("long").alias("c"), F.col(turn).alias("turn"), F.xxhash64(F.lit(1), *said).alias("h1"),
        F.xxhash64(F.lit(2), *said).alias("h2"), F.length(said[1]).cast("long").alias("chars")).where("c IS NOT NULL")
    rows = stored(rows.withColumn("u", F.monotonically_increasing_id()))
    return numbered(rows, "c", [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("u")], "i").drop("turn", "u")


def shared_heads(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns of the conversations rebuilt: the first h of the first conversation of each hundred, then the own ones after h."""
    heads = stored(turns.where("c % 100 = 0 AND i <= 5").withColumnRenamed("c", "base"))
    based = convs.withColumn("base", F.expr("c - c % 100")).withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % 6)
    lengths = heads.groupBy("base").agg(F.max("i").alias("held"))
    plans = stored(based.join(lengths, "base", "left").withColumn("held", F.least("h", F.coalesce("held", F.lit(0)))))
    given = plans.join(heads, "base").where("i <= h").select("c", F.col("i").alias("depth"), "h1", "h2", "chars")
    own = turns.join(plans.select("c", "h", "held"), "c").where("i > h").select("c", (F.col("i") - F.col("h") + F.col("held")).alias("depth"), "h1", "h2", "chars")
    return given.unionByName(own)


def prefixes_of(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, depth, k1, k2, chars): the key of every prefix, the empty one too; ``rebuilt`` is stored and its depths have no gaps."""
    mixed = rebuilt.select("c", "depth", "chars", F.xxhash64("depth", "h1").alias("e1"), F.xxhash64("h2", "depth").alias("e2"))
    mixed = mixed.withColumn("stretch", F.expr(f"(depth - 1) div {STRETCH}"))
    inside = Window.partitionBy("c", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored(mixed.select("c", "depth", "chars", "stretch", F.bit_xor("e1").over(inside).alias("k1"), F.bit_xor("e2").over(inside).alias("k2")))
    ends = local.where(F.col("depth") % STRETCH == 0)
    so_far = Window.partitionBy("c").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = stored(ends.select("c", (F.col("stretch") + 1).alias("stretch"), F.bit_xor("k1").over(so_far).alias("b1"), F.bit_xor("k2").over(so_far).alias("b2")))
    if not before.isEmpty():
        local = by_keys(local, before, ["c", "stretch"], "left").withColumns({k: F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0))) for k, b in (("k1", "b1"), ("k2", "b2"))})
    root = convs.select("c", *[F.lit(0).cast("long").alias(x) for x in ("depth", "k1", "k2", "chars")])
    return stored(local.select("c", "depth", "k1", "k2", "chars").unionByName(root))


def banded(rows: DataFrame, height: int) -> DataFrame:
    """Rows with their band; a band root is the end of the band above as well (``end``)."""
    own = rows.withColumn("band", F.expr(f"depth div {height}")).withColumn("end", F.lit(False))
    ends = rows.where(f"depth > 0 AND depth % {height} = 0").withColumn("band", F.expr(f"depth div {height} - 1")).withColumn("end", F.lit(True))
    return own.unionByName(ends)


def paths_of(prefixes: DataFrame, nodes: DataFrame, height: int) -> DataFrame:
    """(k1, k2, depth, end, up): for every node, and once more for a band root as the end of the band above, the keys from the
    root of that band down to the node. A conversation that names a node also names all its deeper ones, so its rows from the
    first such depth on stand for nodes."""
    first = banded(nodes.select("conv_id", "depth"), height).groupBy(F.col("conv_id").alias("c"), "band").agg(F.min("depth").alias("first"))
    along = Window.partitionBy("c", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = banded(prefixes.select("c", "depth", *KEY), height).join(first, ["c", "band"])
    return rows.withColumn("up", F.collect_list(F.struct(*KEY)).over(along)).where("depth >= first").select(*KEY, "depth", "end", "up")


def subtree_totals(prefixes: DataFrame, nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(k1, k2, leaves, saved) over the subtree of every node of ``nodes`` (conv_id, depth, k1, k2, leaves, saved)."""
    weights = nodes.select(*KEY, *WEIGHTS)

    def handed(rows: DataFrame, up: Column, of: DataFrame) -> DataFrame:
        return rows.join(of, KEY).select(F.explode(up).alias("to"), *WEIGHTS).select("to.*", *WEIGHTS)

    def summed(rows: DataFrame) -> DataFrame:
        return stored(rows.groupBy(*KEY).agg(*[F.sum(w).alias(w) for w in WEIGHTS]))

    local = summed(handed(paths.where("not end"), F.col("up"), weights))
    if nodes.where(F.col("depth") >= height).isEmpty():
        return local
    lower = prefixes.where(f"depth % {height} = 0").withColumn("depth", F.expr(f"depth div {height}"))
    roots = nodes.where(f"depth % {height} = 0").select("conv_id", F.expr(f"depth div {height}").alias("depth"), *KEY)
    roots = stored(roots.join(local, KEY))
    totals = subtree_totals(lower, roots, stored(paths_of(lower, roots, height)), height)
    passed = handed(paths.where("end"), F.expr("slice(up, 1, size(up) - 1)"), totals)
    return summed(local.unionByName(passed))


def end_digests(prefixes: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): SHA-256 of the comma-joined ids of the conversations that end at a node.

    Ids are joined by ranges first, so a node where very many end gets one row per range; its hash has to see them in order,
    so these rows pass one task as a stream.
    """
    last = prefixes.groupBy("c").agg(F.max(F.struct("depth", *KEY)).alias("x")).select("c", "x.*")
    pieces = last.groupBy(*KEY, F.floor(F.col("c") / F.lit(ID_RANGE)).alias("range")).agg(F.sort_array(F.collect_list("c")).alias("ids"))
    pieces = pieces.select(*KEY, "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("ids").to_pylist()):
                if key != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digests(out)
        if now:
            yield _digests([(*now, digest.hexdigest())])

    moved = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids")
    return text_batches(moved, run, "k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], [*KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, rebuild: bool = True, height: int = HEIGHT, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of all conversations' turns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    Turns are ordered by ``turn``, a null first; equal turns by hashes of role and text, so any order of the rows gives the same
    trie, and a repeated row is one more turn. Null roles and texts are empty. Rows without a key belong to no conversation.
    ``rebuild`` first gives every conversation the head of the first one of its hundred (``shared_heads``). ``saved_tokens``:
    code points of last texts times further members, over the subtree. Other columns are ignored; an empty table gives no rows.
    """
    turns = turns_of(conversations, key, turn, role, text)
    turns = stored(turns)
    convs = stored(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c"))
    rebuilt = stored(shared_heads(turns, convs) if rebuild else turns.withColumnRenamed("i", "depth"))
    prefixes = prefixes_of(rebuilt, convs)
    found = stored(prefixes.groupBy(*KEY, "depth").agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars")))
    paths = stored(paths_of(prefixes, found, height))
    parent = paths.where("size(up) > 1").withColumn("parent", F.expr("up[size(up) - 2]")).select(*KEY, F.col("parent.k1").alias("p1"), F.col("parent.k2").alias("p2"))
    children = parent.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(found.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumns({
        "leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}))
    totals = subtree_totals(prefixes, nodes.select("conv_id", "depth", *KEY, *WEIGHTS), paths, height)
    named = stored(parent.join(found.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")), ["p1", "p2"]).select(*KEY, "parent_conv_id"))
    ends = stored(end_digests(prefixes))
    out = nodes.drop(*WEIGHTS).join(totals, KEY).join(named, KEY, "left").join(ends, KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
