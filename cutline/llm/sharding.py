"""Sharding by jump consistent hashing: a key's shard follows from the key and the shard count alone.

Growing from n to n + 1 shards moves 1 / (n + 1) of the keys, all of them into the new shard, and no ring table is kept.
The published generator is used (64-bit congruential, multiplier 2862933555777941757), in two 32-bit halves, since Spark's
64-bit product raises on overflow. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutline.llm.common import stored

MULTIPLIER = 2862933555777941757
STEPS = 48  # jumps tried at first; a key that needs more gets all the steps there can be
CHUNK_ROWS = 20_000  # rows whose slots one task numbers, about

_LOW = 0xFFFFFFFF


def _long(value) -> Column:
    return F.lit(value).cast("long")


def _step(state: Column) -> Column:
    """One turn of the generator and the jump that follows."""
    low_m, high_m = _long(MULTIPLIER & _LOW), _long(MULTIPLIER >> 32)
    hi, lo = state["hi"], state["lo"]

    def low_product(a: Column, b: Column) -> Column:  # a * b mod 2**32 for 32-bit a, b
        return (a.bitwiseAND(_long(0xFFFF)) * b + F.shiftleft((F.shiftrightunsigned(a, 16) * b).bitwiseAND(_long(0xFFFF)), 16)).bitwiseAND(_long(_LOW))

    upper = F.shiftrightunsigned(lo, 16) * low_m
    lower = lo.bitwiseAND(_long(0xFFFF)) * low_m + F.shiftleft(upper.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
    carry = F.shiftrightunsigned(lower, 32) + F.shiftrightunsigned(upper, 16)
    new_hi = (carry + low_product(hi, low_m) + low_product(lo, high_m)).bitwiseAND(_long(_LOW))
    jump = F.floor((state["j"] + _long(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(new_hi, 1) + _long(1)).cast("double"))).cast("long")
    return F.struct(state["j"].alias("b"), jump.alias("j"), new_hi.alias("hi"), lower.bitwiseAND(_long(_LOW)).alias("lo"))


def jump_state(key: Column, shards: int) -> Column:
    """Struct (b, j, …): b is the shard, j the next jump, the first that leaves the shards."""
    start = F.struct(_long(-1).alias("b"), _long(0).alias("j"), F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(_long(_LOW)).alias("lo"))

    def run(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: F.when(s["j"] < _long(shards), _step(s)).otherwise(s))

    first = run(start, min(shards, STEPS))
    if shards <= STEPS:
        return first
    return F.when(first["j"] >= _long(shards), first).otherwise(run(first, shards))


def with_shard(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """Add the shard of each row's integer ``key`` (null keys count as 0); ``grown``: the shard with one shard more."""
    if shards < 1:
        raise ValueError("at least one shard")
    extra = [c for c in ("__jump", shard, grown) if c and c in df.columns]
    if extra:
        raise ValueError(f"columns {extra} are there already; name other ones")
    out = df.withColumn("__jump", jump_state(F.coalesce(F.col(key).cast("long"), _long(0)), shards))
    out = out.withColumn(shard, F.col("__jump.b").cast("int"))
    if grown:
        out = out.withColumn(grown, F.when(F.col("__jump.j") == _long(shards), F.lit(shards)).otherwise(F.col(shard)).cast("int"))
    return out.drop("__jump")


def with_slots(df: DataFrame, shard: str, key: str, rows: int, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard without gaps from 0, in the order of the key.

    Rows are dealt to chunks by ranges of the key, numbered inside (shard, chunk), and shifted by the sizes of the chunks
    before, so a shard is never in one task. ``rows``: about how many rows there are, for the number of chunks. Rows that
    repeat a key follow one another in any order.
    """
    ranged = df.repartitionByRange(max(1, rows // CHUNK_ROWS), key)
    keyed = stored(ranged.withColumn("__chunk", F.spark_partition_id()))
    sizes = keyed.groupBy(shard, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "__chunk", F.coalesce(F.sum("__n").over(before), _long(0)).alias("__start"))
    numbered = keyed.withColumn("__row", F.row_number().over(Window.partitionBy(shard, "__chunk").orderBy(key)))
    out = numbered.join(starts, [shard, "__chunk"])
    return out.withColumn(slot, (F.col("__start") + F.col("__row") - F.lit(1)).cast("long")).select(*df.columns, slot)


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size in bytes plus 1, CRC32 of the text, shard, slot in the shard, shard with one more.

    A null text has no bytes (size 1, CRC32 of nothing). A null key counts as 0. Rows that repeat a key share its shard and
    get slots of their own. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    bytes_of = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    narrow = docs.select(
        F.col(key), (F.length(bytes_of) + F.lit(1)).cast("long").alias("size"), F.crc32(bytes_of).alias("text_crc32"), F.lit("key").alias("law"))
    placed = with_shard(narrow, key, shards, grown="grown_shard")
    return with_slots(placed, "shard", key, docs.count())
