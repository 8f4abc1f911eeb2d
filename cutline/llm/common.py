"""Small helpers shared by the operators: tables, shared folders, streams of whole groups."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_KEYS = 500_000
BATCH_BYTES = 1 << 20  # of an Arrow batch where whole texts or files go to Python; a longer row is a batch of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only in local mode without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cutline-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage and fixes the rows.

    ``batch_rows``: rows of an Arrow batch while this is written, for narrow rows.
    """
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if batch_rows:
        spark.conf.set(key, str(batch_rows))
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], buckets: int, move: bool = True) -> DataFrame:
    """``stored``, dealt to ``buckets`` by ``keys``, so that several joins by them move only their other side.

    ``move=False``: every task writes its rows to the buckets itself, for few large rows.
    The table is known to the catalog just long enough to be opened; its files are external and stay.
    """
    spark, name = df.sparkSession, f"cutline_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys) if move else df).write.bucketBy(buckets, *keys).option("path", shared_folder(spark)).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


_heavy: dict = {}


def heavy(key, build: Callable):
    """A large object that tasks of one process share. A process holds one at a time, so that the stages of a pipeline,
    which reuse Python workers, don't pile them up."""
    if key not in _heavy:
        _heavy.clear()
        _heavy[key] = build()
    return _heavy[key]


def _drop_heavy() -> None:
    """For tasks, whose own functions come with copies of the variables of this module, while this one sees the process's."""
    if _heavy:
        _heavy.clear()
        _give_back()


def few(keys: DataFrame) -> bool:
    """Is a stored table of keys (tens of bytes a row) small enough to be sent to every task?"""
    return keys.count() <= BROADCAST_KEYS


def by_keys(df: DataFrame, keys: DataFrame, on, how: str) -> DataFrame:
    """Semi, anti or left join with a stored table of keys: broadcast while it is ``few``, else by shuffle. Texts stay put
    in the first case; the rows are the same in both."""
    return df.join(F.broadcast(keys) if few(keys) else keys, on, how)


def _importable(spark: SparkSession) -> None:
    """Let Python workers that Spark starts on this machine import the package even if the driver only has it on sys.path."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def text_batches(df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, since a text may be long.

    Tasks that don't use a ``heavy`` object (``keeps``) first drop the one that an earlier stage left in their process.
    Spark reads the bound when a plan runs, after this call, so the session keeps it from here on; it changes no result.
    """
    _importable(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _drop_heavy()
        yield from func(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Free memory goes back to the system: workers live on between tasks, beside the JVM of their executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Regroup batches that are sorted by ``key`` so that no group is cut by a batch end."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        if held and batch[key].iloc[0] == last and held[-1][key].iloc[-1] == last:
            held.append(batch)
            continue
        cut = int((batch[key].to_numpy() != last).sum())
        held.append(batch.iloc[:cut])
        full = pd.concat(held, ignore_index=True)
        if len(full):
            yield full
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def by_group(df: DataFrame, key: str, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str, partitions: int | None = None) -> DataFrame:
    """Apply ``func`` to frames that hold whole groups of ``key``, many small groups at a time.

    Rows move once by ``key`` and are sorted inside the partitions; a call gets the groups that ended in an Arrow batch.
    The caller bounds the size of a group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, key):
            out = func(frame)
            if len(out):
                yield out

    _importable(df.sparkSession)
    moved = df.repartition(partitions, key) if partitions else df.repartition(key)
    return moved.sortWithinPartitions(key).mapInPandas(run, schema)


def uniform(column, seed: int = 0):
    """Pseudo-random number in [0, 1) fixed by the value of ``column``: the first 13 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
