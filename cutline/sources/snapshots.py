"""Fingerprints of what a stage was made from, and keyed snapshots that take in changed rows only."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.operators.entities import keep_last_by_key
from cutline.sources.sinks import path_exists, write_parquet


def _plan_text(df: DataFrame) -> str:
    """The analysed plan with numbered columns made equal, so that it reads the same in every session."""
    key = "spark.sql.debug.maxToStringFields"
    before = df.sparkSession.conf.get(key)
    df.sparkSession.conf.set(key, "100000")
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        df.sparkSession.conf.set(key, before)


def _content(df: DataFrame) -> list:
    """Number and checksum of the files below a frame (name, length, time of change); of its rows if it reads no files."""
    folders = sorted({unquote(f.rsplit("/", 1)[0]) for f in df.inputFiles()})
    if folders:
        files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        hashes = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    else:
        hashes = df.select(F.xxhash64(F.to_json(F.struct("*"))).alias("h"))
    return [str(x) for x in hashes.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)"))).first()]


def fingerprint(settings, tables: Mapping[str, DataFrame]) -> str:
    """One name for a configuration and the tables it is applied to: plans, schemas and input files.

    All files of a table's folders count, so a stage may be made again without need, but is never taken over from
    other rows. Tables that read no files (of a database, or made in the session) are read for it.
    """
    facts = [json.dumps(settings, sort_keys=True, default=str)]
    for name in sorted(tables):
        df = tables[name]
        facts.append(json.dumps([name, df.schema.jsonValue(), _plan_text(df), _content(df)], sort_keys=True, default=str))
    return hashlib.sha256("\n".join(facts).encode()).hexdigest()


def latest_version(spark, folder: str) -> int:
    """Number of the newest complete version of a snapshot; 0 if there is none."""
    n = 0
    while path_exists(spark, f"{folder}/{n + 1}/mark/_SUCCESS"):
        n += 1
    return n


def refresh_snapshot(source: DataFrame, folder: str, key: Sequence[str] | str, time: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the last by (time, order), kept as versions below ``folder``.

    A run reads the rows of ``source`` from the high-water mark on (the largest time of the version before; the comparison
    is pushed to the source), merges them with the snapshot rows of their keys and writes the next version beside. Its mark
    is written last, so a run that failed leaves the version before in force and is simply repeated. Rows of the mark itself
    are read again and change nothing. A NULL time is only seen by the first run; NULL is a key like others.
    """
    spark, keys = source.sparkSession, [key] if isinstance(key, str) else list(key)
    n = latest_version(spark, folder)
    rows, changes = None, source
    if n:
        rows = spark.read.schema(source.schema).parquet(f"{folder}/{n}/rows")
        mark = spark.read.parquet(f"{folder}/{n}/mark").first()[0]
        changes = source if mark is None else source.where(F.col(time) >= F.lit(mark).cast(source.schema[time].dataType))
        if changes.isEmpty():
            return rows
    latest = [time, *order]
    if rows is None:
        merged = keep_last_by_key(changes, keys, latest)
    else:
        touched = changes.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        again = rows.join(touched, same, "left_semi").unionByName(changes)
        merged = rows.join(touched, same, "left_anti").unionByName(keep_last_by_key(again, keys, latest))
    write_parquet(merged, f"{folder}/{n + 1}/rows")
    out = spark.read.schema(source.schema).parquet(f"{folder}/{n + 1}/rows")
    write_parquet(out.agg(F.max(time).alias("mark")), f"{folder}/{n + 1}/mark")
    return out
