"""Exact duplicates by progressive refinement: length, then a hash of the first bytes, then a hash of the whole text.

Each step looks only at what the step before left in groups of two and more, so whole texts are hashed for documents that
agree in length and beginning only. What moves is lengths and hashes; texts move only where the surviving groups are too
many to broadcast. Every aggregation combines before its shuffle, so a group of copies with a third of all rows arrives as
one row from each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import by_keys, stored

PREFIX = 64  # characters of the second step
BROADCAST_GROUPS = 200_000  # surviving groups (16 bytes each) sent to every task; more are joined by shuffle


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _near(df: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose group survives; ``groups`` is a stored table, so counting it is cheap."""
    few = groups.count() <= BROADCAST_GROUPS
    return df.join(F.broadcast(groups) if few else groups, on, "left_semi")


def copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text that occurs more than once: its SHA-256, the largest key, the number of rows."""
    return _refined(docs, key, text)[0]


def _refined(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``copy_groups``, and the stored (length, prefix) groups whose texts were hashed whole."""
    base = docs.select(F.col(key).alias("__id"), _text(text).alias("__text")).withColumn("__length", F.octet_length("__text").cast("long"))
    lengths = stored(base.groupBy("__length").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__length"))
    started = _near(base, lengths, ["__length"]).withColumn("__prefix", F.xxhash64(F.substring("__text", 1, PREFIX)))
    prefixes = stored(started.groupBy("__length", "__prefix").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__length", "__prefix"))
    whole = _near(base.withColumn("__prefix", F.xxhash64(F.substring("__text", 1, PREFIX))), prefixes, ["__length", "__prefix"])
    hashed = whole.select("__id", "__length", F.sha2("__text", 256).alias("text_sha256"))
    groups = hashed.groupBy("__length", "text_sha256").agg(F.max("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.where("group_size > 1").select("text_sha256", "keep_id", "group_size"), prefixes


def _verdicts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with __sha, __keep, __size."""
    groups = stored(copy_groups(docs, key, text)).select(F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep"), F.col("group_size").alias("__size"))
    out = docs.withColumn("__sha", F.sha2(_text(text), 256)).join(groups, "__sha", "left")
    return out.withColumn("__keep", F.coalesce("__keep", F.col(key))).withColumn("__size", F.coalesce("__size", F.lit(1).cast("long")))


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with keep_id, group_size, kept and text_sha256; of equal texts the largest key stays.

    A null text counts as empty. Rows that repeat both key and text are one document: all of them carry the same verdict
    (``drop_copies`` leaves one). A null key never stays against another key. Columns of these four names in ``docs`` are
    replaced. An empty table gives no rows.
    """
    names = ["keep_id", "group_size", "kept", "text_sha256"]
    return _verdicts(docs, key, text).select(
        *[c for c in docs.columns if c not in names], F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        F.col("__keep").eqNullSafe(F.col(key)).alias("kept"), F.col("__sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with the columns of ``docs`` as they are.

    Only texts that share length and beginning with another one are hashed. Rows that go are told by key and hash; texts move
    only where those are too many to broadcast. A row that repeats another one in key and text is the rare case with a
    shuffle of its own.
    """
    found, prefixes = _refined(docs, key, text)
    groups = stored(found.select(F.unhex("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep")))
    begun = docs.withColumn("__length", F.octet_length(_text(text)).cast("long")).withColumn("__prefix", F.xxhash64(F.substring(_text(text), 1, PREFIX)))
    likely = prefixes.withColumn("__likely", F.lit(True))
    told = begun.join(F.broadcast(likely) if prefixes.count() <= BROADCAST_GROUPS else likely, ["__length", "__prefix"], "left")
    hashed = told.withColumn("__sha", F.when(F.col("__likely"), F.unhex(F.sha2(_text(text), 256))))
    members = stored(hashed.select(F.col(key).alias("__id"), "__sha").join(groups, "__sha").withColumn("__stays", F.col("__id").eqNullSafe(F.col("__keep"))))
    same = (F.col("__sha") == F.col("__of")) & F.col(key).eqNullSafe(F.col("__id"))

    def keys(rows: DataFrame) -> DataFrame:
        return stored(rows.select("__id", F.col("__sha").alias("__of")).distinct())

    out = by_keys(hashed, keys(members.where("not __stays")), same, "left_anti")
    repeated = keys(members.where("__stays").groupBy("__id", "__sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if not repeated.isEmpty():
        once = by_keys(out, repeated, same, "left_semi").dropDuplicates(["__sha"])
        out = by_keys(out, repeated, same, "left_anti").unionByName(once)
    return out.select(*docs.columns)
