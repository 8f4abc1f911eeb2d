"""From comments to the word table: what is new, its words, appended in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutline.operators.text import new_comments, word_rows
from cutline.sources.sinks import append_rows, write_batch


def comment_words(comments: DataFrame, processed: DataFrame | None = None, orders: DataFrame | None = None,
                  stop_words: DataFrame | Sequence[str] = (), dictionary: DataFrame | None = None,
                  key: str = "oid", content: str = "content", latest_first: str | None = None, **settings) -> DataFrame:
    """(key, word) rows of the comments that were not handled before; with ``latest_first`` sorted in each partition by that column."""
    fresh = new_comments(comments, processed, orders, key=key, content=content, **settings)
    fresh = fresh.select(key, content, *[c for c in ("created",) if c in fresh.columns])
    # texts are sorted rather than their words, where no join moves the words afterwards
    early = latest_first in fresh.columns and dictionary is None and not isinstance(stop_words, DataFrame)
    words = word_rows(_sorted(fresh, latest_first, key) if early else fresh, content, stop_words, dictionary)
    return _sorted(words, latest_first, key) if latest_first in words.columns and not early else words


def _sorted(rows: DataFrame, created: str, key: str) -> DataFrame:
    return rows.repartitionByRange(F.desc(created), key).sortWithinPartitions(F.desc(created), key)


def comment_job(spark: SparkSession, comments: DataFrame, table: str, created: str = "created", key: str = "oid",
                batch: str | None = None, **settings) -> None:
    """Append the words of new comments to a catalog table, latest comments first inside each file.

    The table is made on the first run; later runs take its keys as handled. With a ``batch`` the table is partitioned by
    it: keys of other batches are handled, and a repeated run replaces its own batch instead of appending to it.
    """
    done = spark.table(table) if spark.catalog.tableExists(table) else None
    if done is not None and batch is not None:
        done = done.where(F.col("batch") != batch)
    words = comment_words(comments, None if done is None else done.select(key).distinct(), key=key, latest_first=created, **settings)
    rows = words.select(key, "word")
    append_rows(rows, table) if batch is None else write_batch(rows, table, batch)
