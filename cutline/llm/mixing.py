"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are reduced to cells (source, language, topic) with their token counts. Token weights of the cells are raked to
the target shares of each marginal in turn, never above what a cell holds, and a document is kept with the probability
weight / tokens of its cell, decided by a hash of its key. Only built-in expressions are used; the cells are far fewer than
the documents, and each raking step is an aggregation with map-side combine and a join on the marginal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import by_keys, stored, uniform

NONE = "(none)"
MARGINALS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A coarse topic by the form of a text: table, figures, long or short prose. A stand-in where no topic is given."""
    body = F.coalesce(text, F.lit(""))
    size = F.length(body)
    rows = size - F.length(F.replace(body, F.lit("|"), F.lit("")))
    figures = size - F.length(F.translate(body, "0123456789", ""))
    return (F.when(size == 0, F.lit("empty")).when(rows * 50 > size, F.lit("table")).when(figures * 10 > size, F.lit("figures"))
            .when(size >= 2000, F.lit("long prose")).otherwise(F.lit("short prose")))


def tokens_of(text: Column) -> Column:
    """Words of a text, at least one, so that no document is without weight."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")), F.lit(1)).cast("long")


def flattened_targets(cells: DataFrame, marginal: str, power: float) -> DataFrame:
    """Target shares of one marginal: the present shares to ``power``, scaled to sum to one. Columns: marginal, share."""
    sums = stored(cells.groupBy(marginal).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raw")))
    total = sums.agg(F.sum("raw").alias("all")).first()["all"]
    return sums.select(marginal, (F.col("raw") / F.lit(total or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rate: float, rounds: int = 8) -> DataFrame:
    """Cells with ``weight``: raked to the target shares of ``rate`` times all tokens, at most the tokens of the cell.

    ``cells`` has the marginals and ``tokens``; a target frame has the marginal and ``share``. A category without a target
    gets weight 0. Each step is cut off by a stored table, so plans stay small.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("t")).first()["t"]
    budget = (total or 0.0) * rate
    now = cells.withColumn("weight", F.col("tokens").cast("double") * F.lit(rate))
    for _ in range(rounds):
        for marginal, shares in targets.items():
            sums = now.groupBy(marginal).agg(F.sum("weight").alias("__sum"))
            factors = sums.join(shares, marginal, "left").select(
                marginal, F.when(F.col("__sum") > 0, F.coalesce("share", F.lit(0.0)) * F.lit(budget) / F.col("__sum")).otherwise(F.lit(0.0)).alias("__factor"))
            raked = now.join(factors, marginal)
            now = stored(raked.withColumn("weight", F.least(F.col("tokens").cast("double"), F.col("weight") * F.col("__factor"))).select(*now.columns))
    return now


def _described(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(
        F.col(key), F.coalesce("source", F.lit(NONE)).alias("source"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
        topic_of(F.col("text")).alias("topic"), tokens_of(F.col("text")).alias("tokens"))


def _probabilities(narrow: DataFrame, power: float, rate: float, rounds: int) -> DataFrame:
    """Stored (source, lang, topic, probability), rounded to nine digits, so that sums in another order change no verdict."""
    cells = stored(narrow.groupBy(*MARGINALS).agg(F.sum("tokens").alias("tokens")))
    targets = {m: stored(flattened_targets(cells, m, power)) for m in MARGINALS}
    return stored(rake(cells, targets, rate, rounds).select(*MARGINALS, F.round(F.col("weight") / F.col("tokens"), 9).alias("probability")))


def mix(docs: DataFrame, key: str = "doc_id", power: float = 0.7, rate: float = 0.6, rounds: int = 8, seed: int = 6) -> DataFrame:
    """One row per document: key, source, lang, topic, tokens, probability, draw, kept.

    ``docs`` needs key, text, source, lang; an empty table gives no rows. Null sources and languages are the category
    ``(none)``; an empty or null text has the topic ``empty`` and weighs one token. The draw depends on the key alone, so
    rows that repeat a key and a cell fare alike.
    """
    narrow = stored(_described(docs, key))
    out = by_keys(narrow, _probabilities(narrow, power, rate, rounds), list(MARGINALS), "inner").withColumn("draw", uniform(F.col(key), seed))
    return out.withColumn("kept", F.col("draw") < F.col("probability")).select(key, *MARGINALS, "tokens", "probability", "draw", "kept")


def sample(docs: DataFrame, key: str = "doc_id", power: float = 0.7, rate: float = 0.6, rounds: int = 8, seed: int = 6) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with their columns. A row meets its cell's probability where it lies."""
    probabilities = _probabilities(_described(docs, key), power, rate, rounds).select(*[F.col(m).alias(f"__{m}") for m in MARGINALS], "probability")
    own = {"source": F.coalesce("source", F.lit(NONE)), "lang": F.coalesce("lang", F.lit(NONE)), "topic": topic_of(F.col("text"))}
    rows = docs.select(F.struct(*docs.columns).alias("__row"), *[own[m].alias(f"__{m}") for m in MARGINALS], uniform(F.col(key), seed).alias("__draw"))
    met = by_keys(rows, probabilities, [f"__{m}" for m in MARGINALS], "inner").where(F.col("__draw") < F.col("probability"))
    return met.select("__row.*")
