"""Evaluation tables of scored rows: ranking quality, gain, profit reports, regression errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutline.operators.ranking import exact_quantiles, quantile_rows, running_totals
from cutline.session import checkpointed

DECILES = [i / 10 for i in range(1, 11)]


def _rows(fields: Sequence[dict[str, Column]]) -> Column:
    """Several result rows from the columns of one row."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in f.items()]) for f in fields]))


def _share(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def score_steps(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from the highest: rows of each class and running counts; of each group if ``by`` names one."""
    positive = (F.col(label) == 1).cast("bigint")
    steps = scored.where(F.col(label).isNotNull()).groupBy(*by, score).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    return running_totals(steps, score, {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True, group=by)


def auc(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with averaged ties, of each group if ``by`` names one; NULL if a class is absent."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return score_steps(scored, label, score, by).groupBy(*by).agg(
        _share(area, F.max("tp_total").cast("double") * F.max("fp_total")).alias("auc"))


def roc_points(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score: rates of rows at or above it."""
    return score_steps(scored, label, score).select(
        F.col(score).alias("threshold"), _share(F.col("fp"), F.col("fp_total")).alias("fpr"),
        _share(F.col("tp"), F.col("tp_total")).alias("tpr"))


def confusion_matrix(scored: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    predicted = (F.col(score) > cut).cast("int").alias("predicted")
    return scored.groupBy(F.col(label).cast("int").alias("actual"), predicted).agg(F.count(F.lit(1)).alias("n"))


def _ties(tie: str | Sequence[str]) -> list[str]:
    return [tie] if isinstance(tie, str) else list(tie)


def cumulative_gain(scored: DataFrame, label: str, score: str, tie: str | Sequence[str]) -> DataFrame:
    """(class, percentage, gain): share of the class found in the best share of rows, from (0, 0).

    Score and ties together order the rows; name all columns that tell rows apart.
    """
    parts = []
    for value in (0, 1):
        hit = (F.col(label) == value).cast("bigint")
        ranked = running_totals(scored.select(label, score, *_ties(tie)), score,
                                {"seen": F.lit(1).cast("bigint"), "found": hit}, tie, descending=value == 1)
        curve = ranked.select(F.lit(value).alias("class"), (F.col("seen") / F.col("seen_total")).alias("percentage"),
                              _share(F.col("found"), F.col("found_total")).alias("gain"))
        start = scored.sparkSession.range(1).select(
            F.lit(value).alias("class"), F.lit(0.0).alias("percentage"), F.lit(0.0).alias("gain"))
        parts += [start, curve]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def profit_report_classifier(scored: DataFrame, label: str, score: str, pretty: bool = False) -> DataFrame:
    """Per decile: rows strictly above the score percentile, their classes, precision, recall, lift.

    The ten thresholds come to the driver as numbers, then one pass counts.
    """
    names = {f"q{i}": (10 - i) / 10 for i in range(1, 11)}
    cuts = exact_quantiles(scored, score, names).first()
    positive = F.col(label) == 1
    picks = [F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("n_pos")]
    for q in names:
        above = F.lit(False) if cuts is None or cuts[q] is None else F.col(score) > F.lit(float(cuts[q]))
        picks += [F.count_if(above).alias(f"{q}_all"), F.count_if(above & positive).alias(f"{q}_pos")]
    counts = scored.agg(*picks)
    rows = []
    for i, q in enumerate(names, start=1):
        chosen, hits = F.col(f"{q}_all"), F.col(f"{q}_pos")
        precision = _share(hits, chosen)
        rows.append({
            "decile": F.lit(i / 10), "cul_total": chosen, "cul_positive": hits, "cul_negative": chosen - hits,
            "precision": precision, "recall": _share(hits, F.col("n_pos")),
            "lift": precision / _share(F.col("n_pos"), F.col("n")),
        })
    out = counts.select(_rows(rows))
    return percent_text(out, ["precision", "recall", "lift"]) if pretty else out


def percent_text(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.format_string(f"%.{digits}f%%", F.col(c) * 100) for c in columns})


def _running_truth(scored: DataFrame, truth: str, prediction: str, tie: str | Sequence[str]) -> tuple[DataFrame, float]:
    """Running sum of the truth from the highest prediction down, fixed on disk, and its total."""
    sums = running_totals(scored.select(truth, prediction, *_ties(tie)), prediction,
                          {"gain": F.col(truth).cast("double")}, tie, descending=True)
    # float sums may differ between evaluations, and the quantiles read these rows more than once
    fixed = checkpointed(sums.select("gain"))
    total = scored.where(F.col(prediction).isNotNull()).agg(F.sum(truth)).first()[0]
    return fixed, total


def profit_report_regression(scored: DataFrame, truth: str, prediction: str, tie: str | Sequence[str]) -> DataFrame:
    """At ten "higher" quantiles of the running truth: sum, rows, mean, recall, lift."""
    gains, total = _running_truth(scored, truth, prediction, tie)
    names = {f"q{i}": p for i, p in enumerate(DECILES, start=1)}
    found = exact_quantiles(gains, "gain", names, method="higher")
    whole = F.lit(total).cast("double")
    return found.select(_rows([{
        "decile": F.lit(p), "cul_sum": F.col(q), "cul_num": F.col(f"{q}_upto"),
        "cul_avg": F.col(q) / F.col(f"{q}_upto"), "recall": _share(F.col(q), whole),
        "lift": _share(F.col(q), whole) / p,
    } for q, p in names.items()]))


def gain_regression(scored: DataFrame, truth: str, prediction: str, tie: str | Sequence[str]) -> DataFrame:
    """Eleven percentiles of the share of rows and of the share of the truth found, both from 0."""
    gains, total = _running_truth(scored, truth, prediction, tie)
    curve = gains.unionByName(scored.sparkSession.range(1).select(F.lit(0.0).alias("gain")))
    names = {f"q{i}": i / 10 for i in range(11)}
    found = exact_quantiles(curve, "gain", names)
    whole = F.lit(total).cast("double")
    return found.select(_rows([
        {"percentages": F.lit(p), "gains": _share(F.col(q), whole)} for q, p in names.items()]))


def regression_metrics(scored: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """R², mean absolute and mean squared error in one pass, of each group if ``by`` names one."""
    both = scored.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(truth) - F.col(prediction)
    spread = F.nullif(F.var_pop(truth) * F.count(F.lit(1)), F.lit(0.0))
    return both.groupBy(*by).agg((1 - F.sum(error * error) / spread).alias("r2"),
                    F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"))


def prediction_pairs(scored: DataFrame, truth: str, prediction: str) -> DataFrame:
    return scored.select(F.col(truth).alias("true"), F.col(prediction).alias("pred"))


def _within(scored: DataFrame, error: Column, bounds: Sequence[float], name: str) -> DataFrame:
    shares = scored.agg(*[
        F.avg(F.coalesce(error <= F.lit(float(b)), F.lit(False)).cast("int")).alias(f"b{i}") for i, b in enumerate(bounds)])
    return shares.select(_rows([
        {name: F.lit(float(b)), "precision": F.col(f"b{i}")} for i, b in enumerate(bounds)]))


def absolute_error_share(scored: DataFrame, truth: str, prediction: str, errors: Sequence[float] = (1000,)) -> DataFrame:
    """Share of rows whose absolute error is at most e, for each e."""
    return _within(scored, F.abs(F.col(truth) - F.col(prediction)), errors, "error")


def relative_error_share(scored: DataFrame, truth: str, prediction: str, rates: Sequence[float] | None = None) -> DataFrame:
    """Share of rows whose error divided by the truth is at most e; a zero truth never counts."""
    rates = [round(i * 0.1, 1) for i in range(21)] if rates is None else rates
    rate = F.try_divide(F.abs(F.col(truth) - F.col(prediction)).cast("double"), F.col(truth).cast("double"))
    return _within(scored, rate, rates, "error_rate")


def error_cdf(errors: DataFrame, error: str) -> DataFrame:
    """All 101 percentiles of an error column."""
    found = quantile_rows(errors, error, [i / 100 for i in range(101)])
    return found.select(F.col("position").cast("double").alias("percentile"), F.col("quantile").alias("error"))


def evaluation_summary(scored: DataFrame, split: str | Sequence[str], label: str, score: str, kind: str) -> DataFrame:
    """(split, metric, value) rows: AUC for a classifier, R², MAE and MSE for a regression.

    All values of ``split`` are evaluated together, however many there are; several columns stay columns
    of the result under their names. A split without rows that count has no rows here.
    """
    by = [split] if isinstance(split, str) else list(split)
    table = auc(scored, label, score, by) if kind == "classifier" else regression_metrics(scored, label, score, by)
    names = [c for c in table.columns if c not in by]
    keep = [F.col(by[0]).alias("split")] if isinstance(split, str) else [F.col(c) for c in by]
    return table.select(*keep, _rows([{"metric": F.lit(m), "value": F.col(m)} for m in names]))
