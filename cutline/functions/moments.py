"""Central moments as small structs that merge by plain sums without losing precision.

A struct holds the sums of the powers of (x - r) for some reference r near the values. One time
bucket uses its own mean as r. Before buckets are merged, all structs of a key move to one
common r (``aligned``); then merging is a sum per field, which Spark combines like any other sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sums(c: Column, fields: str) -> Column:
    return F.struct(*[F.sum(c[f]).alias(f) for f in fields.split()])


def moments(x: Column) -> Column:
    """Aggregate: count, mean as the reference, and power sums about it."""
    x = x.cast("double")
    n = F.count(x).cast("double")
    third = F.coalesce(F.nanvl(F.skewness(x), F.lit(0.0)), F.lit(0.0)) * F.pow(F.var_pop(x), 1.5) * n
    return F.struct(n.alias("n"), F.avg(x).alias("r"), F.lit(0.0).alias("s1"),
                    (F.var_pop(x) * n).alias("s2"), third.alias("s3"))


def comoments(y: Column, x: Column) -> Column:
    """Aggregate over rows with both values: what a regression of y on x needs."""
    zero = F.lit(0.0)
    return F.struct(
        F.regr_count(y, x).cast("double").alias("n"), F.regr_avgx(y, x).alias("rx"), F.regr_avgy(y, x).alias("ry"),
        zero.alias("sx"), zero.alias("sy"), F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"))


def aligned(df: DataFrame, key: str, moment_columns: list[str], comoment_columns: list[str]) -> DataFrame:
    """Move the structs of each key to one reference; rows must be partitioned by the key."""
    if not moment_columns and not comoment_columns:
        return df
    of_key = Window.partitionBy(key)
    refs = [F.min(F.col(c)["r"]).over(of_key).alias(f"__{c}_r") for c in moment_columns]
    refs += [F.min(F.col(c)[r]).over(of_key).alias(f"__{c}_{r}") for c in comoment_columns for r in ("rx", "ry")]
    df = df.select("*", *refs)
    moved = {}
    for c in moment_columns:
        moved[c] = F.expr(f"""named_struct(
            'n', {c}.n, 's1', {c}.n * ({c}.r - __{c}_r), 's2', {c}.s2 + {c}.n * pow({c}.r - __{c}_r, 2),
            's3', {c}.s3 + 3 * ({c}.r - __{c}_r) * {c}.s2 + {c}.n * pow({c}.r - __{c}_r, 3))""")
    for c in comoment_columns:
        dx, dy = f"({c}.rx - __{c}_rx)", f"({c}.ry - __{c}_ry)"
        moved[c] = F.expr(f"""named_struct(
            'n', {c}.n, 'sx', {c}.n * {dx}, 'sy', {c}.n * {dy},
            'sxx', {c}.sxx + {c}.n * {dx} * {dx}, 'sxy', {c}.sxy + {c}.n * {dx} * {dy})""")
    return df.withColumns(moved)


def merged_moments(c: Column) -> Column:
    return _sums(c, "n s1 s2 s3")


def merged_comoments(c: Column) -> Column:
    return _sums(c, "n sx sy sxx sxy")


def _m2(m: Column) -> Column:
    return F.greatest(m["s2"] - m["s1"] * m["s1"] / m["n"], F.lit(0.0))


def variance(m: Column) -> Column:
    """Sample variance, NULL below two values."""
    return F.when(m["n"] >= 2, _m2(m) / (m["n"] - 1))


def adjusted_skew(m: Column) -> Column:
    """Bias-corrected skewness, NULL below three values, 0 without spread."""
    n, m2 = m["n"], _m2(m)
    m3 = m["s3"] - m["s1"] * m["s2"] * 3 / n + m["s1"] * m["s1"] * m["s1"] * 2 / (n * n)
    plain = m3 / n / F.pow(m2 / n, 1.5)
    return F.when(n >= 3, F.when(m2 > 0, plain * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(0.0))


def slope(m: Column) -> Column:
    """Least squares slope, NULL below two values or without spread in x."""
    sxx = m["sxx"] - m["sx"] * m["sx"] / m["n"]
    sxy = m["sxy"] - m["sx"] * m["sy"] / m["n"]
    # a sum of squares below rounding noise means all x are equal
    return F.when((m["n"] >= 2) & (sxx > m["sxx"] * 1e-12), sxy / sxx)
