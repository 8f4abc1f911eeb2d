"""Type standardisation, clean-up and the data-dictionary driven rename of loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.operators.entities import keep_last_by_key
from cutline.operators.ranking import SLOT, TIE_SLOT, Slots

MIN_DATE = "timestamp_ntz'1900-01-01 00:00:00'"

# fixed values: analysis type of a column -> data type
DATA_TYPES = {
    "datetime": "datetime", "numeric": "float", "categorical": "varchar",
    "boolean": "bool", "text": "varchar", "latlong": "varchar", "int": "int",
}
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _coerced(df: DataFrame, name: str, data_type: str) -> Column:
    c, have = F.col(name), df.schema[name].dataType
    if data_type == "datetime":
        # a time without zone stays as written; text that is no time becomes NULL
        return c.cast("timestamp_ntz") if isinstance(have, TEMPORAL) else c.cast("string").try_cast("timestamp_ntz")
    if data_type == "float":
        return c.cast("double") if isinstance(have, T.NumericType) else c.cast("string").try_cast("double")
    if data_type == "int":
        return c.try_cast("bigint") if isinstance(have, T.NumericType) else c.cast("string").try_cast("bigint")
    if data_type == "bool":
        return c if isinstance(have, T.BooleanType) else c.cast("string").try_cast("boolean")
    if data_type == "small":
        number = c.cast("int") if isinstance(have, T.BooleanType) else c.cast("string").try_cast("double")
        return number.try_cast("tinyint")
    if data_type == "varchar":
        return c.cast("string")
    raise ValueError(f"unknown data type: {data_type!r}")


def standardize_types(df: DataFrame, fields: Sequence[Mapping]) -> DataFrame:
    """Coerce columns by their ``variable_type``; absent columns are skipped, bad values become NULL.

    Timestamps up to 1900-01-01 00:00:00 become NULL in every datetime column.
    """
    wanted = {}
    for field in fields:
        kind = field["variable_type"]
        if kind not in DATA_TYPES:
            raise ValueError(f"unknown variable type: {kind!r}")
        wanted[field["name"]] = DATA_TYPES[kind]
    typed = df.select(*[
        _coerced(df, c, wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])
    return null_minimum_dates(typed)


def null_minimum_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    chosen = times if columns is None else [c for c in columns if c in times]
    return df.select(*[
        F.when(F.col(c) > F.expr(MIN_DATE), F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


def replace_commas(df: DataFrame, by: str = "#") -> DataFrame:
    """Replace commas in all text columns, for comma-separated debug copies."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.replace(F.col(c), F.lit(","), F.lit(by)) for c in text})


def cast_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Give two key columns one type; equal native types are kept, others become text."""
    if left.schema[left_key].dataType == right.schema[right_key].dataType:
        return left, right
    return (left.withColumn(left_key, F.col(left_key).cast("string")),
            right.withColumn(right_key, F.col(right_key).cast("string")))


def forward_fill(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the latest non-null value before, in the order of a unique column.

    Ranges of the order column are filled on their own; what enters a range comes from one
    small row per range.
    """
    rows = Slots.of(df, order).assign(df).drop(TIE_SLOT)
    last = rows.groupBy(SLOT).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v")))).alias(f"__last_{c}")
        for c in columns])
    earlier = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    entering = last.select(SLOT, *[
        F.last(f"__last_{c}", ignorenulls=True).over(earlier)["v"].alias(f"__in_{c}") for c in columns])
    inside = Window.partitionBy(SLOT).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.join(F.broadcast(entering), SLOT)
    return filled.select(*[
        F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__in_{c}")).alias(c) if c in columns else F.col(c)
        for c in df.columns])


def apply_dictionary(
    df: DataFrame,
    dictionary: Sequence[Mapping],
    order: str | None = None,
    constants: Mapping | None = None,
    order_id: tuple[str, str] | None = None,
    reorder: bool = True,
) -> DataFrame:
    """Shape a table by a data dictionary.

    Each entry has ``source`` and ``target`` and may have ``default``, ``type`` (date, float, int,
    varchar, bool), ``is_key`` and ``is_merge``. Entries without target are ignored; missing
    source columns appear with their default or NULL; merged cells are filled forward in the
    ``order`` column's order; duplicate rows go; rows with a NULL key go; one row per key stays,
    the last in ``order``. ``order_id`` names two columns whose text makes an ``order_id``.
    """
    entries = [e for e in dictionary if e.get("target")]
    have = set(df.columns)
    missing = {e["source"]: e.get("default") for e in entries if e["source"] not in have}
    df = df.withColumns({c: F.lit(v) for c, v in missing.items()}) if missing else df
    position = F.col(order) if order else F.lit(0)
    df = df.withColumn("__order", position).withColumnsRenamed({e["source"]: e["target"] for e in entries})
    targets = [e["target"] for e in entries]
    df = df.select(*(targets if reorder else [c for c in df.columns if c != "__order"]), "__order")
    merged = [e["target"] for e in entries if e.get("is_merge")]
    if merged:
        if not order:
            raise ValueError("filling merged cells needs an order column")
        df = forward_fill(df, "__order", merged)
    columns = [c for c in df.columns if c != "__order"]
    df = df.groupBy(*columns).agg(F.max("__order").alias("__order"))
    df = df.withColumns({c: F.lit(v) for c, v in (constants or {}).items()}) if constants else df
    if order_id and set(order_id) <= set(df.columns):
        df = df.withColumn("order_id", F.concat(*[
            F.col(order_id[0]).cast("string"), F.lit("_"), F.col(order_id[1]).cast("string")]))
    keys = [e["target"] for e in entries if e.get("is_key")]
    # with nearly all columns marked, the marks do not describe a key
    if keys and len(keys) < len(entries) - 3:
        not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        df = keep_last_by_key(df.where(not_null), keys, ["__order"])
    kinds = {"date": "datetime", "float": "float", "int": "int", "varchar": "varchar", "bool": "small"}
    typed = {e["target"]: kinds[e["type"]] for e in entries if e.get("type")}
    out = [c for c in df.columns if c != "__order"]
    return df.select(*[_coerced(df, c, typed[c]).alias(c) if c in typed else F.col(c) for c in out])


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the object, int, float, datetime or bool columns."""
    kinds = {
        "object": (T.StringType,), "int": (T.IntegralType,),
        "float": (T.FloatType, T.DoubleType, T.DecimalType), "datetime": TEMPORAL, "bool": (T.BooleanType,),
    }
    if kind not in kinds:
        raise ValueError(f"unknown kind of column: {kind!r}")
    return [f.name for f in df.schema if isinstance(f.dataType, kinds[kind])]
