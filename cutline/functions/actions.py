"""Row predicates built from (column, operator, value) triples and exclusion lists."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = {
    "==": operator.eq, "=": operator.eq, "!=": operator.ne, "<>": operator.ne,
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}


def action_predicate(
    columns: Sequence[str], actions: Sequence[dict] | None, ignore_missing: bool = False
) -> Column:
    """AND of all actions; a comparison with NULL counts as false."""
    terms = []
    for action in actions or ():
        name, op = action["column"], action["operator"]
        if op not in COMPARISONS:
            raise ValueError(f"unknown operator: {op!r}")
        if name not in columns:
            if ignore_missing:
                continue
            raise ValueError(f"unknown column: {name!r}")
        terms.append(F.coalesce(COMPARISONS[op](F.col(name), F.lit(action["value"])), F.lit(False)))
    return reduce(operator.and_, terms) if terms else F.lit(True)


def filter_actions(df: DataFrame, actions: Sequence[dict] | None, ignore_missing=False) -> DataFrame:
    return df.where(action_predicate(df.columns, actions, ignore_missing))


def exclude_values(df: DataFrame, filters: Sequence[dict] | None) -> DataFrame:
    """Drop rows whose column holds a listed value; rows with NULL stay."""
    for rule in filters or ():
        c = F.col(rule["column"])
        df = df.where(c.isNull() | ~c.isin(list(rule["values"])))
    return df
