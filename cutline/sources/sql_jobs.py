"""Jobs made of SQL text: statements, files, directories of templates, unions over brands, table copies."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cutline.sources.readers import Database, read_jdbc
from cutline.sources.sinks import write_jdbc

NAME = re.compile(r"^\w+$")


def statements(text: str) -> list[str]:
    """Statements of a script; a semicolon ends one at the end of a line."""
    return [s.strip() for s in re.split(r";[ \t]*(?:\n|$)", text) if s.strip()]


def filled(template: str, names: Mapping[str, str]) -> str:
    """Put plain names (letters, digits, underscore) in the ``{marker}`` places of a template."""
    for value in names.values():
        if not NAME.match(value):
            raise ValueError(f"not a plain name: {value!r}")
    return template.format(**names)


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None) -> DataFrame | None:
    """Run a script; values come as named parameters (``:name``). Returns the last result."""
    result = None
    for statement in statements(text):
        result = spark.sql(statement, args=dict(args)) if args else spark.sql(statement)
    return result


def run_sql_file(spark: SparkSession, path: str, names: Mapping[str, str] | None = None,
                 args: Mapping | None = None) -> DataFrame | None:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return run_sql(spark, filled(text, names) if names else text, args)


def run_sql_directory(spark: SparkSession, base: str, sub: str, names: Mapping[str, str] | None = None,
                      args: Mapping | None = None) -> list[str]:
    """Run all files of ``base/sub`` in name order; ``base/standard`` stands in for an absent folder."""
    folder = os.path.join(base, sub)
    if not os.path.isdir(folder):
        folder = os.path.join(base, "standard")
    ran = sorted(os.listdir(folder))
    for name in ran:
        run_sql_file(spark, os.path.join(folder, name), names, args)
    return ran


def union_over(spark: SparkSession, template: str, brands: Sequence[str], marker: str = "brand_nick") -> DataFrame:
    """The template's query for every brand, in one plan."""
    return reduce(DataFrame.unionByName, [spark.sql(filled(template, {marker: b})) for b in brands])


def create_then_insert(spark: SparkSession, table: str, template: str, brands: Sequence[str],
                       marker: str = "brand_nick") -> None:
    """Replace a table with the union of the template's query over all brands."""
    union_over(spark, template, brands, marker).write.mode("overwrite").saveAsTable(table)


def copy_table(spark: SparkSession, source: Database, table: str, target: Database, to: str | None = None,
               partition: tuple[str, object, object, int] | None = None, insert_type: str = "into") -> None:
    write_jdbc(read_jdbc(spark, source, table, partition=partition), target, to or table, insert_type)
