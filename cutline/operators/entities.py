"""Entities with keys, time index and parents. Metadata lives on the driver, rows stay lazy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Parent:
    """The child's ``column`` holds the key of entity ``name``."""

    name: str
    column: str


@dataclass(frozen=True)
class Entity:
    name: str
    df: DataFrame
    key: str | None = None
    time: str | None = None
    parents: Sequence[Parent] = ()
    tie: Sequence[str] = ()
    categorical: Sequence[str] = ()
    interesting: Mapping[str, Sequence] = field(default_factory=dict)

    @property
    def key_columns(self) -> set[str]:
        return {p.column for p in self.parents} | ({self.key} if self.key else set())

    def tie_columns(self) -> list[str]:
        """Columns that make the row order total: the declared ones, the key, or all others."""
        if self.tie:
            return list(self.tie)
        return [self.key] if self.key else [c for c in self.df.columns if c != self.time]

    def kind(self, column: str) -> str:
        """numeric, discrete, boolean or datetime; ``key`` for key columns."""
        if column in self.key_columns:
            return "key"
        if column in self.categorical:
            return "discrete"
        dtype = self.df.schema[column].dataType
        if isinstance(dtype, T.BooleanType):
            return "boolean"
        if isinstance(dtype, T.NumericType):
            return "numeric"
        if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "datetime"
        return "discrete"


class EntitySet:
    def __init__(self, entities: Sequence[Entity] = ()):
        self.entities: dict[str, Entity] = {}
        for e in entities:
            self.add(e)

    def add(self, entity: Entity) -> "EntitySet":
        self.entities[entity.name] = entity
        return self

    def __getitem__(self, name: str) -> Entity:
        if name not in self.entities:
            raise ValueError(f"unknown entity: {name!r}")
        return self.entities[name]

    def children(self, name: str) -> list[tuple[Entity, str]]:
        return [(e, p.column) for e in self.entities.values() for p in e.parents if p.name == name]

    def key_names(self) -> set[str]:
        return {e.key for e in self.entities.values() if e.key}

    def with_interesting(self, values: Mapping[str, Mapping[str, Sequence]]) -> "EntitySet":
        """Set interesting values per entity and column."""
        return EntitySet([
            replace(e, interesting={**e.interesting, **values.get(e.name, {})}) for e in self.entities.values()])

    def save(self, folder: str) -> None:
        """Write every entity as parquet under ``folder``."""
        for e in self.entities.values():
            e.df.write.mode("overwrite").parquet(f"{folder}/{e.name}")

    def reload(self, spark: SparkSession, folder: str) -> "EntitySet":
        """The same entities over the files written by ``save``."""
        return EntitySet([replace(e, df=spark.read.parquet(f"{folder}/{e.name}")) for e in self.entities.values()])


def keep_last_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last in (order, all other columns) order."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    if not ranked:
        return df.dropDuplicates(keys)
    # an aggregate combines before the shuffle, so many rows of one key never meet in one task
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("__last"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns])


def virtual_parent(base: DataFrame, key: str, time: str | None = None) -> DataFrame:
    """Distinct keys of a base table, with the first time each was seen."""
    rows = base.where(F.col(key).isNotNull())
    if time is None:
        return rows.select(key).distinct()
    return rows.groupBy(key).agg(F.min(time).alias(f"first_{time}"))


def parent_lookup(child: DataFrame, parent: DataFrame, child_column: str, parent_key: str, prefix: str) -> DataFrame:
    """Child rows with all other parent columns, named ``<prefix>_<column>``."""
    renamed = parent.select(F.col(parent_key).alias("__pk"), *[
        F.col(c).alias(f"{prefix}_{c}") for c in parent.columns if c != parent_key])
    left, right = F.col(child_column), F.col("__pk")
    if child.schema[child_column].dataType != parent.schema[parent_key].dataType:
        left, right = left.cast("string"), right.cast("string")
    return child.join(renamed, left == right, "left").drop("__pk")


def product_join(behaviour: DataFrame, product: DataFrame, key: str, suffix: str = "_product_entity") -> DataFrame:
    """Inner join on the product key; product columns whose name clashes get a suffix."""
    clashes = {c: c + suffix for c in product.columns if c in behaviour.columns and c != key}
    return behaviour.join(product.withColumnsRenamed(clashes), key)


def common_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key also occurs in ``right``."""
    keys = right.select(F.col(right_key or key).alias(key)).distinct()
    return left.join(keys, key, "left_semi")


def frequent_values(df: DataFrame, columns: Sequence[str], max_values: int) -> DataFrame:
    """Most frequent values per column as (column, value, n, share).

    With 25 or more distinct values only those with a share strictly between 5 % and 95 % count.
    Ties are taken in value order.
    """
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("cell"))
    counts = (cells.select("cell.column", "cell.value").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("column").agg(F.sum("n").alias("__rows"), F.count(F.lit(1)).alias("__distinct"))
    shares = counts.join(F.broadcast(totals), "column").withColumn("share", F.col("n") / F.col("__rows"))
    kept = shares.where((F.col("__distinct") < 25) | ((F.col("share") > 0.05) & (F.col("share") < 0.95)))
    best = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (kept.withColumn("__pos", F.row_number().over(best)).where(F.col("__pos") <= max_values)
            .select("column", "value", "n", "share"))


def auto_interesting(es: EntitySet, max_values: int, skip: Sequence[str] = ()) -> EntitySet:
    """Interesting values of every discrete column; at most ``max_values`` rows per column reach the driver."""
    found: dict[str, dict[str, list]] = {}
    for e in es.entities.values():
        columns = [c for c in e.df.columns if e.kind(c) == "discrete"]
        if e.name in skip or not columns:
            continue
        for row in frequent_values(e.df, columns, max_values).collect():
            found.setdefault(e.name, {}).setdefault(row["column"], []).append(row["value"])
    return es.with_interesting({n: {c: sorted(v) for c, v in cols.items()} for n, cols in found.items()})


def with_native_keys(es: EntitySet) -> EntitySet:
    """Cast key columns to text only where the two sides of a relationship differ in type."""
    text: dict[str, set[str]] = {}
    for e in es.entities.values():
        for p in e.parents:
            parent = es[p.name]
            if e.df.schema[p.column].dataType != parent.df.schema[parent.key].dataType:
                text.setdefault(e.name, set()).add(p.column)
                text.setdefault(p.name, set()).add(parent.key)
    # a parent key cast for one child must be cast for all its children
    for e in es.entities.values():
        for p in e.parents:
            if es[p.name].key in text.get(p.name, ()):
                text.setdefault(e.name, set()).add(p.column)
    return EntitySet([
        replace(e, df=e.df.withColumns({c: F.col(c).cast("string") for c in sorted(text[e.name])})) if e.name in text else e
        for e in es.entities.values()])
