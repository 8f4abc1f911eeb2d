"""Sources: files, JDBC tables and queries, catalog tables, snapshots and word lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutline.functions.actions import exclude_values
from cutline.functions.standardize import standardize_types

JDBC_PREFIX = {"mysql": "jdbc:mysql", "greenplum": "jdbc:postgresql", "postgresql": "jdbc:postgresql"}
FLAGS = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}


def typed_options(extra: Sequence[Mapping] | None) -> dict:
    """(para_name, para_value, para_value_type) entries as options; types string, int, float, bool."""
    def flag(v):
        return v if isinstance(v, bool) else FLAGS[str(v).lower()]

    casts = {"string": str, "int": int, "float": float, "bool": flag}
    out = {}
    for entry in extra or ():
        kind = entry.get("para_value_type", "string")
        if kind not in casts:
            raise ValueError(f"unknown option type: {kind!r}")
        out[entry["para_name"]] = casts[kind](entry["para_value"])
    return out


@dataclass(frozen=True)
class Database:
    """Where a JDBC source or sink lives. Credentials come from the caller, never from this package."""

    type: str
    host: str
    port: int
    database: str
    user: str
    password: str = field(repr=False)
    schema: str | None = None
    options: Mapping = field(default_factory=dict)

    @classmethod
    def from_config(cls, info: Mapping) -> "Database":
        options = typed_options(info.get("extra_para"))
        return cls(info["type"], info["host"], int(info["port"]), info["database"], info["user"],
                   info["password"], options.pop("schema", None), options)

    @property
    def url(self) -> str:
        if self.type not in JDBC_PREFIX:
            raise ValueError(f"unknown database type: {self.type!r}")
        return f"{JDBC_PREFIX[self.type]}://{self.host}:{self.port}/{self.database}"

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def jdbc_options(self) -> dict:
        return {"url": self.url, "user": self.user, "password": self.password,
                **{k: str(v) for k, v in self.options.items()}}


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None,
             nrows: int | None = None, absent_ok: bool = False) -> DataFrame:
    """CSV with a header. Without a schema all columns are text. An absent file is an error, or an
    empty frame with ``absent_ok``."""
    try:
        df = spark.read.csv(path, sep=sep, header=True, schema=schema)
    except AnalysisException as e:
        if not absent_ok or e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema or "`empty` string")
    return row_cap(df, nrows)


def read_parquet(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    return row_cap(spark.read.parquet(path), nrows)


def jdbc_read_options(
    db: Database, table: str | None = None, sql: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
) -> dict:
    """Options of a JDBC scan: a query replaces the table; ``partition`` is (column, lower, upper, n)."""
    if (table is None) == (sql is None):
        raise ValueError("give a table or a query")
    options = db.jdbc_options()
    if partition is None:
        options.update({"query": sql} if sql else {"dbtable": db.table(table)})
        return options
    column, lower, upper, n = partition
    options.update({
        "dbtable": f"({sql}) source_rows" if sql else db.table(table), "partitionColumn": column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(n)})
    return options


def read_jdbc(spark: SparkSession, db: Database, table: str | None = None, sql: str | None = None,
              partition: tuple[str, object, object, int] | None = None, nrows: int | None = None) -> DataFrame:
    """A database table or query. Large tables need ``partition``, or one task reads them all."""
    return row_cap(spark.read.format("jdbc").options(**jdbc_read_options(db, table, sql, partition)).load(), nrows)


def read_catalog(spark: SparkSession, table: str | None = None, sql: str | None = None,
                 nrows: int | None = None) -> DataFrame:
    """A table or query of the session catalog (Hive metastore tables included)."""
    return row_cap(spark.sql(sql) if sql else spark.table(table), nrows)


def row_cap(df: DataFrame, nrows: int | None) -> DataFrame:
    """The first n rows for previews and test mode; 0 keeps the schema only."""
    return df if nrows is None else df.limit(nrows)


def modified_since(df: DataFrame, column: str, moment) -> DataFrame:
    """Incremental scan; the comparison is pushed to the source."""
    kind = df.schema[column].dataType.simpleString()
    return df.where(F.col(column) >= F.lit(str(moment)).cast(kind))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as a distinct ``word`` column."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def load_entities(spark: SparkSession, descriptions: Sequence[Mapping], nrows: int | None = None,
                  tables: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Lazy, typed and filtered frames of all described entities that have data of their own.

    The data come from ``tables`` if the name is there, else from the description: ``url``
    (``url_type`` csv or parquet, ``url_sep``), ``sql``, or ``table_name`` with ``db_info``.
    """
    out = {}
    for d in descriptions:
        name = d["entity_name"]
        if d.get("normalize_base_entity"):
            continue
        if tables is not None and name in tables:
            df = row_cap(tables[name], nrows)
        elif d.get("url"):
            read = read_parquet if d.get("url_type") == "parquet" else read_csv
            extra = {} if d.get("url_type") == "parquet" else {
                "sep": d.get("url_sep") or ",", "absent_ok": bool(d.get("absent_ok"))}
            df = read(spark, d["url"], nrows=nrows, **extra)
        elif d.get("db_info", {}).get("type") in JDBC_PREFIX:
            table = None if d.get("sql") else d.get("table_name", name)
            df = read_jdbc(spark, Database.from_config(d["db_info"]), table, d.get("sql"), nrows=nrows)
        else:
            df = read_catalog(spark, d.get("table_name", name), d.get("sql"), nrows)
        df = standardize_types(df, [f for f in d.get("field_list") or () if f["name"] in df.columns])
        out[name] = exclude_values(df, d.get("filter_data_list"))
    return out
