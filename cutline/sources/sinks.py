"""Sinks: files and JDBC tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutline.sources.readers import Database

# fixed values: rows per insert statement
BATCH_ROWS = {"mysql": 10_000, "greenplum": 5_000, "postgresql": 5_000}
FILE_SAFE = {"/": "_"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_sorted(df: DataFrame, path: str, *by, mode: str = "overwrite") -> None:
    """Parquet files in the order of ``by``: ranges first, then sorted inside each, never in one task."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def staged(df: Callable[[], DataFrame], spark: SparkSession, path: str, resume: bool = False, by: Sequence = (),
           mark: str | None = None) -> DataFrame:
    """The stage output at ``path``: what an earlier run completed (``resume``), else ``df()`` written there.

    ``mark``: fingerprint of all that the stage is made from. It names a folder below ``path``, so output of another
    one is neither taken over nor overwritten while it may still be read.
    """
    path = path if mark is None else f"{path}/{mark}"
    if not (resume and path_exists(spark, f"{path}/_SUCCESS")):
        if by:
            write_sorted(df(), path, *by)
        else:
            write_parquet(df(), path)
    return spark.read.parquet(path)


def append_rows(df: DataFrame, table: str) -> None:
    """Append to a catalog table, which is made from the schema if it is absent."""
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    df.write.mode("append").insertInto(table)


def write_batch(df: DataFrame, table: str, batch: str) -> None:
    """The rows of one batch in a catalog table partitioned by ``batch``, which is made if it is absent.

    A repeated run of a batch replaces what the run before left of it, so no row comes in twice. The rows are written once, to
    a folder of their own below the table, which then becomes the folder of the batch: ``df`` may read the table, and a run
    that fails while computing them leaves the table as it was.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, batch string) USING parquet PARTITIONED BY (batch)")
    fields = [f for f in spark.table(table).schema if f.name != "batch"]
    if len(fields) != len(df.columns):
        raise ValueError(f"{table} has the columns {[f.name for f in fields]}, not {df.columns}")
    home = _location(spark, table)
    folder = f"{home}/batch-{uuid.uuid4().hex}"
    df.toDF(*[f.name for f in fields]).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in fields]).write.parquet(folder)
    value = batch.replace("\\", "\\\\").replace("'", "\\'")
    part = f"PARTITION (batch = '{value}')"
    known = spark.sql(f"SHOW PARTITIONS {table} {part}").count() > 0
    old = _location(spark, f"{table} {part}") if known else None
    spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{folder}'" if known else f"ALTER TABLE {table} ADD {part} LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    if old and old.startswith(f"{home}/"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _location(spark: SparkSession, what: str) -> str:
    """Folder of a catalog table or of a partition of it; the details come after the columns, a partition's before its table's."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect()]
    details = next(i for i, (name, _) in enumerate(rows) if name.startswith("# Detailed"))
    return next(value for name, value in rows[details:] if name == "Location").rstrip("/")


def write_by_product(labels: DataFrame, path: str) -> None:
    """Label table in long form, one folder per product."""
    write_parquet(labels, path, partition_by=("product",))


def sanitized(df: DataFrame) -> DataFrame:
    """Quotes in text become blanks; the texts NaT, NaN and None become NULL."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    clean = {}
    for c in text:
        blank = F.regexp_replace(F.col(f"`{c}`"), "['\"]", " ")
        clean[c] = F.when(F.col(f"`{c}`").isin("NaT", "NaN", "nan", "None"), None).otherwise(blank)
    clean |= {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in numbers}
    return df.withColumns(clean) if clean else df


def column_types(df: DataFrame, special: Mapping[str, tuple] | None = None) -> dict[str, str]:
    """Database column types from the schema; ``special`` overrides as (varchar, n) or (decimal, p, s)."""
    out = {}
    for f in df.schema:
        d = f.dataType
        if isinstance(d, T.StringType):
            out[f.name] = "VARCHAR(255)"
        elif isinstance(d, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = "TIMESTAMP"
        elif isinstance(d, (T.FloatType, T.DoubleType)):
            out[f.name] = "DECIMAL(16,2)"
        elif isinstance(d, T.DecimalType):
            out[f.name] = f"DECIMAL({d.precision},{d.scale})"
        elif isinstance(d, (T.ByteType, T.BooleanType)):
            out[f.name] = "SMALLINT"
        elif isinstance(d, T.LongType):
            out[f.name] = "BIGINT"
        elif isinstance(d, T.IntegralType):
            out[f.name] = "INTEGER"
        else:
            raise ValueError(f"no database type for column {f.name!r} of type {d.simpleString()}")
    for name, kind in (special or {}).items():
        if kind[0] == "varchar":
            out[name] = f"VARCHAR({kind[1]})"
        elif kind[0] == "decimal":
            out[name] = f"DECIMAL({kind[1]},{kind[2]})"
        else:
            raise ValueError(f"unknown special type: {kind!r}")
    return out


def jdbc_write_options(db: Database, table: str, insert_type: str = "into", recreate: bool = False,
                       types: Mapping[str, str] | None = None) -> tuple[str, dict]:
    """(save mode, options): ``into`` appends, ``overwrite`` truncates and loads, recreate drops first."""
    options = {**db.jdbc_options(), "dbtable": db.table(table), "batchsize": str(BATCH_ROWS[db.type])}
    if types:
        options["createTableColumnTypes"] = ", ".join(f"`{c}` {t}" for c, t in types.items())
    if recreate:
        return "overwrite", options
    if insert_type == "overwrite":
        return "overwrite", {**options, "truncate": "true"}
    return "append", options


def write_jdbc(df: DataFrame, db: Database, table: str, insert_type: str = "into", recreate: bool = False,
               special: Mapping[str, tuple] | None = None) -> None:
    """Append rows. A retried task may insert a batch again; load into a staging table where that matters."""
    clean = sanitized(df)
    mode, options = jdbc_write_options(db, table, insert_type, recreate, column_types(clean, special))
    clean.write.format("jdbc").mode(mode).options(**options).save()


def save_result(spark: SparkSession, path: str, db: Database, table: str, insert_type: str = "into",
                write=write_jdbc) -> bool:
    """Load a written prediction table and save it to a database; False if there is none."""
    if not path_exists(spark, path):
        return False
    write(spark.read.parquet(path), db, table, insert_type)
    return True


def stage_folder(base: str, product: str | None = None) -> str:
    """Folder of a fitted stage; a slash in a product name becomes an underscore."""
    if product is None:
        return base
    for bad, good in FILE_SAFE.items():
        product = product.replace(bad, good)
    return f"{base}/{product}"
