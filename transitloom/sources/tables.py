"""Catalog tables and file sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitloom import schemas
from transitloom.session import SPARK_ERRORS, remove_folder, shared_folder

FORMAT = "parquet"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _identifier(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


# -- schemas and tables -------------------------------------------------------------------------

def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Create the bronze, silver and gold schemas, each at its folder under ``root``."""
    for layer in schemas.LAYERS:
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS `{prefix}{layer}` LOCATION {_quoted(f'{root}/{layer}')}"
        )


def register_tables(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Point the catalog at existing files of every known table; one status row per table."""
    report = []
    for layer, tables in schemas.LAYERS.items():
        for table in tables:
            name = f"{prefix}{layer}.{table}"
            try:
                spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {_identifier(name)} USING {FORMAT} "
                    f"LOCATION {_quoted(f'{root}/{layer}/{table}')}"
                )
                # a partitioned location is only visible after its partitions are listed
                if spark.catalog.listColumns(name) and any(
                    c.isPartition for c in spark.catalog.listColumns(name)
                ):
                    spark.catalog.recoverPartitions(name)
                report.append((name, None))
            except SPARK_ERRORS as error:
                report.append((name, str(error).splitlines()[0]))
    return spark.createDataFrame(report, "table string, error string")


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: str | None = None, location: str | None = None) -> None:
    """Typed table with the column comments of ``schema``, unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata.get("comment") else "")
        for f in schema
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_identifier(name)} ({columns}) USING {FORMAT}"
        + (f" PARTITIONED BY (`{partition_by}`)" if partition_by else "")
        + (f" LOCATION {_quoted(location)}" if location else "")
    )


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table; a managed table's files go with it."""
    spark.sql(f"DROP TABLE IF EXISTS {_identifier(name)}")


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {_identifier(name)} IS {_quoted(text)}")


def comment_columns(spark: SparkSession, name: str, comments: dict[str, str]) -> DataFrame:
    """Set column comments; a column that cannot be commented is reported, the rest go on."""
    report = []
    for column, text in comments.items():
        try:
            spark.sql(f"ALTER TABLE {_identifier(name)} ALTER COLUMN `{column}` COMMENT {_quoted(text)}")
            report.append((column, None))
        except SPARK_ERRORS as error:
            report.append((column, str(error).splitlines()[0]))
    return spark.createDataFrame(report, "column string, error string")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_identifier(name)}")


def preview(df: DataFrame, by: str | list[str], rows: int = 10) -> DataFrame:
    """The first rows in a stated order, so a preview is repeatable."""
    return df.orderBy(*([by] if isinstance(by, str) else by)).limit(rows)


def temporary_view(df: DataFrame, name: str) -> None:
    """A name for the session's SQL; it ends with the session."""
    df.createOrReplaceTempView(name)


# -- sinks --------------------------------------------------------------------------------------

def append_evolving(df: DataFrame, path: str) -> None:
    """Append to a folder; later runs may bring new columns."""
    df.write.mode("append").format(FORMAT).save(path)


def take_new_columns(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Add to a table the columns that only ``df`` has; returns ``df`` in the table's order, with nulls for what it lacks."""
    have = {f.name: f for f in spark.table(name).schema}
    new = [f for f in df.schema if f.name not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {_identifier(name)} ADD COLUMNS ({columns})")
    return df.select(*(
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(name).schema))


def append_table(df: DataFrame, name: str) -> None:
    """Append to an existing table, which takes new columns as they come."""
    take_new_columns(df.sparkSession, name, df).write.insertInto(name)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read such a folder with the union of all columns; rows from before a column existed hold null."""
    return spark.read.option("mergeSchema", True).format(FORMAT).load(path)


def replace_table(df: DataFrame, name: str, partition_by: str | None = None,
                  same_schema: bool = False) -> None:
    """Create or replace a table with its contents and schema.

    ``same_schema`` refuses to change the columns of an existing table. With ``partition_by`` the rows
    are first rebalanced on that column: a day gets few, evenly sized files and a day too big for one
    task is split.
    """
    spark = df.sparkSession
    if same_schema and spark.catalog.tableExists(name):
        check_schema(df, spark.table(name).schema)
    writer = balanced(df, partition_by).write.mode("overwrite").format(FORMAT)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, partition_by: str, values: Iterable | None = None) -> None:
    """Replace the partitions that ``df`` has rows for; of ``values``, those without rows are emptied.

    The table is created on first use. The rows are written once to the shared folder, so ``df`` may read the
    table itself, and are then moved in by a write whose own option limits it to their partitions: no session
    setting is touched, and jobs side by side do not disturb each other.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        replace_table(df, name, partition_by)
        return
    staged = shared_folder(spark, "partitions")
    balanced(df, partition_by).write.partitionBy(partition_by).format(FORMAT).save(staged)
    rows = take_new_columns(spark, name, spark.read.schema(df.schema).format(FORMAT).load(staged))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).format(FORMAT).save(location(spark, name))
    if values is not None:
        filled = {r[0] for r in rows.select(partition_by).distinct().collect()}  # one row per partition
        for value in set(values) - filled:
            spec = "null" if value is None else _quoted(str(value))
            spark.sql(f"ALTER TABLE {_identifier(name)} DROP IF EXISTS PARTITION (`{partition_by}` = {spec})")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    remove_folder(spark, staged)


def replace_rows(df: DataFrame, name: str) -> None:
    """Replace all rows of a table that ``df`` may read; its columns and comments stay."""
    spark = df.sparkSession
    staged = shared_folder(spark, "rows")
    df.write.format(FORMAT).save(staged)
    take_new_columns(spark, name, spark.read.schema(df.schema).format(FORMAT).load(staged)).write.insertInto(name, overwrite=True)
    remove_folder(spark, staged)


def location(spark: SparkSession, name: str) -> str:
    """The folder of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_identifier(name)}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def balanced(df: DataFrame, column: str | None) -> DataFrame:
    """Spread rows for a write partitioned by ``column``: a large value is split, small ones share a task."""
    return df.hint("rebalance", column) if column else df


def check_schema(df: DataFrame, expected: T.StructType) -> None:
    """Names and types must match, in any order."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    if have != want:
        raise ValueError(f"schema changed: have {have}, table has {want}")
