"""Catalog set-up (D1-D4): databases, external partitioned tables over a
location, partition discovery, DDL diagnostics.  Plain Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from replenix import DEFAULT_PERIOD


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def ensure_table(spark: SparkSession, database: str, table: str, schema: T.StructType, location: str,
                 partition_by: list[str], recreate: bool = False) -> str:
    """CREATE DATABASE/TABLE IF NOT EXISTS over ``location`` and recover its partitions.

    ``recreate`` drops the table definition first (the data files stay: the
    table is external).  Partition recovery runs right after the create, so a
    re-created table never reads as empty.  Returns SHOW CREATE TABLE text.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(schema)}) USING parquet "
              f"PARTITIONED BY ({parts}) LOCATION '{location}'")
    repair(spark, database, table)
    return spark.sql(f"SHOW CREATE TABLE {name}").first()[0]


# fixed values: the four tables of a run and where they lie below its base folder
TABLES = {("raw", "orders"): "raw/orders", ("raw", "inventory"): "raw/inventory",
          ("processed", "aggregated_orders"): "processed/aggregated_orders",
          ("processed", "net_demand"): "processed/net_demand"}


def ensure_tables(spark: SparkSession, base: str, schemas: dict[str, T.StructType], period: str = DEFAULT_PERIOD,
                  suffix: str = "") -> dict[str, str]:
    """The four external tables over ``base`` with their partitions registered -> {table: DDL text}.

    ``schemas`` maps a table's name to its columns (the period last); ``suffix`` keeps runs apart."""
    return {name: ensure_table(spark, database, name + suffix, schemas[name], f"{base.rstrip('/')}/{folder}", [period],
                               recreate=True)
            for (database, name), folder in TABLES.items()}


def repair(spark: SparkSession, database: str, table: str) -> None:
    """Register partition folders written outside the catalog (mode ADD)."""
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}`")


def write_bucketed(df: DataFrame, database: str, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """An external table in ``buckets`` files groups by the hash of ``key``, sorted by it, replaced whole.

    Tables of as many buckets join and aggregate on the key without a shuffle.  Rows are dealt by the key before the
    write, so a bucket is one file and not one per task."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .format("parquet").saveAsTable(f"{database}.{name}"))
    return spark.table(f"{database}.{name}")
