"""Sinks (K1-K11): partitioned Parquet with per-partition replacement,
write-if-absent, purchase-order and report documents, partition audit and
the run log.  All writes go through Spark's commit protocol, so a lost
executor's task is simply re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from replenix import DEFAULT_PERIOD
from replenix.session import apply_correctness_conf


def _fs_delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the cluster's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder this package wrote, if it is there."""
    return _fs_delete(spark, path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _observed_set(obs: Observation, field: str, fallback: DataFrame) -> set:
    """The set an Observation collected during a write.  A write that ran no task
    (an input with no partitions) reports no metrics; then the set is computed
    from ``fallback`` (one column, the same values) by a job of its own, never
    assumed empty."""
    try:
        return set(obs.get[field] or [])
    except Exception:   # no metrics row was produced
        return {r[0] for r in fallback.distinct().collect()}


def write_partitioned(df: DataFrame, path: str, by: str | list[str] = DEFAULT_PERIOD, fmt: str = "parquet",
                      touched: list | None = None, rebalance: bool = True) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite, K2/K4/K5).

    Other dates keep their data.  ``touched`` lists the periods this run is
    responsible for: a touched period with no result rows has its old folder
    removed, which dynamic overwrite alone would leave behind.

    ``rebalance``: rows are redistributed by the partition columns before the
    write (REBALANCE hint), so each folder gets files of the advisory size
    instead of one small file per task and period (a backfill of many dates);
    AQE splits a period that is too big for one task.
    """
    spark = df.sparkSession
    apply_correctness_conf(spark)
    cols = [by] if isinstance(by, str) else list(by)
    if rebalance:
        df = df.hint("rebalance", *cols)
    if touched and len(cols) == 1:
        # the written periods are observed during the write itself (one pass; the
        # set is bounded by the number of periods, not by the data)
        obs = Observation("written_periods")
        df = df.observe(obs, F.collect_set(F.col(cols[0]).cast("string")).alias("periods"))
    df.write.mode("overwrite").partitionBy(*cols).format(fmt).save(path)
    if touched and len(cols) == 1:
        present = _observed_set(obs, "periods", df.select(F.col(cols[0]).cast("string")))
        for v in touched:
            if str(v) not in present:
                _fs_delete(spark, f"{path.rstrip('/')}/{cols[0]}={v}")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Unpartitioned master snapshot, fully replaced on each load (K3: ``…/static=latest``)."""
    df.write.mode("overwrite").parquet(path)


def existing_folders(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """The sub-folders ``root/<name>`` that exist (a listing, no data read)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    have = {st.getPath().getName() for st in fs.listStatus(base) if st.isDirectory()}
    return [f"{root.rstrip('/')}/{n}" for n in names if n in have]


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet", by: list[str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS … AS SELECT: a second call changes nothing (K6)."""
    w = df.write.mode("ignore").format(fmt)
    if by:
        w = w.partitionBy(*by)
    w.save(path)


def write_documents(records: DataFrame, path: str, period: str = DEFAULT_PERIOD, touched: list | None = None) -> None:
    """Purchase-order records as JSON lines, partitioned by date (K7).

    A date is replaced whole, so a supplier without an order any more leaves none behind; its files are
    sized by the rebalancing, which also splits the date of a supplier with very many items.
    """
    out = records.withColumn("date", F.col(period).cast("string"))
    write_partitioned(out.drop(period) if period != "date" else out, path, "date", fmt="json", touched=touched)


def archive(spark: SparkSession, src: str, dst: str, dates: list, period: str = DEFAULT_PERIOD,
            fmt: str = "parquet") -> DataFrame:
    """Copy the partitions of ``dates`` from one table to another (K9): a
    partition-pruned read and a per-partition replacing write; returns the copy."""
    part = spark.read.format(fmt).load(src).where(F.col(period).isin(*[str(d) for d in dates]))
    write_partitioned(part, dst, period, fmt=fmt, touched=list(dates))
    return spark.read.format(fmt).load(dst).where(F.col(period).isin(*[str(d) for d in dates]))


def partition_audit(spark: SparkSession, tables: dict, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Rows and files per (table, period) of written tables (K9).

    ``tables`` maps a name to a path or to a file-backed DataFrame (a read with a
    declared schema, which also works when nothing was written yet)."""
    out = None
    for name, src in tables.items():
        df = spark.read.parquet(src) if isinstance(src, str) else src
        a = (df.groupBy(F.col(period))
             .agg(F.count(F.lit(1)).alias("row_count"),
                  F.countDistinct(F.col("_metadata.file_path")).alias("file_count"))
             .select(F.lit(name).alias("table_name"), F.col(period), "row_count", "file_count"))
        out = a if out is None else out.unionByName(a)
    return out


def append_run_log(spark: SparkSession, path: str, run: DataFrame) -> None:
    """The 'last update' marker: one appended row per run."""
    run.write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
