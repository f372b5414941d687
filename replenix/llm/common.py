"""Helpers shared by the training-data operators: table access, scratch tables, hold-out rule, code shipping."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replenix.session import checkpoint_root, scratch_path

# Fixed value: the white space that separates words in every contract (blank and \x09-\x0D).
WORD_RE = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str, compression: str = "zstd", partition_by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder of the session and read back.

    Cuts the lineage: a lost executor costs a re-read, never a re-computation, and two readers share one
    evaluation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    checkpoint_root(spark)
    return scratch_path(spark, name)


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """True for the rows that models must not learn from: crc32(doc_id as text) mod modulus = remainder."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when they see the driver's folder (local mode, shared homes).

    A cluster without such a folder gets the package by ``--py-files`` as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    # whole texts travel in these batches: few rows each, so that very long documents fit a worker's memory
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def in_row(df: DataFrame) -> DataFrame:
    """All columns inside one struct ``row``: columns that an operator adds beside it can never clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def texts(batch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of the text field of ``row`` (or of a plain column) of an Arrow batch; null gives b""."""
    import pyarrow as pa

    at = batch.schema.get_field_index("row")
    found = batch.column(at).field(column) if at >= 0 else batch.column(batch.schema.get_field_index(column))
    if at >= 0 and batch.column(at).null_count:
        raise ValueError("row is null")
    return [t or b"" for t in found.cast(pa.binary()).to_pylist()]


class BoundedCache(dict):
    """``make(key)`` remembered for the keys seen of late; at most 2 * ``limit`` entries are held.

    Two generations: when the young one is full it becomes the old one, and keys still in use move back.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def known(self, key) -> bool:
        if key in self:
            return True
        value = self.old.get(key)
        if value is None:
            return False
        self.put(key, value)
        return True
