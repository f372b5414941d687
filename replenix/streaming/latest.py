"""Latest row per key of an arriving table (A14, B6 as a stream): keyed state that survives restarts and late files.

The state per key is the newest row seen, a streaming MAX_BY: files that arrive late, or twice, change nothing newer.
Only keys that a micro-batch changes leave it; each batch is written to a folder of its own, which a replayed batch
replaces, and the newest row per key over these folders is the table.  ``compact`` folds them into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from replenix.session import apply_correctness_conf

_BATCH = "state_batch"


def latest_stream(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Streaming rows -> key and ``row``, the newest by ``order`` (later columns break ties)."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("row"))


def keep_latest(stream: DataFrame, table_path: str, checkpoint: str) -> None:
    """Takes in everything available and stops; a restarted run goes on from its checkpoint."""
    def write_batch(changed: DataFrame, batch: int) -> None:
        apply_correctness_conf(changed.sparkSession)
        (changed.select("row.*").withColumn(_BATCH, F.lit(int(batch))).write.mode("overwrite")
         .partitionBy(_BATCH).parquet(table_path))

    q = (stream.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, table_path: str, schema: T.StructType, key: str, order: list[str]) -> DataFrame:
    """The newest row per key over all batches."""
    rows = spark.read.schema(schema).parquet(table_path)
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*schema.names), F.struct(*order)).alias("row"))
    return newest.select("row.*")
