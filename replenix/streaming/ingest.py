"""Incremental ingest of arriving order files (S1 + K2 as a stream).

Daily folders of store files are picked up by a file-stream source with a
declared schema; each micro-batch is written to the partitioned raw table,
replacing only the dates it carries.  ``availableNow`` processes everything
present and stops, so the same code serves a scheduled run and a backlog.
Progress (which files were taken) is kept in the checkpoint location, so a
restarted run continues where the last one stopped.

Files of one date may arrive in different batches, so a batch must not replace
the whole date: each batch writes its own sub-partition (date, batch id) with
dynamic overwrite.  A failed batch re-runs under the same id and replaces
exactly its own folder — idempotent without a transactional table format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import file_stem
from replenix.session import apply_correctness_conf, scratch_path
from replenix.sinks.writers import remove_folder
from replenix.sources.files import CORRUPT, DATE_FOLDER, glob_any_case


def order_file_stream(spark: SparkSession, root: str, schema: T.StructType, period: str = DEFAULT_PERIOD,
                      date_pattern: str = DATE_FOLDER, multi_line: bool = True,
                      max_files_per_trigger: int | None = None, ext: str = ".json") -> DataFrame:
    """Streaming rows of the ``ext`` files below ``root``; the period is the folder date.

    Damaged records keep their text in the corrupt-record column, which ``ingest_available`` sorts out."""
    r = (spark.readStream.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("multiLine", multi_line).option("recursiveFileLookup", True)
         .option("pathGlobFilter", glob_any_case(ext)))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(root)
    path = F.col("_metadata.file_path")
    return df.select("*", F.regexp_extract(path, date_pattern, 1).alias(period), file_stem(path).alias("source_file"))


def ingest_available(stream: DataFrame, table_path: str, checkpoint: str, period: str = DEFAULT_PERIOD,
                     rejects_path: str | None = None) -> None:
    """Write everything available now to the partitioned table, then stop.

    Records that did not parse, and records without a folder date, go to ``rejects_path`` (default: a
    table beside the target) with their file, per batch."""
    rejects_path = rejects_path or table_path.rstrip("/") + "-rejects"
    values = [c for c in stream.columns if c not in (CORRUPT, period, "source_file")]

    def write_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        apply_correctness_conf(spark)
        staged = scratch_path(spark, "stream-batch")   # parsed once, read as rows and as rejects
        batch.write.parquet(staged)
        parsed = spark.read.schema(batch.schema).parquet(staged)
        good = F.col(CORRUPT).isNull() & (F.col(period) != "")
        (parsed.where(good).select(*values, period).withColumn("ingest_batch", F.lit(int(epoch)))
         .write.mode("overwrite").partitionBy(period, "ingest_batch").parquet(table_path))
        record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*values)))
        (parsed.where(~good).select(period, "source_file", record.alias("record"), F.lit(int(epoch)).alias("ingest_batch"))
         .write.mode("overwrite").partitionBy("ingest_batch").parquet(rejects_path))
        remove_folder(spark, staged)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
