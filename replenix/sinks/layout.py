"""Clustered tables (S6, P8): rows in the order of a space-filling curve over two columns.

Both columns are cut into as many ranges of about equal counts; the bits of the two range numbers are interleaved
(Z-order), and rows are written in ranges of that key.  A file, and each of its row groups, then spans few values of
either column, so the min-max statistics in the footers let a read of one SKU and one week skip nearly all of them;
Parquet Bloom filters on the columns skip row groups that only span a wanted value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from replenix.session import scratch_path
from replenix.sinks.writers import remove_folder


def as_number(df: DataFrame, column: str) -> Column:
    """A number that grows with the column: itself, days of a date, or the first seven bytes of a text."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.conv(F.rpad(F.substring(F.hex(F.encode(c.cast("string"), "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("double")


def with_curve_key(df: DataFrame, columns: list[str], bits: int = 6, name: str = "_curve") -> DataFrame:
    """``df`` with the interleaved numbers of the columns' ranges; the range ends are short arrays, taken in one aggregate."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    ends = df.agg(*[F.percentile_approx(as_number(df, c), shares, 10_000).alias(f"e{i}") for i, c in enumerate(columns)])
    none = F.array().cast("array<double>")
    marked = df.withColumns({f"_ends{i}": F.coalesce(ends.select(f"e{i}").scalar(), none) for i in range(len(columns))})
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        x = as_number(df, c)
        number = F.size(F.filter(f"_ends{i}", lambda e, x=x: e < x))
        number = F.when(x.isNull(), 0).otherwise(number).cast("long")   # nulls stand with the smallest
        for b in range(bits):
            key = key + F.shiftleft(F.shiftright(number, b).bitwiseAND(F.lit(1)), b * len(columns) + i)
    return marked.withColumn(name, key).drop(*[f"_ends{i}" for i in range(len(columns))])


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = 6,
                    row_group_bytes: int = 16 << 20, page_rows: int = 20_000, file_rows: int = 1_000_000) -> None:
    """Writes ``df`` in ``files`` files along the curve over ``columns``, replacing the table; in more, so that none
    has to sort many more than ``file_rows`` rows.

    The rows are staged first: their count, the ends of the ranges, the cut into files and the files read them."""
    staged = scratch_path(df.sparkSession, "clustered")
    df.write.parquet(staged)
    df = df.sparkSession.read.schema(df.schema).parquet(staged)
    files = max(files, -(-df.count() // file_rows))
    out = with_curve_key(df, columns, bits)
    out = out.repartitionByRange(files, "_curve", *columns).sortWithinPartitions("_curve", *columns).drop("_curve")
    writer = (out.write.mode("overwrite").option("parquet.block.size", str(row_group_bytes))
              .option("parquet.page.row.count.limit", str(page_rows)))
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    remove_folder(df.sparkSession, staged)
