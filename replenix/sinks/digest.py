"""Content digests of tables (K9): equal exactly when two tables hold the same rows, in whatever order and files.

Every row's columns are written out as one text, hashed, and the four 32-bit parts of the hash are summed.  Sums do not
depend on order, keep repeated rows apart from single ones, and are combined map-side, so a partition of any size is one
row per task.  Both halves of a part are summed as whole numbers (a decimal per row costs more than its hash); they are
put together once per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replenix import DEFAULT_PERIOD


def row_text(columns: list[str]) -> Column:
    """The values in the order of ``columns``, each with its length, so that no two rows are written alike."""
    def value(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat_ws("|", *[value(c) for c in columns])


def content_digest(df: DataFrame, period: str = DEFAULT_PERIOD, columns: list[str] | None = None) -> DataFrame:
    """period, row_count, digest of every period of a table; ``columns`` default to all others, by name."""
    names = sorted(c for c in df.columns if c != period) if columns is None else columns
    digest = F.md5(row_text(names).cast("binary"))
    parts = [F.conv(F.substring("_h", 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_p{k}") for k in range(4)]

    def total(part: str) -> Column:
        high, low = F.sum(F.shiftright(part, 16)), F.sum(F.col(part).bitwiseAND(F.lit(0xFFFF)))
        return (high.cast("decimal(27,0)") * F.lit(1 << 16).cast("decimal(5,0)") + low).cast("decimal(38,0)").cast("string")

    return (df.select(F.col(period), digest.alias("_h")).select(period, *parts).groupBy(period)
            .agg(F.count(F.lit(1)).alias("row_count"), F.concat_ws("-", *[total(f"_p{k}") for k in range(4)]).alias("digest")))


def differences(left: dict[str, DataFrame], right: dict[str, DataFrame], period: str = DEFAULT_PERIOD) -> DataFrame:
    """table_name and period of whatever the two sets of tables hold differently (or one of them not at all)."""
    def digests(tables):
        out = None
        for name, df in tables.items():
            part = content_digest(df, period).select(F.lit(name).alias("table_name"), F.col(period).cast("string").alias(period),
                                                     "row_count", "digest")
            out = part if out is None else out.unionByName(part)
        return out

    one, two = digests(left), digests(right)
    return one.exceptAll(two).unionByName(two.exceptAll(one)).select("table_name", period).distinct()
