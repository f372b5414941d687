"""Master-data rules Spark does not enforce: column defaults (D6),
insert-if-absent (D7), primary-key duplicates and orphan references (D5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def apply_defaults(df: DataFrame, schema: T.StructType, defaults: dict) -> DataFrame:
    """Columns of ``schema`` absent from ``df`` are added with their default (or NULL).

    As with SQL column defaults, an explicit NULL in a present column stays NULL.
    Output columns follow ``schema`` order, cast to the declared types.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            v = defaults.get(f.name)
            cols.append(F.lit(v).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: list[str],
                     order_by: str | None = None) -> DataFrame:
    """existing UNION (incoming rows whose key is not in existing): ON CONFLICT DO NOTHING.

    Duplicate keys inside ``incoming`` keep their first row by ``order_by``.
    """
    new = incoming.join(existing.select(*key), key, "left_anti")
    if order_by is not None:
        # first row per key by an aggregate (combined map-side), not a window over the group
        rest = [c for c in new.columns if c not in key]
        new = (new.groupBy(*key)
               .agg(F.min_by(F.struct(*rest), F.col(order_by)).alias("_r"))
               .select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]))
    else:
        new = new.dropDuplicates(key)
    return existing.unionByName(new.select(*existing.columns))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Primary-key violations -> key columns, n (count > 1)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_violations(df: DataFrame, required: list[str], key: list[str]) -> DataFrame:
    """NOT NULL violations -> key columns, column: one row per required column that is NULL."""
    absent = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())
    return df.select(*key, F.explode(absent).alias("column"))


def orphans(df: DataFrame, refs: list[tuple[str, DataFrame, str]], key: list[str]) -> DataFrame:
    """Foreign-key violations: for each (column, parent, reason) the rows of ``df`` whose
    ``column`` is not in ``parent`` -> key columns, reason.  A row can fail several references."""
    out = None
    for column, parent, reason in refs:
        bad = (df.select(*dict.fromkeys([*key, column])).join(parent.select(F.col(column)).distinct(), column, "left_anti")
               .select(*key, F.lit(reason).alias("reason")))
        out = bad if out is None else out.unionByName(bad)
    return out
