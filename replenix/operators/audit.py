"""Write, audit, publish (D5): constraints are checked on staged files, and a load is published only if none fails.

A refused load leaves the published table as it was; what is wrong with it is kept as findings, row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from replenix.operators import master as mst
from replenix.sinks import snapshots

# fixed values: the folder of an unpartitioned snapshot
STATIC, LATEST = "static", "latest"


@dataclass
class Constraints:
    key: list[str]
    required: list[str] = field(default_factory=list)
    references: list[tuple[str, DataFrame, str]] = field(default_factory=list)   # column, parent, name of the finding


def findings(rows: DataFrame, rules: Constraints) -> DataFrame:
    """Key columns, rule and column: one row per violation (a repeated key once)."""
    def named(df, rule, column):
        return df.select(*rules.key, rule.alias("rule"), column.alias("column"))

    out = named(mst.duplicate_keys(rows, rules.key), F.lit("duplicate_key"), F.lit(",".join(rules.key)))
    if rules.required:
        out = out.unionByName(named(mst.null_violations(rows, rules.required, rules.key), F.lit("null"), F.col("column")))
    for column, parent, rule in rules.references:
        # a null refers to nothing, as in a database
        bad = mst.orphans(rows.where(F.col(column).isNotNull()), [(column, parent, rule)], rules.key)
        out = out.unionByName(named(bad, F.col("reason"), F.lit(column)))
    return out


def audited_load(spark: SparkSession, base: str, table: str, rows: DataFrame, rules: Constraints,
                 rejects: str) -> tuple[snapshots.Version | None, DataFrame]:
    """Stages ``rows`` as the new snapshot of ``table``, checks the staged files, and publishes them if nothing is found.

    -> (the version, or None for a refused load; the findings, kept below ``rejects``)."""
    based_on = snapshots.version(spark, base)
    staged = {table: snapshots.stage(rows.withColumn(STATIC, F.lit(LATEST)), base, table, STATIC, [LATEST])}
    draft = snapshots.Version(0, {table: {p: f for p, f in staged[table].items() if f}})
    schema = rows.withColumn(STATIC, F.lit(LATEST)).schema
    written = snapshots.read(spark, base, table, schema, STATIC, draft).drop(STATIC)
    found = findings(written, rules)
    found.write.mode("overwrite").parquet(rejects)
    found = spark.read.schema(found.schema).parquet(rejects)
    if not found.isEmpty():
        return None, found
    return snapshots.commit(spark, base, staged, based_on), found


def read_master(spark: SparkSession, base: str, table: str, schema) -> DataFrame:
    """The published snapshot of a master table."""
    from pyspark.sql import types as T

    whole = T.StructType([*schema.fields, T.StructField(STATIC, T.StringType())])
    return snapshots.read(spark, base, table, whole, STATIC).drop(STATIC)
