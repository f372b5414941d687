"""Dashboard reports (B5-B7): KPIs, per-supplier / per-SKU / per-date series,
latest rows, and the freshness status of the data (B6).

All are aggregates (combined map-side) or filters over the pipeline tables;
"latest" selections use a scalar MAX subquery or a MAX_BY aggregate, never a
sort of a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import money
from replenix.operators.orders import exact_line_cost


def products_per_supplier(products_with_supplier: DataFrame) -> DataFrame:
    """-> supplier_id, n_products (products without a supplier are not counted)."""
    return (products_with_supplier.where(F.col("supplier_id").isNotNull())
            .groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n_products")))


def qty_per_supplier(lines: DataFrame) -> DataFrame:
    return lines.groupBy("supplier_id").agg(F.sum(F.col("quantity").cast("long")).alias("quantity"))


def newest(df: DataFrame, period: str = DEFAULT_PERIOD) -> Column:
    """The newest period of ``df`` as a scalar subquery (one value)."""
    return df.agg(F.max(period)).scalar()


def qty_per_sku_on(lines: DataFrame, period: str = DEFAULT_PERIOD, value=None) -> DataFrame:
    """Ordered quantity per SKU for one period (default: the newest, as first shown)."""
    sel = F.lit(value) if value is not None else newest(lines, period)
    return (lines.where(F.col(period) == sel)
            .groupBy(period, "sku").agg(F.sum(F.col("quantity").cast("long")).alias("quantity")))


def demand_evolution(net: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    return net.groupBy(period, "sku").agg(F.sum("total_demand").cast("long").alias("total_demand"))


def dashboard_kpis(products: DataFrame, suppliers: DataFrame, lines: DataFrame, period: str = DEFAULT_PERIOD
                   ) -> DataFrame:
    """One row: n_products, n_suppliers, total_units, total_cost (sum of per-order totals).

    The per-(period, supplier) order totals are summed exactly, which is what
    de-duplicating the order header per (date, supplier) and summing gives.
    """
    n_p = products.agg(F.count(F.lit(1))).scalar()
    n_s = suppliers.agg(F.count(F.lit(1))).scalar()
    return (lines.agg(F.coalesce(F.sum(F.col("quantity").cast("long")), F.lit(0)).alias("total_units"),
                      money(F.coalesce(F.sum(exact_line_cost()), F.lit(0))).alias("total_cost"))
            .select(n_p.alias("n_products"), n_s.alias("n_suppliers"), "total_units", "total_cost"))


def kpi_text(kpis: DataFrame, currency: str = "€") -> DataFrame:
    """The KPI tiles as display text: thousands separators, two decimals for money."""
    return kpis.select(
        F.format_number(F.col("n_products"), 0).alias("products_text"),
        F.format_number(F.col("n_suppliers"), 0).alias("suppliers_text"),
        F.format_number(F.col("total_units"), 0).alias("units_text"),
        F.concat(F.format_number(F.col("total_cost"), 2), F.lit(" " + currency)).alias("cost_text"))


def orders_for_date(lines: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Per period: units, cost, distinct suppliers; shown only when the cost is positive."""
    return (lines.groupBy(period)
            .agg(F.sum(F.col("quantity").cast("long")).alias("units"),
                 money(F.sum(exact_line_cost())).alias("cost"),
                 F.countDistinct("supplier_id").alias("n_suppliers"))
            .where(F.col("cost") > 0))


def latest_rows(net: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Rows of the newest period."""
    return net.where(F.col(period) == newest(net, period))


def latest_per_sku(net: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Per SKU the row of its newest period (MAX_BY, combined map-side)."""
    rest = [c for c in net.columns if c != "sku"]
    return (net.groupBy("sku").agg(F.max_by(F.struct(*rest), F.col(period)).alias("_r"))
            .select("sku", *[F.col(f"_r.{c}").alias(c) for c in rest]))


def newest_first(df: DataFrame, time: str, tie: str) -> DataFrame:
    """A load ordered by creation time, newest first (O2); a range sort over all tasks."""
    return df.orderBy(F.col(time).desc_nulls_last(), F.col(tie))


def table_maxima(tables: dict[str, DataFrame], period: str) -> DataFrame:
    """One row: the newest period of every table (A4), NULL for an empty one."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.max(period).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        out = one if out is None else out.unionByName(one)
    return out.groupBy().pivot("table_name", list(tables)).agg(F.max("newest"))


def safety_vs_demand(latest: DataFrame) -> DataFrame:
    return latest.select("sku", "safety_stock", "total_demand", "final_order_qty", "estimated_cost")


def freshness_status(flag_ts, *data_ts, tolerance_seconds: int = 30) -> Column:
    """Status of the 'last update' marker against the newest data time.

    stale        marker older than the newest data by more than the tolerance
    missing_flag data exist but no marker
    ok           both exist and agree
    NULL         no data at all
    """
    flag = F.col(flag_ts) if isinstance(flag_ts, str) else flag_ts
    cols = [F.col(c) if isinstance(c, str) else c for c in data_ts]
    newest_data = F.greatest(*cols) if len(cols) > 1 else cols[0]   # skips missing times
    late = flag + F.expr(f"INTERVAL {int(tolerance_seconds)} SECONDS") < newest_data
    return (F.when(flag.isNotNull() & newest_data.isNotNull() & late, F.lit("stale"))
            .when(newest_data.isNotNull() & flag.isNull(), F.lit("missing_flag"))
            .when(newest_data.isNotNull() & flag.isNotNull(), F.lit("ok")))


def newest_file_time(spark, path: str, fmt: str = "parquet"):
    """Newest modification time of the data files below ``path`` (a one-row frame)."""
    df = spark.read.format(fmt).option("recursiveFileLookup", True).load(path)
    return df.select(F.col("_metadata.file_modification_time").alias("t")).agg(F.max("t").alias("newest"))


def pipeline_freshness(spark, run_log: DataFrame, data_times: list[DataFrame],
                       tolerance_seconds: int = 30) -> DataFrame:
    """Status of the last run marker against the newest written data (B6, K10):
    marker = newest ``run_at`` of the run log, data = newest file time of the
    outputs.  Each input is a one-value aggregate used as a scalar subquery."""
    from replenix.functions.exprs import parse_iso_ts
    flag = run_log.agg(F.max(parse_iso_ts("run_at"))).scalar()
    times = [d.agg(F.max("newest")).scalar() for d in data_times]
    newest_data = F.greatest(*times) if len(times) > 1 else times[0]
    return (spark.range(1)
            .select(flag.alias("flag_ts"), newest_data.alias("newest_data"))
            .withColumn("status", freshness_status("flag_ts", "newest_data", tolerance_seconds=tolerance_seconds)))
