"""Demand and stock aggregation (A1, A2) and the demand/stock join.

Both sides are aggregated to one row per (period, sku) before they meet, so the
join never sees more than one row per key per side: a SKU with a third of all
order lines costs one partial-aggregation row per task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import free_stock


def aggregate_demand(orders: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """SUM(quantity) per (period, sku) as BIGINT -> period, sku, total_demand."""
    return (orders.groupBy(period, "sku")
            .agg(F.sum(F.col("quantity").cast("long")).alias("total_demand")))


def inventory_by_sku(inventory: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Stock summed over warehouses per (period, sku), kept as INTEGER like the table.

    Summed as BIGINT first; the final INTEGER cast raises on overflow (ANSI) instead
    of wrapping.
    """
    return (inventory.groupBy(period, "sku")
            .agg(F.sum(F.col("available_stock").cast("long")).cast("int").alias("available_stock"),
                 F.sum(F.col("reserved_stock").cast("long")).cast("int").alias("reserved_stock")))


def demand_vs_stock(demand: DataFrame, stock: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Demand LEFT JOIN stock on (period, sku); a SKU without a stock row has 0 stock."""
    j = demand.join(stock, [period, "sku"], "left")
    return j.select(
        period, "sku", "total_demand",
        F.coalesce("available_stock", F.lit(0)).cast("int").alias("available_stock"),
        F.coalesce("reserved_stock", F.lit(0)).cast("int").alias("reserved_stock"),
        free_stock("available_stock", "reserved_stock").cast("int").alias("free_stock"))
