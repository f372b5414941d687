"""Net demand (MRP, B1) and its parts: pack rounding (F2-F4), MOQ filter (P3),
the audit of SKUs the joins drop (J6) and run metrics (A3, K11).

    raw   = max(0, demand + safety_stock - (available - reserved))   NULL if safety is NULL
    final = ceil(raw / pack_size) * pack_size                         NULL if pack is 0
    keep rows with final >= moq;  estimated_cost = final * unit_cost
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import money, raw_demand, round_up_to_pack
from replenix.schemas import NET_DEMAND_COLUMNS


def pack_rounding(demand: DataFrame, stock: DataFrame, master: DataFrame,
                  period: str = DEFAULT_PERIOD, how: str = "inner", keep: tuple[str, ...] = ()) -> DataFrame:
    """All MRP columns before the MOQ filter (one row per demanded SKU with a supplier; with
    ``how="left"`` one per demanded SKU).  ``keep`` names further columns of ``master`` to carry.

    Demand and stock are both one row per (period, sku), so they are joined first
    on their common partitioning; the result meets the (one row per sku) master on sku.
    """
    j = (demand.join(stock, [period, "sku"], "left")
         .join(master, "sku", how))
    avail = F.coalesce("available_stock", F.lit(0)).cast("int")
    resv = F.coalesce("reserved_stock", F.lit(0)).cast("int")
    raw = raw_demand("total_demand", "safety_stock", "available_stock", "reserved_stock")
    out = j.select(
        period, "sku", "supplier_id", F.col("total_demand").cast("long").alias("total_demand"),
        avail.alias("available_stock"), resv.alias("reserved_stock"),
        F.col("safety_stock").cast("int").alias("safety_stock"),
        F.col("pack_size").cast("int").alias("pack_size"), F.col("moq").cast("int").alias("moq"),
        F.col("unit_cost").cast("double").alias("unit_cost"), raw.alias("raw_demand"), *keep)
    return out.withColumn("final_order_qty", round_up_to_pack("raw_demand", "pack_size"))


def net_demand(demand: DataFrame, stock: DataFrame, master: DataFrame,
               period: str = DEFAULT_PERIOD) -> DataFrame:
    """processed.net_demand: the 12 table columns plus the period, rows with final >= moq."""
    r = pack_rounding(demand, stock, master, period)
    return (r.where(F.col("final_order_qty") >= F.col("moq"))
            .withColumn("estimated_cost", F.col("final_order_qty").cast("double") * F.col("unit_cost"))
            .select(*NET_DEMAND_COLUMNS, period))


def below_moq(rounded: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Positive orders the MOQ filter drops (they are not raised to the MOQ)."""
    return (rounded.where((F.col("final_order_qty") > 0) & (F.col("final_order_qty") < F.col("moq")))
            .select(period, "sku", "final_order_qty", "moq"))


def dropped_skus(demand: DataFrame, stock: DataFrame, products: DataFrame, preferred: DataFrame,
                 suppliers: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Rows the inner joins silently lose -> period, sku, reason.

    missing_product      demanded SKU absent from products
    missing_supplier     product without any priced supplier
    unknown_supplier     net-demand row whose supplier is not in suppliers (lost at export)

    The demand meets one catalogue-sized table of flags once; one CASE names the reason.
    """
    known = suppliers.select("supplier_id", F.lit(True).alias("_known")).distinct()
    flags = (products.select("sku", "pack_size", "moq", "safety_stock", F.lit(True).alias("_product"))
             .join(preferred.withColumn("_priced", F.lit(True)).join(known, "supplier_id", "left"), "sku", "left"))
    r = pack_rounding(demand, stock, flags, period, how="left", keep=("_product", "_priced", "_known"))
    reason = (F.when(F.col("_product").isNull(), "missing_product")
              .when(F.col("_priced").isNull(), "missing_supplier")
              .when((F.col("final_order_qty") >= F.col("moq")) & F.col("_known").isNull(), "unknown_supplier"))
    return r.select(period, "sku", reason.alias("reason")).where("reason is not null")


def run_metrics(net: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Per period: SKU count, total quantity, total cost as exact DECIMAL(18,2).

    The cost is re-derived from the 2-decimal unit cost so the sum is exact and
    independent of row order (a DOUBLE sum is not).
    """
    line_cost = F.col("final_order_qty").cast("decimal(18,0)") * F.col("unit_cost").cast("decimal(10,2)")
    return (net.groupBy(period)
            .agg(F.count(F.lit(1)).alias("sku_count"),
                 F.coalesce(F.sum("final_order_qty"), F.lit(0)).cast("long").alias("total_qty"),
                 money(F.coalesce(F.sum(line_cost), F.lit(0))).alias("total_cost")))
