"""Incremental maintenance of demand and net demand (A1, A2, W1, B1): late and corrected files as signed changes.

A correction is the old line with sign -1 and the new one with +1; a late file is +1 throughout.  Sums are merged by
adding, a group goes when its last line does, and only the SKUs that a change touches are computed again: from the
merged sums, never from the facts.  A supplier choice is a minimum, which cannot be merged when rows go, so it is taken
again from the price list of the touched SKUs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.operators import mrp
from replenix.operators import suppliers as sup

LINES = "n_lines"


def demand_state(lines: DataFrame, period: str = DEFAULT_PERIOD, sign: str | None = None) -> DataFrame:
    """period, sku, total_demand and the number of lines behind it; with ``sign`` (+1, -1) the change they make."""
    s = F.lit(1) if sign is None else F.col(sign)
    return lines.groupBy(period, "sku").agg(F.sum(F.col("quantity").cast("long") * s).alias("total_demand"),
                                            F.sum(s.cast("long")).alias(LINES))


def stock_state(rows: DataFrame, period: str = DEFAULT_PERIOD, sign: str | None = None) -> DataFrame:
    """period, sku, stock summed over warehouses and the number of rows behind it, likewise."""
    s = F.lit(1) if sign is None else F.col(sign)
    return rows.groupBy(period, "sku").agg(
        *[F.sum(F.col(c).cast("long") * s).alias(c) for c in ("available_stock", "reserved_stock")],
        F.sum(s.cast("long")).alias(LINES))


def merge(state: DataFrame, change: DataFrame, key: list[str]) -> DataFrame:
    """The state after a change of the same columns: sums added, groups without lines gone.

    One aggregate of the union: state and change are one row per group each, and neither is read twice."""
    sums = [c for c in state.columns if c not in key]
    both = state.unionByName(change.select(*state.columns))
    return both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in sums]).where(F.col(LINES) > 0).select(*state.columns)


def touched(*changes: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct keys that any of the changes names."""
    out = None
    for c in changes:
        out = c.select(*columns) if out is None else out.unionByName(c.select(*columns))
    return out.distinct()


def merge_preferred(preferred: DataFrame, product_suppliers: DataFrame, changed: DataFrame) -> DataFrame:
    """The supplier choice after a change of the price list: taken again for the SKUs of ``changed`` only."""
    skus = changed.select("sku").distinct()
    again = sup.preferred_suppliers(product_suppliers.join(skus, "sku", "left_semi"))
    return preferred.join(skus, "sku", "left_anti").unionByName(again.select(*preferred.columns))


def merge_net(net: DataFrame, demand: DataFrame, stock: DataFrame, master: DataFrame, groups: DataFrame,
              skus: DataFrame | None = None, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Net demand after changes: rows of the touched ``groups`` (period, sku), and of ``skus`` whose master row changed
    in any period, are computed again from the merged sums; all others stay as they are."""
    if skus is not None:
        groups = groups.select(period, "sku").union(demand.join(skus.select("sku"), "sku", "left_semi").select(period, "sku")).distinct()
        stale = net.join(groups, [period, "sku"], "left_anti").join(skus.select("sku").distinct(), "sku", "left_anti")
    else:
        groups = groups.select(period, "sku")
        stale = net.join(groups, [period, "sku"], "left_anti")
    key = [period, "sku"]
    again = mrp.net_demand(demand.join(groups, key, "left_semi").select(*key, "total_demand"),
                           stock.join(groups, key, "left_semi").select(
                               *key, F.col("available_stock").cast("int").alias("available_stock"),
                               F.col("reserved_stock").cast("int").alias("reserved_stock")), master, period)
    return stale.select(*net.columns).unionByName(again.select(*net.columns))
