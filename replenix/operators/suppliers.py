"""Supplier ranking (W1) and choice of one supplier per SKU.

Order: priority ascending with NULL priorities last, then unit cost ascending,
then supplier_id as the tie-break (the source leaves ties undefined).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from replenix.operators.ranking import balanced_row_number


def _order_columns():
    return [F.col("priority").asc_nulls_last(), F.col("unit_cost").asc_nulls_last(),
            F.col("supplier_id").asc_nulls_last()]


def rank_suppliers(product_suppliers: DataFrame) -> DataFrame:
    """Every (sku, supplier) with its rank -> sku, supplier_id, unit_cost DOUBLE, priority, supplier_rank."""
    ranked = balanced_row_number(
        product_suppliers.select("sku", "supplier_id", "unit_cost", "priority"),
        ["sku"], _order_columns(), name="supplier_rank")
    return ranked.select("sku", "supplier_id", F.col("unit_cost").cast("double").alias("unit_cost"),
                         "priority", F.col("supplier_rank").cast("int").alias("supplier_rank"))


def preferred_suppliers(product_suppliers: DataFrame) -> DataFrame:
    """The rank-1 supplier per SKU -> sku, supplier_id, unit_cost DOUBLE.

    Computed as a MIN over an ordered struct instead of a window: the min is
    combined map-side, so a SKU offered by very many suppliers never gathers in
    one task.  Struct fields compare in order; the leading flags put NULLs last.
    """
    key = F.struct(F.col("priority").isNull().alias("p_null"), F.col("priority").alias("p"),
                   F.col("unit_cost").isNull().alias("c_null"), F.col("unit_cost").alias("c"),
                   F.col("supplier_id").alias("s"))
    best = product_suppliers.groupBy("sku").agg(F.min(key).alias("_best"))
    return best.select("sku", F.col("_best.s").alias("supplier_id"),
                       F.col("_best.c").cast("double").alias("unit_cost"))


def sku_names(products: DataFrame, preferred: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Names an order needs, one row per SKU whose product and preferred supplier are both known
    -> sku, product_name, supplier_name, contact_email (catalogue-sized)."""
    s = suppliers.select("supplier_id", F.col("name").alias("supplier_name"), "contact_email")
    return (preferred.select("sku", "supplier_id").join(s, "supplier_id")
            .join(products.select("sku", F.col("name").alias("product_name")), "sku")
            .select("sku", "product_name", "supplier_name", "contact_email"))


def supplier_master(products: DataFrame, preferred: DataFrame) -> DataFrame:
    """Products INNER JOIN their preferred supplier -> sku, pack_size, moq, safety_stock, supplier_id, unit_cost.

    Products without any supplier drop out here (as in the source); ``dropped_skus``
    reports them.
    """
    return (products.select("sku", "pack_size", "moq", "safety_stock")
            .join(preferred, "sku"))
