"""Purchase orders: order lines (J4, P4), per-supplier headers (A5), order
records (K7) and the order-date shift (F8).

A supplier may carry a large share of all SKUs, so nothing gathers one
supplier's lines: headers are map-side combined aggregates, and an order is
written as one header record and one record per item, at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import money, plus_days_text

LINE_COLUMNS = ["supplier_id", "supplier_name", "contact_email", "sku", "product_name",
                "quantity", "unit_cost", "total_cost"]


def order_lines(net: DataFrame, names: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """net_demand JOIN names on sku, positive quantities only.

    ``names`` (``suppliers.sku_names``) holds one row per SKU whose product and preferred supplier
    are known, so the demand stays where its sku put it: no shuffle by supplier.

    -> period, supplier_id, supplier_name, contact_email, sku, product_name,
       quantity INT, unit_cost DOUBLE, total_cost DOUBLE
    """
    j = (net.where(F.col("final_order_qty") > 0)
         .select(period, "supplier_id", "sku", "final_order_qty", "unit_cost", "estimated_cost")
         .join(names.select("sku", "product_name", "supplier_name", "contact_email"), "sku"))
    return j.select(period, "supplier_id", "supplier_name", "contact_email", "sku", "product_name",
                    F.col("final_order_qty").cast("int").alias("quantity"),
                    F.col("unit_cost").cast("double").alias("unit_cost"),
                    F.col("estimated_cost").cast("double").alias("total_cost"))


def exact_line_cost(quantity="quantity", unit_cost="unit_cost") -> Column:
    """quantity x 2-decimal unit cost as an exact decimal."""
    return F.col(quantity).cast("decimal(18,0)") * F.col(unit_cost).cast("decimal(10,2)")


def order_headers(lines: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """One row per (period, supplier) -> item_count, total DECIMAL(18,2), total_quantity,
    first_sku, last_sku.  Pure aggregates, combined map-side."""
    return (lines.groupBy(period, "supplier_id")
            .agg(F.count(F.lit(1)).alias("item_count"),
                 money(F.sum(exact_line_cost())).alias("total"),
                 F.sum(F.col("quantity").cast("long")).alias("total_quantity"),
                 F.min("sku").alias("first_sku"), F.max("sku").alias("last_sku")))


def order_records(lines: DataFrame, period: str = DEFAULT_PERIOD, generated_at: Column | None = None) -> DataFrame:
    """Purchase orders as records: one ``order`` row per (period, supplier) and one ``item`` row per line.

    Item costs are rounded to cents; the order's total is the exact sum, rounded once.  Both kinds carry
    supplier, order date (data date + 1 day) and data date; columns of the other kind are NULL.
    """
    gen = generated_at if generated_at is not None else F.date_format(F.current_timestamp(),
                                                                       "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    data_date = F.col(period).cast("string")
    dates = [plus_days_text(data_date, 1).alias("order_date"), data_date.alias("data_date"), gen.alias("generated_at")]

    def none(name: str, kind: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    heads = (lines.groupBy(period, "supplier_id")
             .agg(F.min("supplier_name").alias("supplier_name"), F.min("contact_email").alias("contact_email"),
                  F.count(F.lit(1)).alias("item_count"),
                  money(F.sum(exact_line_cost())).cast("double").alias("total_estimated_cost")))
    sku_type = lines.schema["sku"].dataType.simpleString()
    orders = heads.select(period, F.lit("order").alias("record"), "supplier_id", "supplier_name", "contact_email", *dates,
                          "item_count", "total_estimated_cost", none("sku", sku_type), none("product_name", "string"),
                          none("quantity", "int"), none("unit_cost", "double"), none("total_cost", "double"))
    items = lines.select(period, F.lit("item").alias("record"), "supplier_id", "supplier_name", none("contact_email", "string"),
                         *dates, none("item_count", "bigint"), none("total_estimated_cost", "double"), "sku",
                         "product_name", "quantity", F.round("unit_cost", 2).alias("unit_cost"),
                         F.round("total_cost", 2).alias("total_cost"))
    return orders.unionByName(items)


def order_dates_shift(dates: DataFrame, date_col: str) -> DataFrame:
    """data_date and order_date = data_date + 1 day, both 'yyyy-MM-dd' text."""
    d = F.date_format(F.to_date(F.col(date_col)), "yyyy-MM-dd")
    return dates.select(d.alias("data_date")).distinct().select(
        "data_date", plus_days_text("data_date", 1).alias("order_date"))
