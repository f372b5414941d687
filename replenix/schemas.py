"""Declared schemas of every source and output (never inferred).

Types follow the reference tables: VARCHAR -> string, INTEGER -> int,
BIGINT -> long, DOUBLE -> double, DECIMAL(p,s) -> decimal(p,s).
"""

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# raw.orders as delivered by stores (one JSON array per store and day)
ORDERS = _st(("order_id", S), ("store_id", S), ("sku", S), ("quantity", I), ("timestamp", S))

# raw.inventory snapshot (CSV with header, one file per day)
INVENTORY = _st(("sku", S), ("available_stock", I), ("reserved_stock", I), ("warehouse", S))

# the same snapshot read as text, for the quality check that reports unparsable values
INVENTORY_TEXT = _st(("sku", S), ("available_stock", S), ("reserved_stock", S), ("warehouse", S))

# master data
PRODUCTS = _st(("sku", S), ("name", S), ("supplier_id", S), ("pack_size", I), ("moq", I),
               ("lead_time_days", I), ("safety_stock", I))
SUPPLIERS = _st(("supplier_id", S), ("name", S), ("contact_email", S), ("lead_time_days", I),
                ("reliability_score", T.DecimalType(3, 2)))
PRODUCT_SUPPLIERS = _st(("sku", S), ("supplier_id", S), ("unit_cost", T.DecimalType(10, 2)),
                        ("priority", I), ("is_preferred", B))

# fixed values: column defaults of the master tables (applied to absent columns only)
PRODUCT_DEFAULTS = {"pack_size": 1, "moq": 1, "lead_time_days": 1, "safety_stock": 0}
SUPPLIER_DEFAULTS = {"lead_time_days": 7, "reliability_score": "0.95"}
PRODUCT_SUPPLIER_DEFAULTS = {"unit_cost": "0", "priority": 1, "is_preferred": False}

# processed.net_demand, in table order (13 columns with the period)
NET_DEMAND_COLUMNS = ["sku", "supplier_id", "total_demand", "available_stock", "reserved_stock",
                      "safety_stock", "pack_size", "moq", "unit_cost", "raw_demand",
                      "final_order_qty", "estimated_cost"]

# purchase-order document, current format
ORDER_ITEM = _st(("sku", S), ("product_name", S), ("quantity", I), ("unit_cost", D),
                 ("total_cost", D))
ORDER_DOCUMENT = T.StructType([
    T.StructField("supplier_id", S), T.StructField("supplier_name", S),
    T.StructField("contact_email", S), T.StructField("order_date", S),
    T.StructField("data_date", S), T.StructField("generated_at", S),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("total_estimated_cost", D),
])
# purchase-order record as written: one "order" row per (date, supplier), one "item" row per product
ORDER_RECORD = _st(("record", S), ("supplier_id", S), ("supplier_name", S), ("contact_email", S), ("order_date", S),
                   ("data_date", S), ("generated_at", S), ("item_count", L), ("total_estimated_cost", D), ("sku", S),
                   ("product_name", S), ("quantity", I), ("unit_cost", D), ("total_cost", D))

# the quality report as written: its entries, and a summary row per date
REPORT_ENTRY = _st(("exec_date", S), ("seq", I), ("timestamp", S), ("level", S), ("check", S), ("message", S), ("detail", S))
REPORT_SUMMARY = _st(("exec_date", S), ("errors", L), ("warnings", L), ("infos", L), ("total", L))
