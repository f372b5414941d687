"""Small literal copies of the reference's sample inputs and of goldens
computed from them (see FIXTURES.md F)."""

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from replenix.operators.ranking import balanced_row_number

PRODUCTS = [  # sku, name, supplier_id, pack_size, moq, lead_time_days, safety_stock
    ("SKU_1001", "Bananas", "SUP_001", 12, 24, 2, 50),
    ("SKU_1002", "Milk 1L", "SUP_002", 6, 18, 1, 30),
    ("SKU_1003", "Yogurt", "SUP_002", 8, 16, 2, 20),
]
PRODUCTS_SCHEMA = ("sku string, name string, supplier_id string, pack_size int, moq int, "
                   "lead_time_days int, safety_stock int")

SUPPLIERS = [  # supplier_id, name, contact_email
    ("SUP_001", "FreshFruit Co", "orders@freshfruit.com"),
    ("SUP_002", "DairyMax Ltd", "procure@dairymax.com"),
    ("SUP_003", "BioFarm Ltd", "bio@biofarm.com"),
]
SUPPLIERS_SCHEMA = "supplier_id string, name string, contact_email string"

PRODUCT_SUPPLIERS = [  # sku, supplier_id, unit_cost, priority, is_preferred
    ("SKU_1001", "SUP_001", Decimal("1.20"), 1, True),
    ("SKU_1001", "SUP_003", Decimal("1.45"), 2, False),
    ("SKU_1002", "SUP_002", Decimal("0.85"), 1, True),
    ("SKU_1003", "SUP_002", Decimal("1.10"), 1, True),
]
PRODUCT_SUPPLIERS_SCHEMA = "sku string, supplier_id string, unit_cost decimal(10,2), priority int, is_preferred boolean"

# exec_date, sku, order lines, total_demand, available, reserved, raw_demand, final_order_qty, estimated_cost
GOLDEN = [
    ("2026-01-13", "SKU_1001", 16, 89, 44, 11, 106, 108, "129.60"),
    ("2026-01-13", "SKU_1002", 17, 102, 119, 13, 26, 30, "25.50"),
    ("2026-01-13", "SKU_1003", 25, 120, 81, 20, 79, 80, "88.00"),
    ("2026-01-14", "SKU_1001", 21, 118, 61, 11, 118, 120, "144.00"),
    ("2026-01-14", "SKU_1002", 17, 91, 44, 19, 96, 96, "81.60"),
    ("2026-01-14", "SKU_1003", 15, 88, 102, 13, 19, 24, "26.40"),
    ("2026-01-16", "SKU_1001", 17, 91, 67, 8, 82, 84, "100.80"),
    ("2026-01-16", "SKU_1002", 15, 75, 78, 19, 46, 48, "40.80"),
    ("2026-01-16", "SKU_1003", 22, 129, 112, 24, 61, 64, "70.40"),
    ("2026-02-14", "SKU_1001", 36, 188, 92, 17, 163, 168, "201.60"),
    ("2026-02-14", "SKU_1002", 18, 82, 81, 19, 50, 54, "45.90"),
    ("2026-02-14", "SKU_1003", 17, 85, 54, 20, 71, 72, "79.20"),
    ("2026-03-15", "SKU_1001", 18, 102, 83, 12, 81, 84, "100.80"),
    ("2026-03-15", "SKU_1002", 15, 70, 65, 6, 41, 42, "35.70"),
    ("2026-03-15", "SKU_1003", 32, 172, 48, 22, 166, 168, "184.80"),
]

STORES = ["STORE_01", "STORE_02", "STORE_03"]
SKUS = ["SKU_1001", "SKU_1002", "SKU_1003"]


def order_lines_for(date, sku, n_lines, total, start=0):
    """n_lines order lines of one SKU summing to ``total``, spread over the 3 stores."""
    base, extra = divmod(total, n_lines)
    out = []
    for i in range(n_lines):
        q = base + (1 if i < extra else 0)
        store = STORES[i % 3]
        out.append({"order_id": f"{date}-{sku}-{start + i}", "store_id": store, "sku": sku, "quantity": q,
                    "timestamp": f"{date}T10:00:{i % 60:02d}.000000"})
    return out


def split_groups(df: DataFrame, keys: list[str], max_rows: int, by: str, name: str = "chunk") -> DataFrame:
    """Add a ``chunk`` number so that every (keys, chunk) group holds at most
    ``max_rows`` rows: rows are numbered within their group in ``by`` order
    (balanced numbering, so a hot group is cut over many tasks) and chunk
    ``c`` takes rows ``c * max_rows + 1 … (c + 1) * max_rows``.  Groups of at
    most ``max_rows`` rows stay whole (chunk 0).  Nothing about the groups is
    gathered or broadcast: the only per-group state is one count per (group,
    slice).
    """
    numbered = balanced_row_number(df, keys, [F.col(by).asc_nulls_last()], name="_rn")
    return (numbered.withColumn(name, F.floor((F.col("_rn") - 1) / F.lit(max_rows)).cast("long"))
            .drop("_rn"))
