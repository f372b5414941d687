"""End-to-end run of the daily pipeline (B8) over the driver's data laid out as
the raw feed: the adapter order lines as JSON arrays per date / store (files of
at most 20,000 lines), the stock snapshot as one CSV folder per date, master data
from the adapter views.  Each period (year) becomes one day, 1992-01-01 + (year -
1992).  Runs the backfill over all days, then re-runs it, and prints the times.

    python tests/backfill_run.py [/root/testdata/sf0.1]

Everything is written below a fresh scratch folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from sample_data import split_groups  # noqa: E402
from replenix.plans import pipeline  # noqa: E402
from replenix.plans.views import Views  # noqa: E402
from replenix.session import build_session  # noqa: E402

FILE_ROWS = 20000


def day_of(period_col: str = "exec_year"):
    return F.date_format(F.date_add(F.to_date(F.lit("1992-01-01")), F.col(period_col) - 1992), "yyyy-MM-dd")


def lay_out(v: Views, base: str) -> list[str]:
    """Write raw/orders/<day>/**.json and raw/stock/<day>/*.csv; return the days."""
    feed = v.pos.select("order_id", "store_id", F.col("sku").cast("string").alias("sku"), "quantity",
                        F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                        day_of().alias("date"))
    feed = split_groups(feed, ["date", "store_id"], FILE_ROWS, by="order_id")
    arrays = (feed.groupBy("date", "store_id", "chunk")
              .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(F.to_json(F.struct(
                  "order_id", "store_id", "sku", "quantity", "timestamp")))), F.lit("]")).alias("value"))
              .select("date", F.col("store_id").alias("store"), "value"))
    (arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("date", "store")
     .text(f"{base}/stage_orders"))
    stock = v.inventory_text.select(F.col("sku").cast("string").alias("sku"), "available_stock", "reserved_stock",
                                    "warehouse", day_of().alias("date"))
    stock.write.mode("overwrite").option("header", True).partitionBy("date").csv(f"{base}/stage_stock")
    # Spark names folders date=<d> and text files *.txt; the feed has <d>/ and *.json
    days = []
    for kind, stage in (("orders", "stage_orders"), ("stock", "stage_stock")):
        os.makedirs(f"{base}/raw/{kind}", exist_ok=True)
        for d in os.listdir(f"{base}/{stage}"):
            if d.startswith("date="):
                os.rename(f"{base}/{stage}/{d}", f"{base}/raw/{kind}/{d[5:]}")
                days.append(d[5:])
    for root, _, names in os.walk(f"{base}/raw/orders"):
        for n in names:
            if n.endswith(".txt"):
                os.rename(f"{root}/{n}", f"{root}/{n[:-4]}.json")
    return sorted(set(days))


def main(argv: list[str]) -> None:
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    base = tempfile.mkdtemp(prefix="replenix-backfill-")
    spark = build_session()
    v = Views(spark, sf)
    t = time.perf_counter()
    days = lay_out(v, base)
    print(f"raw feed laid out in {time.perf_counter() - t:.1f} s: {len(days)} days, {days[0]} .. {days[-1]}")
    products = v.products.select(F.col("sku").cast("string").alias("sku"), "name", "pack_size", "moq",
                                 "safety_stock")
    cfg = pipeline.Config(
        orders_root=f"{base}/raw/orders", stock_root=f"{base}/raw/stock", out_base=f"{base}/out",
        products=products,
        suppliers=v.suppliers.select(F.col("supplier_id").cast("string").alias("supplier_id"), "name",
                                     "contact_email"),
        product_suppliers=v.product_suppliers.select(F.col("sku").cast("string").alias("sku"),
                                                     F.col("supplier_id").cast("string").alias("supplier_id"),
                                                     "unit_cost", "priority"),
        expected_stores=[f"STORE_{i}" for i in range(8)], expected_skus=products.select("sku"))
    for label in ("backfill", "re-run"):
        t = time.perf_counter()
        out = pipeline.run(spark, cfg, days[0], days[-1])
        print(f"{label}: {time.perf_counter() - t:.1f} s")
    print("net demand rows:", spark.read.parquet(f"{base}/out/processed/net_demand").count())
    out["summary"].orderBy("exec_date").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
