"""Rows of one task stay bounded when a table grows: more tasks and files, not larger ones."""

import os

from pyspark.sql import functions as F

from replenix.operators import suppliers
from replenix.plans import adapters
from replenix.sinks import layout


def test_stock_rows_of_a_large_part_table_are_dealt(spark, tmp_dir):
    n = 3 * adapters.PARTS_PER_TASK
    spark.range(n).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    (spark.createDataFrame([("1995-05-01",), ("1996-05-01",)], "d string")
     .select(F.col("d").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_dir}/lineitem.parquet"))
    rows = adapters.inventory(spark, tmp_dir)
    per_task = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("sku").alias("parts")).collect()
    assert max(r.parts for r in per_task) < 1.2 * adapters.PARTS_PER_TASK
    kept = n - len(range(0, n, 29))
    even = n // 2 - len(range(0, n, 58))
    assert rows.count() == 2 * (kept + even)


def test_clustered_files_grow_in_number(spark, tmp_dir):
    rows = spark.range(0, 9000, numPartitions=3).select(F.col("id").alias("sku"), (F.col("id") % 7).cast("int").alias("day"))
    layout.write_clustered(rows, f"{tmp_dir}/t", ["sku", "day"], files=2, file_rows=1000)
    assert sum(n.startswith("part-") for n in os.listdir(f"{tmp_dir}/t")) == 9
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/t").collect())) == [(i, i % 7) for i in range(9000)]


def test_order_lines_of_a_large_feed_are_dealt(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    few = {w: adapters.pos(spark, sf, w).drop("order_ts") for w in (True, False)}
    rows = {w: sorted(map(tuple, df.collect())) for w, df in few.items()}
    monkeypatch.setattr(adapters, "LINES_PER_TASK", 5000)
    for with_store, expected in rows.items():
        lines = adapters.pos(spark, sf, with_store).drop("order_ts")
        assert sorted(map(tuple, lines.collect())) == expected
        per_task = [r.n for r in lines.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
        assert len(per_task) == 12 and max(per_task) < 1.3 * 5000


def test_order_lines_are_dealt_before_suppliers_are_chosen(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    whole = adapters.product_suppliers(spark, sf)
    offers, best = (sorted(map(tuple, df.collect())) for df in (whole, suppliers.preferred_suppliers(whole)))
    monkeypatch.setattr(adapters, "LINES_PER_TASK", 5000)
    dealt = adapters.product_suppliers(spark, sf)
    chosen = suppliers.preferred_suppliers(dealt)
    assert sorted(map(tuple, dealt.collect())) == offers and sorted(map(tuple, chosen.collect())) == best
    assert "REPARTITION_BY_NUM" in chosen._jdf.queryExecution().executedPlan().toString()
    lines = adapters.dealt_lines(adapters.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey"))
    per_task = [r.n for r in lines.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 12 and max(per_task) < 1.3 * 5000
    # few rows are left for the tasks that put a part's shares together
    tasks = lines.select("l_partkey", F.spark_partition_id().alias("task")).distinct()
    shares = tasks.groupBy("l_partkey").count().agg(F.max("count")).first()[0]
    assert 1 < shares <= adapters.SUPPLIER_SHARES


def test_expected_parts_are_dealt(spark, tmp_dir):
    n = 3 * adapters.PARTS_PER_TASK
    spark.range(n).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    skus = adapters.expected_skus(spark, tmp_dir)
    per_task = [r.n for r in skus.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 1.2 * adapters.PARTS_PER_TASK and sum(per_task) == n
