"""Driver contract and invariants of the pipeline tables at sf0.01."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from replenix.operators import orders as ords
from replenix.plans.views import Views

SF = "/root/testdata/sf0.01"


def test_entry_runs_on_smallest_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "final_order_qty" in df.columns


def test_net_demand_invariants(spark):
    net = Views(spark, SF).net
    bad = net.where(
        (F.col("final_order_qty") % F.col("pack_size") != 0)
        | (F.col("final_order_qty") < F.col("raw_demand"))
        | (F.col("final_order_qty") - F.col("raw_demand") >= F.col("pack_size"))
        | (F.col("final_order_qty") < F.col("moq")))
    assert bad.count() == 0
    assert net.groupBy("exec_year", "sku").count().where("count > 1").count() == 0


def test_one_supplier_per_sku_and_header_totals(spark):
    v = Views(spark, SF)
    assert v.preferred.groupBy("sku").count().where("count > 1").count() == 0
    h = ords.order_headers(v.lines, "exec_year")
    sums = v.lines.groupBy("exec_year", "supplier_id").agg(
        F.sum(ords.exact_line_cost()).cast("decimal(18,2)").alias("s"), F.count(F.lit(1)).alias("n"))
    j = h.join(sums, ["exec_year", "supplier_id"])
    assert j.count() == h.count()
    assert j.where((F.col("s") != F.col("total")) | (F.col("n") != F.col("item_count"))).count() == 0


def test_orders_have_one_layout_at_every_size(spark):
    v = Views(spark, SF)
    records = ords.order_records(v.lines, "exec_year", generated_at=F.lit("t"))
    heads, items = records.where("record = 'order'"), records.where("record = 'item'")
    assert items.count() == v.lines.count()
    assert heads.groupBy("exec_year", "supplier_id").count().where("count > 1").count() == 0
    counted = items.groupBy("exec_year", "supplier_id").agg(F.count(F.lit(1)).alias("n"))
    assert heads.join(counted, ["exec_year", "supplier_id"]).where("n = item_count").count() == heads.count()
