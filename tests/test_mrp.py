"""Net demand, pack rounding, MOQ and supplier choice on literal inputs,
including every NULL / ordering trap."""

from decimal import Decimal

from pyspark.sql import Window, functions as F

from replenix.operators import demand as dem
from replenix.operators import mrp
from replenix.operators import suppliers as sup
from replenix.operators.ranking import balanced_row_number
from sample_data import GOLDEN, PRODUCT_SUPPLIERS, PRODUCT_SUPPLIERS_SCHEMA, PRODUCTS, PRODUCTS_SCHEMA

P = "exec_date"


def _master(spark):
    products = spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA)
    ps = spark.createDataFrame(PRODUCT_SUPPLIERS, PRODUCT_SUPPLIERS_SCHEMA)
    return sup.supplier_master(products, sup.preferred_suppliers(ps))


def test_net_demand_matches_golden(spark):
    demand = spark.createDataFrame([(d, s, t) for d, s, _, t, *_ in GOLDEN],
                                   "exec_date string, sku string, total_demand long")
    inv = spark.createDataFrame([(d, s, a, r, "WH_MAIN") for d, s, _, _, a, r, *_ in GOLDEN],
                                "exec_date string, sku string, available_stock int, reserved_stock int, warehouse string")
    net = mrp.net_demand(demand, dem.inventory_by_sku(inv, P), _master(spark), P)
    got = {(r.exec_date, r.sku): (r.raw_demand, r.final_order_qty, round(r.estimated_cost, 2))
           for r in net.collect()}
    want = {(d, s): (raw, fin, float(cost)) for d, s, _, _, _, _, raw, fin, cost in GOLDEN}
    assert got == want
    assert net.columns == ["sku", "supplier_id", "total_demand", "available_stock", "reserved_stock",
                           "safety_stock", "pack_size", "moq", "unit_cost", "raw_demand", "final_order_qty",
                           "estimated_cost", P]


def _one(spark, total, avail, resv, safety, pack, moq, with_stock=True):
    demand = spark.createDataFrame([("d", "A", total)], "exec_date string, sku string, total_demand long")
    stock_rows = [("d", "A", avail, resv)] if with_stock else []
    stock = spark.createDataFrame(stock_rows, "exec_date string, sku string, available_stock int, reserved_stock int")
    master = spark.createDataFrame([("A", pack, moq, safety, "S", 1.5)],
                                   "sku string, pack_size int, moq int, safety_stock int, supplier_id string, unit_cost double")
    return mrp.pack_rounding(demand, stock, master, P), mrp.net_demand(demand, stock, master, P)


def test_null_safety_stock_gives_null_not_zero(spark):
    r, n = _one(spark, 100, 10, 0, None, 6, 6)
    row = r.first()
    assert row.raw_demand is None and row.final_order_qty is None
    assert n.count() == 0


def test_demand_covered_by_stock_gives_zero_and_is_dropped(spark):
    r, n = _one(spark, 5, 100, 0, 0, 6, 6)
    assert r.first().raw_demand == 0 and r.first().final_order_qty == 0
    assert n.count() == 0


def test_rounding_to_pack_and_invariants(spark):
    r, n = _one(spark, 25, 10, 3, 4, 6, 6)     # 25 + 4 - 7 = 22 -> 24
    row = n.first()
    assert (row.raw_demand, row.final_order_qty, row.estimated_cost) == (22, 24, 36.0)


def test_pack_zero_gives_null_without_error(spark):
    r, n = _one(spark, 25, 0, 0, 0, 0, 1)
    assert r.first().final_order_qty is None and n.count() == 0


def test_below_moq_is_dropped_not_raised(spark):
    r, n = _one(spark, 5, 0, 0, 0, 6, 18)
    assert n.count() == 0
    b = mrp.below_moq(r, P).first()
    assert (b.final_order_qty, b.moq) == (6, 18)


def test_missing_inventory_counts_as_zero_stock(spark):
    r, n = _one(spark, 10, None, None, 2, 4, 4, with_stock=False)
    row = n.first()
    assert (row.available_stock, row.reserved_stock, row.raw_demand, row.final_order_qty) == (0, 0, 12, 12)


def test_supplier_rank_nulls_last_and_ties(spark):
    ps = spark.createDataFrame([
        ("A", "S3", Decimal("1.00"), None),
        ("A", "S2", Decimal("2.00"), 1),
        ("A", "S1", Decimal("2.00"), 1),     # tie on priority and cost -> supplier_id
        ("A", "S4", Decimal("0.50"), 2),
        ("B", "S9", Decimal("0.10"), None),  # only NULL priorities
        ("B", "S8", Decimal("0.20"), None),
    ], "sku string, supplier_id string, unit_cost decimal(10,2), priority int")
    ranked = {(r.sku, r.supplier_id): r.supplier_rank for r in sup.rank_suppliers(ps).collect()}
    assert ranked == {("A", "S1"): 1, ("A", "S2"): 2, ("A", "S4"): 3, ("A", "S3"): 4,
                      ("B", "S9"): 1, ("B", "S8"): 2}
    best = {r.sku: (r.supplier_id, r.unit_cost) for r in sup.preferred_suppliers(ps).collect()}
    assert best == {"A": ("S1", 2.0), "B": ("S9", 0.1)}


def test_balanced_row_number_equals_window_on_hot_group(spark):
    # one group holds most rows
    rows = spark.range(0, 30000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        ((F.col("id") * 7919) % 100003).alias("v"), F.col("id"))
    order = [F.col("v").asc(), F.col("id").asc()]
    got = balanced_row_number(rows, ["k"], order, name="rn", num_slices=6)
    want = rows.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert got.select("k", "id", "rn").exceptAll(want.select("k", "id", "rn")).count() == 0
    assert got.count() == 30000


def test_split_groups_cuts_only_large_groups(spark):
    from sample_data import split_groups
    rows = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").cast("string").alias("rid"))
    out = split_groups(rows, ["k"], 1000, by="rid")
    sizes = out.groupBy("k", "chunk").count()
    hot = sizes.where("k = 'hot'").collect()
    assert len(hot) == 15 and max(r["count"] for r in hot) == 1000
    assert sizes.where("k <> 'hot'").agg(F.max("chunk")).first()[0] == 0
    assert out.count() == 20000
