"""Property tests: random small inputs, the Spark operators against a
brute-force computation in plain Python."""

import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from replenix.operators import mrp
from replenix.operators import suppliers as sup
from replenix.operators.ranking import balanced_row_number

P = "exec_date"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_mrp = st.lists(st.tuples(
    st.integers(0, 400),                          # total demand
    st.one_of(st.none(), st.integers(-5, 200)),   # available (None: no stock row)
    st.integers(0, 150),                          # reserved
    st.one_of(st.none(), st.integers(0, 60)),     # safety stock
    st.integers(0, 12),                           # pack size (0 allowed)
    st.integers(0, 40)), min_size=1, max_size=25)


def brute_mrp(total, avail, resv, safety, pack, moq):
    a, r = (avail or 0), (resv if avail is not None else 0)
    if safety is None:
        return None, None, False
    raw = max(0, total + safety - (a - r))
    final = None if pack == 0 else math.ceil(raw / pack) * pack
    keep = final is not None and final >= moq
    return raw, final, keep


@SETTINGS
@given(rows_mrp)
def test_mrp_matches_brute_force(spark, rows):
    demand = spark.createDataFrame([("d", f"S{i}", t) for i, (t, *_) in enumerate(rows)],
                                   "exec_date string, sku string, total_demand long")
    stock = spark.createDataFrame([("d", f"S{i}", a, r) for i, (_, a, r, *_) in enumerate(rows) if a is not None],
                                  "exec_date string, sku string, available_stock int, reserved_stock int")
    master = spark.createDataFrame([(f"S{i}", p, m, s, "X", 1.25) for i, (_, _, _, s, p, m) in enumerate(rows)],
                                   "sku string, pack_size int, moq int, safety_stock int, supplier_id string, unit_cost double")
    got = {r.sku: (r.raw_demand, r.final_order_qty) for r in mrp.pack_rounding(demand, stock, master, P).collect()}
    kept = {r.sku for r in mrp.net_demand(demand, stock, master, P).collect()}
    for i, row in enumerate(rows):
        raw, final, keep = brute_mrp(*row)
        assert got[f"S{i}"] == (raw, final)
        assert (f"S{i}" in kept) == keep


offers = st.lists(st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.integers(1, 30),                            # supplier number
    st.integers(1, 500),                           # cost in cents
    st.one_of(st.none(), st.integers(1, 3))), min_size=1, max_size=40, unique_by=lambda x: (x[0], x[1]))


@SETTINGS
@given(offers)
def test_supplier_ranking_matches_sort(spark, rows):
    df = spark.createDataFrame([(k, f"S{s:02d}", Decimal(c) / 100, p) for k, s, c, p in rows],
                               "sku string, supplier_id string, unit_cost decimal(10,2), priority int")
    got = {(r.sku, r.supplier_id): r.supplier_rank for r in sup.rank_suppliers(df).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == k),
                     key=lambda r: (r[3] is None, r[3] or 0, r[2], f"S{r[1]:02d}"))
        for rank, r in enumerate(grp, 1):
            want[(k, f"S{r[1]:02d}")] = rank
    assert got == want
    best = {r.sku: r.supplier_id for r in sup.preferred_suppliers(df).collect()}
    assert best == {k: s for (k, s), rank in want.items() if rank == 1}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=200),
       st.integers(1, 7))
def test_balanced_row_number_matches_sort(spark, rows, slices):
    df = spark.createDataFrame([(f"g{g}", v, i) for i, (g, v) in enumerate(rows)], "g string, v int, id int")
    got = {r.id: r.rn for r in balanced_row_number(df, ["g"], [F.col("v").asc(), F.col("id").asc()],
                                                   name="rn", num_slices=slices).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        ids = sorted((v, i) for i, (gg, v) in enumerate(rows) if gg == g)
        for n, (_, i) in enumerate(ids, 1):
            want[i] = n
    assert got == want


def _python_int(text):
    """What the source's check does with a stock value: int(), INTEGER range."""
    try:
        v = int(text)
    except ValueError:
        return None
    return v if -2**31 <= v < 2**31 else None


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789_+-. \tx", max_size=8), min_size=1, max_size=40))
def test_stock_value_parse_matches_python_int(spark, texts):
    from replenix.operators.quality import int_text
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r.i: r.n for r in df.select("i", int_text("v").alias("n")).collect()}
    assert got == {i: _python_int(t) for i, t in enumerate(texts)}
