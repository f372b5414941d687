"""Versions, digests, audited loads, incremental state, filters and layouts."""

import contextlib
import io
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from replenix.functions.exprs import round_half_even
from replenix.operators import audit, bloom, incremental, mrp
from replenix.operators import suppliers as sup
from replenix.plans import queries as Q
from replenix.plans.views import Views
from replenix.sinks import digest, snapshots
from replenix.streaming import latest

SF = "/root/testdata/sf0.001"


def _table(spark, rows):
    return spark.createDataFrame(rows, "sku string, n int, day string")


def _seen(spark, base, like, at=None):
    return {t: sorted(tuple(r) for r in snapshots.read(spark, base, t, like.schema, "day", at).collect()) for t in ("one", "two")}


def test_a_run_that_stops_between_two_tables_changes_nothing(spark, tmp_dir):
    first = _table(spark, [("A", 1, "d1"), ("B", 2, "d2")])
    snapshots.publish(spark, tmp_dir, {"one": first, "two": first}, "day")
    before = _seen(spark, tmp_dir, first)
    changed = first.withColumn("n", F.col("n") + 1)
    damaged = first.withColumn("n", F.raise_error(F.lit("stopped")).cast("int"))
    with pytest.raises(Exception, match="stopped"):
        snapshots.publish(spark, tmp_dir, {"one": changed, "two": damaged}, "day")
    assert _seen(spark, tmp_dir, first) == before and snapshots.versions(spark, tmp_dir) == [1]
    snapshots.publish(spark, tmp_dir, {"one": changed.where("day = 'd2'"), "two": changed.where("day = 'd1'")}, "day", ["d1", "d2"])
    assert _seen(spark, tmp_dir, first) == {"one": [("B", 3, "d2")], "two": [("A", 2, "d1")]}
    assert _seen(spark, tmp_dir, first, 1) == before     # a pinned reader
    assert len(snapshots.vacuum(spark, tmp_dir)) == 3    # the stopped run's folder and the two of version 1
    assert _seen(spark, tmp_dir, first) == {"one": [("B", 3, "d2")], "two": [("A", 2, "d1")]}
    assert snapshots.read(spark, tmp_dir, "absent", first.schema, "day").isEmpty()


def test_two_writers(spark, tmp_dir):
    """Different periods both get through; the same one does not; an abandoned number is given back."""
    one = _table(spark, [("A", 1, "d1")])
    based_on = snapshots.version(spark, tmp_dir)
    mine = {"one": snapshots.stage(one, tmp_dir, "one", "day")}
    other = {"one": snapshots.stage(one.withColumn("day", F.lit("d2")), tmp_dir, "one", "day")}
    again = {"one": snapshots.stage(one.withColumn("n", F.lit(9)), tmp_dir, "one", "day")}
    assert snapshots.commit(spark, tmp_dir, mine, based_on).number == 1
    assert snapshots.commit(spark, tmp_dir, other, based_on).number == 2
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, tmp_dir, again, based_on)
    assert sorted(r.day for r in snapshots.read(spark, tmp_dir, "one", one.schema, "day").collect()) == ["d1", "d2"]
    assert snapshots._put_if_absent(spark, snapshots._log(tmp_dir, 3, "claim"))     # a writer that then stops
    now = snapshots.version(spark, tmp_dir)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, tmp_dir, again, now)
    assert not snapshots.abandon(spark, tmp_dir, 2) and snapshots.abandon(spark, tmp_dir, 3)
    assert snapshots.commit(spark, tmp_dir, again, now).number == 3


def test_digests_tell_contents_apart(spark):
    rows = [("A", 1, "d1"), ("A", 1, "d1"), (None, 11, "d1"), ("A1", None, "d2"), ("", 3, "d2")]
    df = _table(spark, rows)

    def of(rows_):
        return {r.day: (r.row_count, r.digest) for r in digest.content_digest(_table(spark, rows_), "day").collect()}

    assert of(rows) == of(rows[::-1])
    for k, other in ((0, ("A", 2, "d1")), (1, (None, 11, "d1")), (2, ("", 11, "d1")), (3, ("A", 1, "d2")), (4, (None, 3, "d2"))):
        changed = [*rows[:k], other, *rows[k + 1:]]
        assert of(changed)[other[2]] != of(rows)[other[2]], other
    same, moved = {"t": df}, {"t": _table(spark, [*rows[:4], ("", 4, "d2")])}
    assert digest.differences(same, same, "day").isEmpty()
    assert [tuple(r) for r in digest.differences(same, moved, "day").collect()] == [("t", "d2")]


def test_a_violating_load_leaves_the_table_unchanged(spark, tmp_dir):
    parents = spark.createDataFrame([("P1",), ("P2",)], "p string")
    rules = audit.Constraints(["k"], ["name"], [("p", parents, "unknown_parent")])
    schema = "k int, name string, p string"
    good = spark.createDataFrame([(1, "a", "P1"), (2, "b", None)], schema)
    done, found = audit.audited_load(spark, f"{tmp_dir}/t", "m", good, rules, f"{tmp_dir}/r1")
    assert done.number == 1 and found.isEmpty()
    bad = spark.createDataFrame([(1, "a", "P9"), (1, "x", "P1"), (3, None, "P2")], schema)
    done, found = audit.audited_load(spark, f"{tmp_dir}/t", "m", bad, rules, f"{tmp_dir}/r2")
    assert done is None
    assert sorted(tuple(r) for r in found.collect()) == [(1, "duplicate_key", "k"), (1, "unknown_parent", "p"), (3, "null", "name")]
    assert sorted(tuple(r) for r in audit.read_master(spark, f"{tmp_dir}/t", "m", good.schema).collect()) == [(1, "a", "P1"), (2, "b", None)]


def test_merged_changes_equal_a_full_run(spark):
    rng = random.Random(4)
    lines = [(f"S{rng.randrange(12)}", rng.randrange(1, 9), rng.choice("ab")) for _ in range(200)]
    prices = [(f"S{k}", f"V{s}", (k * 7 + s * 5) % 13 + 1, rng.choice([None, 1, 2])) for k in range(12) for s in range(3)]
    products = spark.createDataFrame([(f"S{k}", 3, 4, 2) for k in range(11)], "sku string, pack_size int, moq int, safety_stock int")
    stock = incremental.stock_state(spark.createDataFrame(
        [("a", f"S{k}", 5, 1) for k in range(12)], "p string, sku string, available_stock int, reserved_stock int"), "p")
    as_stock = stock.select("p", "sku", *[F.col(c).cast("int").alias(c) for c in ("available_stock", "reserved_stock")])

    def frame(rows, *more):
        return spark.createDataFrame(rows, ", ".join(["sku string, quantity int, p string", *more]))

    def price(rows):
        return spark.createDataFrame(rows, "sku string, supplier_id string, unit_cost int, priority int")

    def full(lines_, prices_):
        master = sup.supplier_master(products, sup.preferred_suppliers(price(prices_)))
        return mrp.net_demand(incremental.demand_state(frame(lines_), "p").drop(incremental.LINES), as_stock, master, "p")

    removed = [x for x in lines if x[0] == "S3"] + lines[:10]       # a SKU goes whole
    after = list(lines)
    for x in removed:
        if x in after:
            after.remove(x)
    gone = [x for x in lines]
    for x in after:
        gone.remove(x)
    new_prices = [p for p in prices if p[1] != "V0"] + [("S5", "V9", 1, 1)]
    state, change = incremental.demand_state(frame(lines), "p"), incremental.demand_state(
        frame([(*x, -1) for x in gone] + [("S1", 500, "b", 1)], "sign int"), "p", "sign")
    merged = incremental.merge(state, change, ["p", "sku"])
    changed = price([p for p in prices if p[1] == "V0"] + [("S5", "V9", 1, 1)])
    preferred = incremental.merge_preferred(sup.preferred_suppliers(price(prices)), price(new_prices), changed)
    net = incremental.merge_net(full(lines, prices), merged, stock, sup.supplier_master(products, preferred),
                                incremental.touched(change, columns=["p", "sku"]), changed, "p")
    assert sorted(map(tuple, net.collect())) == sorted(map(tuple, full([*after, ("S1", 500, "b")], new_prices).collect()))


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_maintenance_reads_no_facts(spark):
    plan = _plan(Q.QUERIES["net_demand_incremental"](Views(spark, SF)))
    scans = [line for line in plan.splitlines() if "Location:" in line]
    assert scans and not [line for line in scans if "lineitem.parquet" in line or "orders.parquet" in line]


def test_bucketed_join_has_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(Q.QUERIES["bucketed_order_lines"](Views(spark, SF)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_filter_never_loses_a_key(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    known = bloom.build(keys, "k", 0.01)
    told = {r.k: r.m for r in spark.range(6000).withColumnRenamed("id", "k").select("k", known.may_hold("k").alias("m")).collect()}
    assert all(told[k] for k in range(0, 3000, 3))
    wrong = sum(told[k] for k in range(6000) if k >= 3000 or k % 3)
    assert wrong < 0.03 * 5000
    nothing = bloom.build(spark.range(0).withColumnRenamed("id", "k"), "k")
    assert not any(r.m for r in spark.range(50).select(nothing.may_hold("id").alias("m")).collect())
    assert spark.createDataFrame([(None,)], "k long").select(known.may_hold("k").alias("m")).first().m is None


def test_filter_settles_most_unknown_skus(spark):
    """Demand whose SKU is no product does not reach the joins."""
    demand = spark.createDataFrame([(1, k, 5) for k in range(2000)], "p int, sku long, total_demand long")
    known = bloom.build(spark.range(100).withColumnRenamed("id", "sku"), "sku")
    assert demand.where(known.may_hold("sku")).count() < 100 + 0.03 * 1900


def test_a_guard_too_large_is_not_built(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", 64)
    assert bloom.build(spark.range(100).withColumnRenamed("id", "k"), "k") is None
    v = Views(spark, SF)
    args = (v.demand, v.stock, v.products, v.preferred, v.suppliers, "exec_year")
    assert bloom.dropped_skus(*args).exceptAll(mrp.dropped_skus(*args)).isEmpty()


EDGE = [0.0, -0.0, 0.5, 1.5, 2.5, -0.5, 0.125, 0.375, -0.125, 0.005, 0.015, 2.675, 1.005, 1e-300, 0.004999999999999999, 0.00499, 0.0005,
        0.0015, 4503599627370495.5, 4503599627370496.5, 1e16, 1e300, 90071992547409.925, 123456789012.345, math.inf, -math.inf, 0.49999999999999994]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False), st.floats(-1e6, 1e6), st.integers(-10**7, 10**7).map(lambda n: n / 1000),
                          st.integers(-10**6, 10**6).map(lambda n: n / 8)), min_size=150, max_size=300))
def test_round_half_even(spark, values):
    values = values + EDGE
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", *[round_half_even("x", d).alias(f"d{d}") for d in range(4)]).collect():
        for d in range(4):
            want = r.x if math.isinf(r.x) else float(round(r.x, d))
            assert r[f"d{d}"] == want, (r.x, d)


def test_rounding_of_no_number(spark):
    df = spark.createDataFrame([(None,), (math.nan,)], "x double").select(round_half_even("x").alias("r"))
    assert [r.r is None or math.isnan(r.r) for r in df.collect()] == [True, True]


def test_latest_survives_restart_and_late_files(spark, tmp_dir):
    schema = "sku string, n int, day int"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
        latest.keep_latest(latest.latest_stream(stream, "sku", ["day", "n"]), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
        like = spark.createDataFrame([], schema).schema
        return sorted(tuple(r) for r in latest.read_latest(spark, f"{tmp_dir}/out", like, "sku", ["day", "n"]).collect())

    arrive([("A", 1, 5), ("B", 1, 5), ("B", 2, 5)])
    assert run() == [("A", 1, 5), ("B", 2, 5)]
    arrive([("A", 9, 4), ("C", 1, 1)])          # late for A
    arrive([("A", 1, 5), ("B", 0, 6)])          # A again
    assert run() == [("A", 1, 5), ("B", 0, 6), ("C", 1, 1)]
    assert run() == [("A", 1, 5), ("B", 0, 6), ("C", 1, 1)]     # nothing new


def test_registered():
    new = {"scan_orders_json_split", "snapshot_publish", "archive_digest", "audited_master_load", "net_demand_incremental",
           "round_half_even", "stream_latest_per_sku", "dropped_skus_bloom", "bucketed_order_lines"}
    assert new <= set(E.queries()) and new <= set(E.oracle_sql())
