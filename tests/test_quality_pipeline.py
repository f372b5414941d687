"""The daily run over files shaped like the reference's samples: goldens for
net demand, purchase-order documents and the two stored exception reports;
re-runs and run order; quality-check edge cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from replenix.functions.exprs import missing_keys
from replenix.operators import quality as qc
from replenix.plans import pipeline
from replenix.sources import files
from sample_data import (GOLDEN, PRODUCT_SUPPLIERS, PRODUCT_SUPPLIERS_SCHEMA, PRODUCTS, PRODUCTS_SCHEMA, SKUS,
                         STORES, SUPPLIERS, SUPPLIERS_SCHEMA, order_lines_for)

P = "exec_date"
CLOCK_TEXT = "2026-01-01T00:00:00"


def _write_inputs(root, dates=("2026-01-14",), stock_only=("2026-01-20",)):
    orders_root, stock_root = f"{root}/raw/orders", f"{root}/raw/stock"
    for d in dates:
        lines = []
        for _, s, n, total, *_ in [g for g in GOLDEN if g[0] == d]:
            lines += order_lines_for(d, s, n, total)
        os.makedirs(f"{orders_root}/{d}", exist_ok=True)
        for store in STORES:
            with open(f"{orders_root}/{d}/{store}.json", "w") as f:
                json.dump([x for x in lines if x["store_id"] == store], f, indent=2)
    for d in list(dates) + list(stock_only):
        os.makedirs(f"{stock_root}/{d}", exist_ok=True)
        rows = [g for g in GOLDEN if g[0] == d] or [(d, s, 0, 0, 50, 5) for s in SKUS]
        with open(f"{stock_root}/{d}/inventory.csv", "w") as f:
            f.write("sku,available_stock,reserved_stock,warehouse\n")
            for _, s, _, _, a, r, *_ in rows:
                f.write(f"{s},{a},{r},WH_MAIN\n")
    with open(f"{root}/products.json", "w") as f:
        json.dump([dict(zip(["sku", "name", "supplier_id", "pack_size", "moq", "lead_time_days", "safety_stock"], p))
                   for p in PRODUCTS], f, indent=2)
    return orders_root, stock_root


def _cfg(spark, root):
    orders_root, stock_root = f"{root}/raw/orders", f"{root}/raw/stock"
    return pipeline.Config(
        orders_root=orders_root, stock_root=stock_root, out_base=f"{root}/out",
        products=spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        suppliers=spark.createDataFrame(SUPPLIERS, SUPPLIERS_SCHEMA),
        product_suppliers=spark.createDataFrame(PRODUCT_SUPPLIERS, PRODUCT_SUPPLIERS_SCHEMA),
        products_json=f"{root}/products.json", expected_stores=STORES, expected_skus=SKUS)


def _summary(out, date):
    return {r[P]: (r.errors, r.warnings, r.infos, r.total) for r in out["summary"].collect()}[date]


def test_daily_run_goldens(spark, tmp_dir):
    _write_inputs(tmp_dir)
    cfg = _cfg(spark, tmp_dir)
    out = pipeline.run(spark, cfg, "2026-01-14", clock=F.lit(CLOCK_TEXT))
    net = {r.sku: (r.total_demand, r.raw_demand, r.final_order_qty, round(r.estimated_cost, 2))
           for r in out["net_demand"].collect()}
    assert net == {s: (t, raw, fin, float(c)) for d, s, _, t, _, _, raw, fin, c in GOLDEN if d == "2026-01-14"}
    # stored report of 2026-01-14: five INFO lines
    assert _summary(out, "2026-01-14") == (0, 0, 5, 5)
    rep = out["report"].select("seq", "level", "check").orderBy("seq").collect()
    assert [(r.level, r.check) for r in rep] == [("INFO", c) for c in qc.CHECKS]
    # purchase-order documents: read back, order date + 1, total = exact sum
    docs = files.read_order_documents(spark, f"{tmp_dir}/out/output/supplier_orders")
    got = {(r.supplier_id, r.sku): (r.quantity, r.total_cost, r.date, r.order_total_cost) for r in docs.collect()}
    assert got == {("SUP_001", "SKU_1001"): (120, 144.0, "2026-01-15", 144.0),
                   ("SUP_002", "SKU_1002"): (96, 81.6, "2026-01-15", 108.0),
                   ("SUP_002", "SKU_1003"): (24, 26.4, "2026-01-15", 108.0)}
    # report entries and summary written per date; run log appended; audit of the written partitions
    assert spark.read.json(f"{tmp_dir}/out/logs/exceptions").count() == 5
    log = spark.read.parquet(f"{tmp_dir}/out/run_log").collect()
    assert [(r.start_date, r.end_date, r.dates_with_orders, r.sku_count) for r in log] == \
        [("2026-01-14", "2026-01-14", 1, 3)]
    audit = {(r.table_name, r[P]): r.row_count for r in out["audit"].collect()}
    assert audit == {("aggregated_orders", "2026-01-14"): 3, ("net_demand", "2026-01-14"): 3}


def test_report_without_inputs(spark, tmp_dir):
    _write_inputs(tmp_dir)
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-03-16", clock=F.lit(CLOCK_TEXT))
    # stored report of 2026-03-16: two ERROR (no orders, no snapshot), one INFO; checks 4-5 silent
    assert _summary(out, "2026-03-16") == (2, 0, 1, 3)
    # a date with stock but no orders
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-20", clock=F.lit(CLOCK_TEXT))
    assert _summary(out, "2026-01-20") == (1, 0, 3, 4)


def test_store_presence_is_by_file_as_in_the_source(spark, tmp_dir):
    _write_inputs(tmp_dir)
    # a store that sent an empty file has delivered: check 1 stays INFO
    with open(f"{tmp_dir}/raw/orders/2026-01-14/STORE_03.json", "w") as f:
        f.write("[]")
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    rep = {(r.check, r.level) for r in out["report"].collect()}
    assert ("missing_pos_files", "INFO") in rep and ("missing_pos_files", "ERROR") not in rep
    # a date folder without any file: every expected store is missing, and check 4 runs
    os.makedirs(f"{tmp_dir}/raw/orders/2026-01-20")
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-20", clock=F.lit(CLOCK_TEXT))
    details = [(r.check, r.level, r.detail) for r in out["report"].collect()]
    assert sorted(d for c, lv, d in details if c == "missing_pos_files") == sorted(STORES)
    assert ("demand_spike", "INFO") in {(c, lv) for c, lv, _ in details}
    assert _summary(out, "2026-01-20") == (3, 0, 4, 7)


def test_snapshot_presence_is_by_file_as_in_the_source(spark, tmp_dir):
    _write_inputs(tmp_dir)
    # a snapshot file with only its header: present (check 2 INFO), every expected SKU missing
    with open(f"{tmp_dir}/raw/stock/2026-01-14/inventory.csv", "w") as f:
        f.write("sku,available_stock,reserved_stock,warehouse\n")
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    details = [(r.check, r.level, r.detail) for r in out["report"].collect()]
    assert ("missing_inventory", "INFO", "") in details
    assert sorted(d for c, lv, d in details if c == "inventory_inconsistency") == sorted(SKUS)
    assert {lv for c, lv, _ in details if c == "inventory_inconsistency"} == {"WARNING"}
    assert _summary(out, "2026-01-14") == (0, 3, 4, 7)


def test_rerun_and_backfill_are_idempotent(spark, tmp_dir):
    _write_inputs(tmp_dir, dates=("2026-01-13", "2026-01-14", "2026-01-16"))
    cfg = _cfg(spark, tmp_dir)
    pipeline.run(spark, cfg, "2026-01-13", "2026-01-16", clock=F.lit(CLOCK_TEXT))
    first = spark.read.parquet(f"{tmp_dir}/out/processed/net_demand").collect()
    pipeline.run(spark, cfg, "2026-01-14", clock=F.lit(CLOCK_TEXT))          # re-run one date
    pipeline.run(spark, cfg, "2026-01-16", clock=F.lit(CLOCK_TEXT))          # out of order
    pipeline.run(spark, cfg, "2026-01-13", "2026-01-16", clock=F.lit(CLOCK_TEXT))
    again = spark.read.parquet(f"{tmp_dir}/out/processed/net_demand").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert len(first) == 9
    # a date whose orders disappear is emptied, not left stale
    import shutil
    shutil.rmtree(f"{tmp_dir}/raw/orders/2026-01-16")
    pipeline.run(spark, cfg, "2026-01-16", clock=F.lit(CLOCK_TEXT))
    dates = {r[P] for r in spark.read.parquet(f"{tmp_dir}/out/processed/net_demand").select(P).collect()}
    assert dates == {"2026-01-13", "2026-01-14"}
    # ... and so are its purchase orders (no stale supplier document)
    docs = f"{tmp_dir}/out/output/supplier_orders"
    assert not os.path.exists(f"{docs}/date=2026-01-16") or os.listdir(f"{docs}/date=2026-01-16") == []
    assert os.listdir(f"{docs}/date=2026-01-14")


def test_quality_edge_cases(spark):
    orders = spark.createDataFrame(
        [("d1", "STORE_01", "A", 150), ("d1", "STORE_01", "A", 60), ("d1", "STORE_02", "B", None),
         ("d1", "STORE_03", "B", 1), ("d1", "STORE_09", "B", 1),               # extra store
         ("d2", "STORE_01", "A", 1)],                                          # two stores missing
        "exec_date string, store_id string, sku string, quantity int")
    found = qc.stores_found(orders, P)
    missing = {(r[P], r.store_id) for r in qc.missing_stores(found, STORES, P).collect()}
    assert missing == {("d2", "STORE_02"), ("d2", "STORE_03")}
    spikes = {(r[P], r.sku): r.total_demand for r in qc.demand_spikes(orders, 200, P).collect()}
    assert spikes == {("d1", "A"): 210}
    inv = spark.createDataFrame(
        [("d1", "A", "10", "20", "W"),        # reserved > available
         ("d1", "B", "-1", "5", "W"),         # both rules
         ("d1", "C", "-1", "-2", "W"),        # negative only
         ("d1", "D", " 7 ", "3", "W"),        # blanks parse
         ("d1", "E", "7x", "3", "W"),         # unparsable
         ("d1", "F", "1_000", "2", "W"),      # digit groups parse
         ("d1", "G", "1__0", "2", "W")],      # a double underscore does not
        "exec_date string, sku string, available_stock string, reserved_stock string, warehouse string")
    f = sorted((r.sku, r.level, r.rule) for r in qc.inventory_findings(qc.parsed_inventory(inv), P).collect())
    assert f == [("A", "WARNING", "reserved_gt_available"), ("B", "ERROR", "negative"),
                 ("B", "WARNING", "reserved_gt_available"), ("C", "ERROR", "negative"),
                 ("E", "ERROR", "invalid"), ("G", "ERROR", "invalid")]
    periods = spark.createDataFrame([("d1",), ("d2",)], "exec_date string")
    expected = spark.createDataFrame([("A",), ("B",)], "sku string")
    products = spark.createDataFrame([("A",), ("B",)], "sku string")
    pdocs = spark.createDataFrame([("A", '{"sku":"A","supplier_id":null,"pack_size":1,"moq":1,"safety_stock":0}'),
                                   ("B", '{"sku":"B","pack_size":1}')], "sku string, value string")
    counts = qc.report_counts(periods, orders, qc.parsed_inventory(inv), expected, products, pdocs, STORES, 200, P)
    s = {r[P]: (r.errors, r.warnings, r.infos) for r in qc.report_summary(counts, P).collect()}
    # d1: extra store -> no check-1 INFO; d2: no snapshot, stores missing
    assert s["d1"] == (0 + 0 + 1 + 4, 1 + 2, 1)   # spike A; reserved > available on A and B
    assert s["d2"] == (2 + 1 + 1, 0, 1)


def test_orders_rollup_matches_separate_aggregates_with_null_keys(spark):
    """The one-pass grouping-sets rollup gives the same stores and SKU totals as the
    two separate aggregates, with a NULL sku / store kept as its own group."""
    orders = spark.createDataFrame(
        [("d1", "STORE_01", "A", 150), ("d1", "STORE_01", "A", 60), ("d1", None, "A", 5),
         ("d1", "STORE_02", None, 300), ("d1", "STORE_02", None, None), ("d2", "STORE_01", "B", 1)],
        "exec_date string, store_id string, sku string, quantity int")
    from collections import Counter
    r = qc.orders_rollup(orders, P)
    stores = Counter(tuple(x) for x in qc.rollup_stores(r, P).collect())
    assert stores == Counter(tuple(x) for x in qc.stores_found(orders, P).collect())
    assert stores[("d1", None)] == 1
    spikes = Counter(tuple(x) for x in qc.rollup_spikes(r, 200, P).collect())
    assert spikes == Counter(tuple(x) for x in qc.demand_spikes(orders, 200, P).collect())
    assert spikes == Counter([("d1", None, 300), ("d1", "A", 215)])
    assert {(x.kind, x[P]) for x in r.collect()} == {("store", "d1"), ("sku", "d1"), ("store", "d2"), ("sku", "d2")}


def test_absent_sku_count_equals_the_rows(spark):
    """Check 5's count of expected SKUs missing from a snapshot (computed without
    pairing SKUs with periods) equals the number of absent-SKU rows, including a
    snapshot that holds no expected SKU at all."""
    inv = spark.createDataFrame(
        [("d1", "A", "1", "0", "W"), ("d1", "A", "2", "0", "V"), ("d1", "Z", "1", "0", "W"),
         ("d2", "Z", "5", "0", "W"),                       # only an unexpected SKU
         ("d3", "A", "x", "0", "W"), ("d3", "B", "1", "0", "W")],
        "exec_date string, sku string, available_stock string, reserved_stock string, warehouse string")
    parsed = qc.parsed_inventory(inv)
    expected = spark.createDataFrame([("A",), ("B",), ("B",), ("C",)], "sku string")
    orders = spark.createDataFrame([], "exec_date string, store_id string, sku string, quantity int")
    periods = spark.createDataFrame([("d1",), ("d2",), ("d3",), ("d4",)], "exec_date string")
    products = spark.createDataFrame([("A",)], "sku string")
    pdocs = spark.createDataFrame([], "sku string, value string")
    counts = {r[P]: (r.has_inventory, r.n_sku_absent) for r in
              qc.report_counts(periods, orders, parsed, expected, products, pdocs, STORES, 200, P).collect()}
    rows = {}
    for r in qc.skus_missing_in_inventory(expected, parsed, P).collect():
        rows[r[P]] = rows.get(r[P], 0) + 1
    assert counts == {"d1": (True, 2), "d2": (True, 3), "d3": (True, 1), "d4": (False, 0)}
    assert {d: n for d, (_, n) in counts.items() if n} == rows


def test_missing_keys_counts_null_value_as_present(spark):
    df = spark.createDataFrame([('{"a":null,"b":1}',), ('{"b":2}',), ("[1]",)], "v string")
    got = [r.m for r in df.select(missing_keys("v", ["a", "b"]).alias("m")).collect()]
    assert got == ["", "a", "a,b"]


def test_document_reader_both_formats_one_per_file(spark, tmp_dir):
    d = f"{tmp_dir}/output/2026-01-14"
    os.makedirs(d)
    with open(f"{d}/SUP_001.json", "w") as f:      # legacy list, supplier from the file name
        json.dump([{"sku": "SKU_1001", "quantity": 216}, {"sku": "SKU_1002"}], f, indent=2)
    with open(f"{d}/SUP_002.json", "w") as f:      # current format, pretty-printed
        json.dump({"supplier_id": "SUP_002", "supplier_name": "DairyMax Ltd", "order_date": "2026-01-15",
                   "data_date": "2026-01-14", "items": [{"sku": "SKU_1002", "product_name": "Milk 1L",
                                                         "quantity": 48, "unit_cost": 0.85, "total_cost": 40.8}],
                   "total_estimated_cost": 40.8}, f, indent=2)
    with open(f"{d}/notes.txt", "w") as f:
        f.write("not a document")
    rows = sorted(tuple(r) for r in files.read_order_documents(spark, f"{tmp_dir}/output")
                  .select("date", "data_date", "supplier_id", "supplier_name", "sku", "product_name", "quantity",
                          "unit_cost", "order_total_cost").collect())
    assert rows == [
        ("2026-01-14", "2026-01-14", "SUP_001", "SUP_001", "SKU_1001", "SKU_1001", 216, 0.0, 0.0),
        ("2026-01-14", "2026-01-14", "SUP_001", "SUP_001", "SKU_1002", "SKU_1002", 0, 0.0, 0.0),
        ("2026-01-15", "2026-01-14", "SUP_002", "DairyMax Ltd", "SKU_1002", "Milk 1L", 48, 0.85, 40.8),
    ]


def test_iso_timestamp_parse(spark):
    from replenix.functions.exprs import parse_iso_ts
    df = spark.createDataFrame([("2026-01-14T22:05:12.483000Z",), ("2026-01-14T22:05:12",), ("garbage",), (None,)],
                               "t string")
    got = [r.ts for r in df.select(parse_iso_ts("t").alias("ts")).collect()]
    assert got[0] is not None and got[1] is not None and got[2] is None and got[3] is None


def test_product_file_with_missing_field(spark, tmp_dir):
    _write_inputs(tmp_dir)
    prods = [dict(zip(["sku", "name", "supplier_id", "pack_size", "moq", "lead_time_days", "safety_stock"], p))
             for p in PRODUCTS]
    del prods[2]["safety_stock"]                   # key absent, not null
    prods[1]["moq"] = None                         # key present with null: not reported
    with open(f"{tmp_dir}/products.json", "w") as f:
        json.dump(prods, f, indent=2)
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    assert _summary(out, "2026-01-14") == (1, 0, 4, 5)
    rep = {(r.check, r.level, r.detail) for r in out["report"].collect()}
    assert ("missing_supplier_mapping", "ERROR", "safety_stock") in rep


def test_command_line_run(spark, tmp_dir, capsys):
    _write_inputs(tmp_dir, dates=("2026-01-13", "2026-01-14"))
    with open(f"{tmp_dir}/suppliers.json", "w") as f:
        json.dump([dict(zip(["supplier_id", "name", "contact_email"], s)) for s in SUPPLIERS], f)
    with open(f"{tmp_dir}/product_suppliers.csv", "w") as f:
        f.write("sku,supplier_id,unit_cost,priority,is_preferred\n")
        for sku, sid, cost, prio, pref in PRODUCT_SUPPLIERS:
            f.write(f"{sku},{sid},{cost},{prio},{str(pref).lower()}\n")
    pipeline.main(["--data", tmp_dir, "--out", f"{tmp_dir}/out", "--products", f"{tmp_dir}/products.json",
                   "--suppliers", f"{tmp_dir}/suppliers.json", "--product-suppliers",
                   f"{tmp_dir}/product_suppliers.csv", "--start", "2026-01-13", "--end", "2026-01-14",
                   "--stores", ",".join(STORES)])
    net = {(r[P], r.sku): r.final_order_qty for r in spark.read.parquet(f"{tmp_dir}/out/processed/net_demand").collect()}
    assert net == {(d, s): fin for d, s, _, _, _, _, _, fin, _ in GOLDEN if d in ("2026-01-13", "2026-01-14")}
    summ = {r[P]: (r.errors, r.warnings, r.infos) for r in spark.read.json(f"{tmp_dir}/out/logs/summary").collect()}
    assert summ == {"2026-01-13": (0, 0, 5), "2026-01-14": (0, 0, 5)}


def test_freshness_of_pipeline_outputs(spark, tmp_dir):
    from replenix.operators import reports as rep
    _write_inputs(tmp_dir)
    cfg = _cfg(spark, tmp_dir)
    base = f"{tmp_dir}/out"

    def status():
        data = [rep.newest_file_time(spark, f"{base}/processed/net_demand"),
                rep.newest_file_time(spark, f"{base}/output/supplier_orders", fmt="json")]
        return rep.pipeline_freshness(spark, spark.read.parquet(f"{base}/run_log"), data).first().status

    pipeline.run(spark, cfg, "2026-01-14")                          # marker written after the data
    assert status() == "ok"
    pipeline.run(spark, cfg, "2026-01-14", clock=F.lit("2000-01-01T00:00:00"))   # only an old marker
    import shutil
    shutil.rmtree(f"{base}/run_log")
    spark.createDataFrame([("2000-01-01T00:00:00",)], "run_at string").write.parquet(f"{base}/run_log")
    assert status() == "stale"
