"""Delivery layouts that must not lose a record, and what a run leaves behind."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from replenix import schemas
from replenix.operators import suppliers as sup
from replenix.plans import pipeline
from replenix.session import checkpoint_root
from replenix.sources import files
from replenix.streaming import ingest as stream_ingest
from test_quality_pipeline import CLOCK_TEXT, _cfg, _write_inputs


def _order(i, store="S1", sku="A", quantity=2):
    return {"order_id": str(i), "store_id": store, "sku": sku, "quantity": quantity, "timestamp": "t"}


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _ids(df):
    return sorted(r.order_id for r in df.collect())


def test_json_lines_arrays_and_objects_side_by_side(spark, tmp_dir):
    day = f"{tmp_dir}/2026-01-14"
    _put(f"{day}/S1.json", "\n".join(json.dumps(_order(i)) for i in range(10)))
    _put(f"{day}/S2.json", json.dumps([_order(i) for i in range(10, 13)], indent=2))
    _put(f"{day}/S3.json", json.dumps([_order(13), _order(14)]))
    _put(f"{day}/S4.json", json.dumps(_order(15), indent=2))
    _put(f"{day}/S5.json", json.dumps(_order(16)) + '\n{"order_id": "broken\n' + json.dumps(_order(17)))
    _put(f"{day}/S6.json", '{"order_id": "cut\n' + json.dumps(_order(18)) + "\n" + json.dumps(_order(19)))
    _put(f"{day}/S7.json", "")
    rows, rejects = files.ingest_directory(spark, tmp_dir, schemas.ORDERS)
    assert _ids(rows) == sorted(str(i) for i in range(20))
    assert sorted(r.source_file for r in rejects.collect()) == ["S5", "S6"]


def test_the_last_date_folder_counts_and_undated_records_are_rejected(spark, tmp_dir):
    _put(f"{tmp_dir}/export-2026-03-01/raw/2025-12-31/2026-01-14/S1.json", json.dumps(_order(1)))
    _put(f"{tmp_dir}/export-2026-03-01/raw/S2.json", json.dumps(_order(2)))
    rows, rejects = files.ingest_directory(spark, tmp_dir, schemas.ORDERS)
    assert [(r.order_id, r.exec_date) for r in rows.collect()] == [("1", "2026-01-14")]
    assert [(r.exec_date, r.source_file, json.loads(r.record)["order_id"]) for r in rejects.collect()] == [("", "S2", "2")]


def test_csv_columns_by_header_name(spark, tmp_dir):
    _put(f"{tmp_dir}/2026-01-14/inventory.csv", "sku,reserved_stock,available_stock,warehouse,note\nA,11,44,W,x\nB,1\n")
    _put(f"{tmp_dir}/2026-01-15/inventory.csv", "sku,available_stock,reserved_stock,warehouse\nA,5,1,W\n")
    _put(f"{tmp_dir}/2026-01-16/inventory.csv", "sku,available_stock\nA,5\n")
    rows, rejects = files.ingest_directory(spark, tmp_dir, schemas.INVENTORY_TEXT, fmt="csv")
    assert sorted((r.exec_date, r.sku, r.available_stock, r.reserved_stock) for r in rows.collect()) == [
        ("2026-01-14", "A", "44", "11"), ("2026-01-15", "A", "5", "1")]
    assert sorted((r.exec_date, r.record) for r in rejects.collect()) == [
        ("2026-01-14", "B,1"), ("2026-01-16", "A,5"), ("2026-01-16", "sku,available_stock")]


def test_one_walk_over_mixed_formats(spark, tmp_dir):
    _put(f"{tmp_dir}/2026-01-14/a.json", json.dumps(_order(1)))
    _put(f"{tmp_dir}/2026-01-14/b.csv", "order_id,store_id,sku,quantity,timestamp\n2,S1,A,2,t\n")
    _put(f"{tmp_dir}/2026-01-14/c.xml", "<x/>")
    (spark.createDataFrame([_order(3)], schemas.ORDERS).coalesce(1).write.parquet(f"{tmp_dir}/2026-01-15"))
    rows, rejects = files.ingest_any(spark, tmp_dir, schemas.ORDERS)
    assert [(r.order_id, r.exec_date) for r in rows.orderBy("order_id").collect()] == [
        ("1", "2026-01-14"), ("2", "2026-01-14"), ("3", "2026-01-15")]
    assert "c" in [r.source_file for r in rejects.collect()]


def test_a_split_store_day_has_delivered(spark, tmp_dir):
    _write_inputs(tmp_dir)
    day = f"{tmp_dir}/raw/orders/2026-01-14"
    for name, folder in (("STORE_01", "store=STORE_01"), ("STORE_02", "STORE_02")):
        with open(f"{day}/{name}.json") as f:
            lines = json.load(f)
        os.remove(f"{day}/{name}.json")
        _put(f"{day}/{folder}/part-0.json", "\n".join(map(json.dumps, lines[::2])))
        _put(f"{day}/{folder}/part-1.json", json.dumps(lines[1::2], indent=2))
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    assert [(r.errors, r.warnings, r.infos) for r in out["summary"].collect()] == [(0, 0, 5)]
    assert out["metrics"].first().sku_count == 3


def test_absent_products_file_is_one_finding(spark, tmp_dir):
    _write_inputs(tmp_dir)
    cfg = _cfg(spark, tmp_dir)
    cfg.products_json = f"{tmp_dir}/nowhere.json"
    out = pipeline.run(spark, cfg, "2026-01-14", clock=F.lit(CLOCK_TEXT))
    found = out["report"].where("check = 'missing_supplier_mapping'").collect()
    assert [(r.level, r.message) for r in found] == [("ERROR", "Products file missing")]
    assert [(r.errors, r.warnings, r.infos) for r in out["summary"].collect()] == [(1, 0, 4)]


def test_a_run_leaves_nothing_in_the_scratch_folder(spark, tmp_dir):
    _write_inputs(tmp_dir)
    root = checkpoint_root(spark).removeprefix("file:")

    def held():
        return {d for d in os.listdir(f"{root}/replenix-scratch") if d.startswith(("run-", "ingest-"))} \
            if os.path.isdir(f"{root}/replenix-scratch") else set()

    before = held()
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    assert held() == before
    for name in ("orders", "rejects", "demand", "net_demand", "lines", "documents", "report", "summary", "audit", "metrics"):
        out[name].collect()   # nothing returned depends on what was removed


def test_metrics_of_a_run(spark, tmp_dir):
    _write_inputs(tmp_dir)
    _put(f"{tmp_dir}/raw/orders/2026-01-14/STORE_09.json", '{"order_id": "cut')
    out = pipeline.run(spark, _cfg(spark, tmp_dir), "2026-01-14", clock=F.lit(CLOCK_TEXT))
    m = out["metrics"].first()
    assert m.raw_rows == out["orders"].count() and m.rejected_rows == 1
    assert (m.aggregated_skus, m.exported_items, m.exported_suppliers) == (3, 3, 2)


def test_order_documents_that_do_not_parse_are_rejects(spark, tmp_dir):
    _put(f"{tmp_dir}/2026-01-14/SUP_1.json", json.dumps({"supplier_id": "SUP_1", "items": [{"sku": "A", "quantity": 1}]}, indent=2))
    _put(f"{tmp_dir}/2026-01-14/SUP_2.json", '{"supplier_id": "SUP_2", "items": [')
    items, rejects = files.split_order_documents(spark, tmp_dir)
    assert [(r.supplier_id, r.sku, r.quantity) for r in items.collect()] == [("SUP_1", "A", 1)]
    assert [(r.date_folder, r.file_stem) for r in rejects.collect()] == [("2026-01-14", "SUP_2")]


def test_streamed_damage_ends_in_the_rejects(spark, tmp_dir):
    _put(f"{tmp_dir}/in/2026-01-14/S1.json", json.dumps([_order(1), _order(2)]))
    _put(f"{tmp_dir}/in/2026-01-14/S2.json", '[{"order_id": "3", "sto')
    _put(f"{tmp_dir}/in/2026-01-14/notes.txt", "not an order")
    stream = stream_ingest.order_file_stream(spark, f"{tmp_dir}/in", schemas.ORDERS)
    stream_ingest.ingest_available(stream, f"{tmp_dir}/t", f"{tmp_dir}/c")
    assert _ids(spark.read.parquet(f"{tmp_dir}/t")) == ["1", "2"]
    assert [r.source_file for r in spark.read.parquet(f"{tmp_dir}/t-rejects").collect()] == ["S2"]


def test_a_submitted_session_keeps_its_settings(tmp_path):
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "SparkSession.builder.master('local[3]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '400').getOrCreate()\n"
            "from replenix.session import production_session\n"
            "s = production_session()\n"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n"
            % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "GOT local[3] 400" in out.stdout


def test_order_lines_are_not_shuffled_by_supplier(spark):
    """The net demand stays hashed by sku: only the catalogue-sized names meet suppliers on supplier_id."""
    from replenix.operators import orders as ords
    net = spark.createDataFrame([("A", "S", 5, 1.0, 5.0, "d")],
                                "sku string, supplier_id string, final_order_qty long, unit_cost double, "
                                "estimated_cost double, exec_date string")
    names = sup.sku_names(spark.createDataFrame([("A", "x")], "sku string, name string"),
                          spark.createDataFrame([("A", "S", 1.0)], "sku string, supplier_id string, unit_cost double"),
                          spark.createDataFrame([("S", "n", "m")], "supplier_id string, name string, contact_email string"))
    lines = ords.order_lines(net, names)
    assert lines.count() == 1
    for threshold in ("spark.sql.autoBroadcastJoinThreshold",):
        old = spark.conf.get(threshold)
        spark.conf.set(threshold, "-1")
        plan = ords.order_lines(net, names)._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(threshold, old)
    side = [line for line in plan.split("\n") if "Exchange hashpartitioning(supplier_id" in line]
    assert len(side) == 2   # the price list and the suppliers, both of catalogue size
