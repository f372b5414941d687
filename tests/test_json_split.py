"""Splittable JSON documents: any cut of a file gives the same records."""

import json
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from replenix import schemas
from replenix.sources import files, json_split

TEXT = st.text(alphabet='ab{}[]",:\\/é日😀\n  ', max_size=8)
VALUE = st.recursive(st.one_of(TEXT, st.integers(-9, 9), st.none(), st.booleans()),
                     lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(TEXT, v, max_size=3)), max_leaves=6)
RECORDS = st.lists(st.dictionaries(TEXT, VALUE, max_size=3), max_size=6)
LAYOUTS = {
    "array": lambda r, a: json.dumps(r, ensure_ascii=a),
    "indented": lambda r, a: json.dumps(r, ensure_ascii=a, indent=2) + "\n",
    "lines": lambda r, a: "\n".join(json.dumps(x, ensure_ascii=a) for x in r),
    "marked": lambda r, a: "﻿ [\n" + ",\n".join(json.dumps(x, ensure_ascii=a) for x in r) + "]",
    "arrays": lambda r, a: "\n".join(json.dumps(r[k:k + 2], ensure_ascii=a) for k in range(0, len(r), 2)),
}


@pytest.fixture()
def ranges_of(spark):
    """Sets the length of a byte range."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def set_(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")
    yield set_
    for k, v in before.items():
        spark.conf.set(k, v)


def _canonical(records):
    return sorted(json.dumps(r, sort_keys=True) for r in records)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files_=st.lists(st.tuples(RECORDS, st.sampled_from(sorted(LAYOUTS)), st.booleans()), min_size=8, max_size=16), size=st.integers(5, 90))
def test_any_cut_gives_the_same_records(spark, ranges_of, tmp_path_factory, files_, size):
    """Quotes, escapes, brackets in strings and code points of several bytes at the ends of ranges."""
    folder = tmp_path_factory.mktemp("cut")
    for k, (records, layout, ascii_) in enumerate(files_):
        (folder / f"f{k}.json").write_text(LAYOUTS[layout](records, ascii_))
    ranges_of(size)
    found = {}
    for r in json_split.json_records(spark, str(folder), "*.json").collect():
        found.setdefault(os.path.basename(r.path), []).append(json.loads(r.record))
    for k, (records, _, _) in enumerate(files_):
        assert _canonical(found.get(f"f{k}.json", [])) == _canonical(records)


def _order(i):
    return {"order_id": str(i), "store_id": "S{1}", "sku": 'A"}', "quantity": i % 9, "timestamp": "t"}


def test_one_array_is_read_by_many_tasks(spark, ranges_of, tmp_dir):
    with open(f"{tmp_dir}/all.json", "w") as f:
        json.dump([_order(i) for i in range(4000)], f)
    size = os.path.getsize(f"{tmp_dir}/all.json")
    ranges_of(size // 10)
    assert json_split._pieces(spark, [tmp_dir], None, None).rdd.getNumPartitions() >= 8
    found = json_split.read_json_split(spark, tmp_dir, schemas.ORDERS)
    assert sorted(int(r.order_id) for r in found.where("sku = 'A\"}' and store_id = 'S{1}'").collect()) == list(range(4000))


def test_a_document_cut_short_keeps_its_whole_records(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/2026-01-14")
    text = json.dumps([_order(i) for i in range(5)], indent=1)
    for name, end in (("S1", text[:-30]), ("S2", text + " trailing"), ("S3", "[]"), ("S4", "[1, 2]"), ("S5", text.replace("A", "\\u0041"))):
        with open(f"{tmp_dir}/2026-01-14/{name}.json", "w") as f:
            f.write(end)
    rows, rejects = files.ingest_directory(spark, tmp_dir, schemas.ORDERS)
    counts = {r.source_file: r.n for r in rows.groupBy("source_file").agg(F.count("*").alias("n")).collect()}
    assert counts == {"S1": 4, "S2": 5, "S5": 5}
    assert sorted(r.source_file for r in rejects.collect()) == ["S1", "S2", "S4"]


def test_a_line_too_long_to_be_read_is_cut_by_its_brackets(spark, ranges_of, tmp_dir, monkeypatch):
    monkeypatch.setattr(files, "LONGEST_LINE", 500)
    os.makedirs(f"{tmp_dir}/2026-01-14")
    with open(f"{tmp_dir}/2026-01-14/S1.json", "w") as f:
        json.dump([_order(i) for i in range(50)], f)
    with open(f"{tmp_dir}/2026-01-14/S2.json", "w") as f:
        f.write("\n".join(json.dumps(_order(i)) for i in range(50, 60)) + "\r\n")
    ranges_of(1000)
    rows, rejects = files.ingest_directory(spark, tmp_dir, schemas.ORDERS)
    assert sorted(int(r.order_id) for r in rows.collect()) == list(range(60)) and rejects.isEmpty()


def test_thousands_of_files_need_no_list(spark, tmp_dir, monkeypatch):
    """5,000 JSON files of two layouts and CSV files of two headers; nothing of one row per file is collected."""
    for d in ("2026-01-14", "2026-01-15"):
        os.makedirs(f"{tmp_dir}/orders/{d}")
        os.makedirs(f"{tmp_dir}/stock/{d}")
    for i in range(5000):
        with open(f"{tmp_dir}/orders/2026-01-{14 + i % 2}/S{i}.json", "w") as f:
            f.write(json.dumps([_order(i)], indent=1) if i % 5 == 0 else json.dumps(_order(i)) + "\n")
    for i in range(300):
        with open(f"{tmp_dir}/stock/2026-01-{14 + i % 2}/w{i}.csv", "w") as f:
            f.write("warehouse,sku,reserved_stock,available_stock\nW,%d,1,5\n" % i if i % 2 else
                    "sku,available_stock,reserved_stock,warehouse,note\n%d,5,1,W,\"a, b\"\n%d,5,1\n" % (i, i))
    sizes = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: sizes.append(len(out := collect(df))) or out)
    rows, rejects = files.ingest_directory(spark, f"{tmp_dir}/orders", schemas.ORDERS)
    stock, stock_rejects = files.ingest_directory(spark, f"{tmp_dir}/stock", schemas.INVENTORY, fmt="csv")
    assert max(sizes, default=0) <= 1
    monkeypatch.undo()
    assert rows.select("order_id").distinct().count() == rows.count() == 5000 and rejects.isEmpty()
    assert stock.where("available_stock = 5 and reserved_stock = 1 and warehouse = 'W'").count() == stock.count() == 300
    assert stock_rejects.count() == 150


def test_pieces_of_a_task_stay_bounded(spark, ranges_of, tmp_dir, monkeypatch):
    """Ranges of a few pieces and many tasks: records that ranges cut come out whole, and a task sorts a bounded number."""
    monkeypatch.setattr(json_split, "RANGE_BITS", 2)
    monkeypatch.setattr(json_split, "TASK_PIECES", 100)
    for name, n in (("a", 700), ("b", 3), ("c", 40)):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            json.dump([{"id": i, "in": {"x": {"y": "}{]"}}, "end": [1, {"z": 2}]} for i in range(n)], f, indent=1)
    ranges_of(8000)
    records = json_split.json_records(spark, tmp_dir, "*.json")
    found = {}
    for r in records.collect():
        found.setdefault(os.path.basename(r.path)[0], []).append(json.loads(r.record)["id"])
    assert {k: sorted(v) for k, v in found.items()} == {"a": list(range(700)), "b": list(range(3)), "c": list(range(40))}
    plan = records._jdf.queryExecution().executedPlan().toString()
    tasks = {int(n) for n in re.findall(r"hashpartitioning\(path#\d+, block#\d+, (\d+)\), REPARTITION_BY_NUM", plan)}
    assert len(tasks) == 1 and 25 < tasks.pop() < 50   # five pieces a record, 100 a task
