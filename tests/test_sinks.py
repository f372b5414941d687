"""Sink behaviour: file layout of partitioned writes and per-partition replacement."""

import os

from pyspark.sql import functions as F

from replenix.sinks import writers


def _files(root):
    out = {}
    for d, _, names in os.walk(root):
        data = [n for n in names if n.startswith("part-")]
        if data:
            out[os.path.basename(d)] = len(data)
    return out


def test_rebalanced_write_gives_few_files_per_folder(spark, tmp_dir):
    # every one of 16 tasks holds rows of all 5 periods
    df = spark.range(0, 20000, numPartitions=16).select(
        (F.col("id") % 5).cast("string").alias("exec_date"), F.col("id"))
    writers.write_partitioned(df, f"{tmp_dir}/t", "exec_date")
    files = _files(f"{tmp_dir}/t")
    assert set(files) == {f"exec_date={i}" for i in range(5)}
    assert max(files.values()) == 1
    writers.write_partitioned(df, f"{tmp_dir}/u", "exec_date", rebalance=False)
    assert max(_files(f"{tmp_dir}/u").values()) > 1     # one file per task and period


def test_rewrite_replaces_only_touched_periods(spark, tmp_dir):
    df = spark.range(0, 300).select((F.col("id") % 3).cast("string").alias("exec_date"), F.col("id"))
    path = f"{tmp_dir}/t"
    writers.write_partitioned(df, path, "exec_date")
    # period 1 re-run with new rows, period 2 re-run with no rows at all, period 0 untouched
    again = spark.range(1000, 1010).select(F.lit("1").alias("exec_date"), F.col("id"))
    writers.write_partitioned(again, path, "exec_date", touched=["1", "2"])
    got = {r.exec_date: r["count"] for r in spark.read.parquet(path).groupBy("exec_date").count().collect()}
    assert got == {"0": 100, "1": 10}


def test_document_rerun_removes_suppliers_without_orders(spark, tmp_dir):
    path = f"{tmp_dir}/docs"
    first = spark.createDataFrame([("d1", "S1", 10), ("d1", "S2", 20), ("d2", "S2", 30)],
                                  "exec_date string, supplier_id string, total int")
    writers.write_documents(first, path, "exec_date", touched=["d1", "d2"])
    # re-run of d1 only: S2 has no order any more; d2 is not touched
    again = spark.createDataFrame([("d1", "S1", 11)], "exec_date string, supplier_id string, total int")
    writers.write_documents(again, path, "exec_date", touched=["d1"])
    got = sorted((r.date, r.supplier_id, r.total) for r in spark.read.json(path).collect())
    assert got == [("d1", "S1", 11), ("d2", "S2", 30)]


def test_read_any_dispatches_by_extension_and_refuses_others(spark, tmp_dir):
    """JSON array / CSV / Parquet by extension (any case); anything else raises."""
    import pytest
    from replenix import schemas
    from replenix.sources import files
    with open(f"{tmp_dir}/o.JSON", "w") as f:
        f.write('[{"order_id": "1", "store_id": "S", "sku": "A", "quantity": 2, "timestamp": "t"}]')
    with open(f"{tmp_dir}/i.csv", "w") as f:
        f.write("sku,available_stock,reserved_stock,warehouse\nA,5,1,W\n")
    assert files.read_any(spark, f"{tmp_dir}/o.JSON", schemas.ORDERS).first().quantity == 2
    assert files.read_any(spark, f"{tmp_dir}/i.csv", schemas.INVENTORY).first().available_stock == 5
    with pytest.raises(ValueError, match="unsupported"):
        files.read_any(spark, f"{tmp_dir}/o.xlsx", schemas.ORDERS)


def test_list_files_lists_without_reading(spark, tmp_dir):
    """Store files found per date folder, by name only (an empty or broken file is still listed)."""
    from replenix.sources import files
    for d, names in {"2026-01-14": ["STORE_01.json", "STORE_02.JSON", "notes.txt"], "2026-01-15": ["STORE_01.json"]}.items():
        os.makedirs(f"{tmp_dir}/{d}")
        for n in names:
            with open(f"{tmp_dir}/{d}/{n}", "w") as f:
                f.write("not json at all" if n == "STORE_02.JSON" else "[]")
    got = sorted((r.exec_date, r.file_stem) for r in
                 files.list_files(spark, [f"{tmp_dir}/2026-01-14", f"{tmp_dir}/2026-01-15"], ".json").collect())
    assert got == [("2026-01-14", "STORE_01"), ("2026-01-14", "STORE_02"), ("2026-01-15", "STORE_01")]


def test_file_stem_reads_a_name_once(spark):
    """The cost per row stays with the name's length: a path of one long component, and names with many or no dots."""
    import time
    from replenix.functions.exprs import file_stem, parent_folder
    names = ["/in/d/STORE_01.json", "/in/d/STORE_01", "/in/d/.json", "/in/d/a.b.c", "/in/d/a.", "/in/d/", "", "x.txt", "s3a://b/d e/f.1.csv"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [(r.s, r.f) for r in df.select(file_stem("p").alias("s"), parent_folder("p").alias("f")).collect()]
    assert got == [("STORE_01", "d"), ("STORE_01", "d"), (".json", "d"), ("a.b", "d"), ("a", "d"), ("", ""), ("", ""),
                   ("x", ""), ("f.1", "d e")]
    long = F.concat(F.lit("/"), F.repeat(F.lit("f"), 8000), F.lit("/"), F.repeat(F.lit("n"), 8000), F.lit("/part.json"))
    start = time.time()
    rows = spark.range(0, 300, numPartitions=1).select(F.concat(long, F.col("id").cast("string")).alias("p"))
    assert rows.where((F.length(file_stem("p")) != 4) | (F.length(parent_folder("p")) != 8000)).count() == 0
    assert time.time() - start < 15     # looked for from every character, each of these paths takes 64 million steps
