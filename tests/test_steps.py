"""A daily run that is stopped and started again; clustered tables."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from replenix.plans import pipeline
from replenix.plans.steps import Steps
from replenix.sinks import layout, snapshots, writers
from replenix.sources import files
from test_quality_pipeline import CLOCK_TEXT, _cfg, _write_inputs


def test_a_stopped_run_repeats_only_what_is_missing(spark, tmp_dir, monkeypatch):
    """The export fails: the report beside it is finished; the second attempt does the export and what follows."""
    _write_inputs(tmp_dir)
    cfg, clock = _cfg(spark, tmp_dir), F.lit(CLOCK_TEXT)
    cfg.run_id, cfg.snapshot_base, cfg.archive_base = "run-1", f"{tmp_dir}/published", f"{tmp_dir}/archive"
    with monkeypatch.context() as m:
        m.setattr(writers, "write_documents", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("disk full")))
        with pytest.raises(RuntimeError, match="disk full"):
            pipeline.run(spark, cfg, "2026-01-14", clock=clock)
    done = Steps(spark, cfg.out_base, "run-1")
    assert [done.done(s) for s in ("ingest", "aggregate", "net_demand", "quality", "export", "publish", "archive", "log")] == [
        True, True, True, True, False, False, False, False]
    assert snapshots.versions(spark, cfg.snapshot_base) == []      # readers see nothing of the stopped run
    with monkeypatch.context() as m:
        for module, name in ((files, "ingest_directory"), (pipeline.qc, "report_details")):
            m.setattr(module, name, lambda *a, **k: (_ for _ in ()).throw(AssertionError("repeated")))
        again = pipeline.run(spark, cfg, "2026-01-14", clock=clock)
    other = _cfg(spark, tmp_dir)
    other.out_base, other.archive_base = f"{tmp_dir}/other", f"{tmp_dir}/other-archive"
    whole = pipeline.run(spark, other, "2026-01-14", clock=clock)
    for name in ("orders", "rejects", "demand", "net_demand", "lines", "documents", "report", "summary", "metrics"):
        assert sorted(map(str, again[name].collect())) == sorted(map(str, whole[name].select(*again[name].columns).collect())), name
    assert snapshots.versions(spark, cfg.snapshot_base) == [1]
    net = snapshots.read(spark, cfg.snapshot_base, "net_demand", whole["net_demand"].schema, "exec_date")
    assert net.exceptAll(whole["net_demand"]).isEmpty() and net.count() == whole["net_demand"].count()
    assert writers.read_run_log(spark, f"{cfg.out_base}/run_log").count() == 1


def test_a_failing_step_is_tried_again(spark, tmp_dir):
    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("lost")
        return "done"

    with pytest.raises(OSError):
        Steps(spark, tmp_dir, retries=1).run("s", work)
    assert Steps(spark, tmp_dir, retries=1).run("s", work) == "done" and len(tries) == 3


def test_branches_run_side_by_side(spark, tmp_dir):
    import threading
    both = threading.Barrier(2, timeout=30)     # neither gets through alone
    steps = Steps(spark, tmp_dir, "r")
    assert steps.side_by_side(a=(lambda: both.wait() >= 0, None), b=(lambda: both.wait() >= 0, None)) == {"a": True, "b": True}
    assert steps.done("a") and steps.done("b")


def test_archive_tells_a_changed_value_at_equal_counts(spark, tmp_dir, monkeypatch):
    _write_inputs(tmp_dir)
    cfg = _cfg(spark, tmp_dir)
    cfg.archive_base = f"{tmp_dir}/archive"
    write = writers.write_partitioned

    def damaged(df, path, *a, **k):
        if path.startswith(cfg.archive_base) and "total_demand" in df.columns and "moq" not in df.columns:
            df = df.withColumn("total_demand", F.col("total_demand") + F.when(F.col("sku") == F.lit(sku), 1).otherwise(0))
        return write(df, path, *a, **k)
    sku = min(r.sku for r in pipeline.run(spark, cfg, "2026-01-14", clock=F.lit(CLOCK_TEXT))["demand"].collect())
    monkeypatch.setattr(writers, "write_partitioned", damaged)
    with pytest.raises(RuntimeError, match="archive differs"):
        pipeline.run(spark, cfg, "2026-01-14", clock=F.lit(CLOCK_TEXT))


def test_a_read_of_one_sku_and_one_week_touches_few_row_groups(spark, tmp_dir):
    rows = (spark.range(120_000).select(F.concat(F.lit("SKU_"), F.lpad((F.col("id") % 400).cast("string"), 4, "0")).alias("sku"),
                                        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 400).cast("int")).alias("day"),
                                        F.xxhash64("id").alias("n")))
    rows = rows.unionByName(spark.createDataFrame([(None, None, 1), ("SKU_0001", None, 2)], rows.schema))
    layout.write_clustered(rows, f"{tmp_dir}/t", ["sku", "day"], files=64)
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.exceptAll(rows).isEmpty() and back.count() == 120_002
    import datetime
    import glob
    lo, hi, touched, total, blooms = datetime.date(2026, 3, 2), datetime.date(2026, 3, 8), 0, 0, 0
    for f in glob.glob(f"{tmp_dir}/t/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            sku, day = (meta.row_group(g).column(c).statistics for c in (0, 1))
            total += 1
            touched += sku.min <= "SKU_0123" <= sku.max and day.min <= hi and day.max >= lo
    assert total >= 64 and touched <= total / 8
    found = back.where("sku = 'SKU_0123' and day between '2026-03-02' and '2026-03-08'")
    assert found.count() == 7
