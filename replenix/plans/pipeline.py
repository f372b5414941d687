"""The daily run and the backfill (B8): one function for one date or a range.

    ingest orders (JSON) and stock (CSV) -> raw tables, partitioned by exec_date
    aggregate demand -> processed.aggregated_orders
    net demand (MRP)  -> processed.net_demand
    purchase-order documents, quality report  (independent outputs)
    partition audit, run metrics, run log

Every table is written with per-partition replacement: re-running a date, or
dates in any order, leaves the same tables.  Intermediate tables are written
and read back, which also cuts the lineage between stages.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replenix import schemas
from replenix.operators import demand as dem
from replenix.operators import master as mst
from replenix.operators import mrp
from replenix.operators import orders as ords
from replenix.operators import quality as qc
from replenix.operators import suppliers as sup
from replenix.plans.steps import Steps
from replenix.session import scratch_path
from replenix.sinks import catalog, digest, snapshots, writers
from replenix.sources import files, json_split

P = "exec_date"


@dataclass
class Config:
    orders_root: str                     # <root>/<yyyy-mm-dd>/<STORE>.json or <STORE>/ or store=<STORE>/ with parts
    stock_root: str                      # <root>/<yyyy-mm-dd>/inventory.csv
    out_base: str                        # processed tables, documents, reports
    products: DataFrame | None = None    # master data (a table, JDBC read or snapshot)
    suppliers: DataFrame | None = None
    product_suppliers: DataFrame | None = None
    products_json: str | None = None     # raw product file, for the required-field check
    products_json_lines: bool = False    # True: one object per line (splittable); False: one JSON array
    expected_stores: list[str] = field(default_factory=list)
    expected_skus: list[str] | DataFrame = field(default_factory=list)   # a list or a one-column table
    spike_threshold: int = qc.DEMAND_SPIKE_THRESHOLD
    date_folder: str = "{}"              # name of a date's folder, e.g. "day={}"
    orders_ext: str = ".json"
    archive_base: str | None = None      # where the run's tables are copied to and compared; None: no archive
    table_suffix: str | None = None      # registers the four tables under this suffix; None: not registered
    snapshot_base: str | None = None     # where the run's four tables are published in one step; None: not published
    run_id: str | None = None            # a run started again under its name repeats only what is missing
    retries: int = 0                     # further attempts of a failing step
    orders_multi_line: bool | None = None   # None: arrays and JSON Lines told by content; else one way for all files


def dates_between(start: str, end: str) -> list[str]:
    d0, d1 = date.fromisoformat(start), date.fromisoformat(end)
    return [(d0 + timedelta(days=i)).isoformat() for i in range((d1 - d0).days + 1)]


def _periods(spark: SparkSession, dates: list[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], f"{P} string")


def _in(dates: list[str]) -> Column:
    return F.col(P).isin(*dates)


def _raw_tables(cfg: Config) -> dict:
    """name -> (path, schema) of the raw tables."""
    from pyspark.sql import types as T
    base, text = cfg.out_base.rstrip("/"), T.StringType()
    rejects = T.StructType([T.StructField(c, text) for c in (P, "source_file", "record")])
    return {"orders": (f"{base}/raw/orders", T.StructType([*schemas.ORDERS.fields, T.StructField(P, text)])),
            "stock": (f"{base}/raw/inventory", T.StructType([*schemas.INVENTORY_TEXT.fields, T.StructField(P, text)])),
            "rejects": (f"{base}/raw/rejects", rejects)}


def ingested(spark: SparkSession, cfg: Config, dates: list[str]) -> dict:
    """What an ingest of the dates left: its tables, and the listings of its files."""
    names = [cfg.date_folder.format(d) for d in dates]
    order_dirs = writers.existing_folders(spark, cfg.orders_root, names)
    stock_dirs = writers.existing_folders(spark, cfg.stock_root, names)
    # presence for quality check 1, as files: a store has delivered when a file of its is there (an
    # empty one still counts), and the date folders that exist (even without files)
    order_files = (files.list_files(spark, order_dirs, cfg.orders_ext, period=P).where(_in(dates))
                   .select(P, F.col("store").alias("store_id")).distinct())
    order_folders = _periods(spark, [d.rstrip("/")[-10:] for d in order_dirs])
    # a snapshot is present when its file is, even with no row (check 2 and 5)
    stock_files = files.list_files(spark, stock_dirs, ".csv", period=P).where(_in(dates)).select(P).distinct()
    tables = {name: _read(spark, path, dates, spark.createDataFrame([], schema)) for name, (path, schema) in _raw_tables(cfg).items()}
    return {"order_files": order_files, "order_folders": order_folders, "stock_files": stock_files, **tables}


def ingest(spark: SparkSession, cfg: Config, dates: list[str], scratch: str) -> dict:
    """Raw files of the dates -> raw/orders, raw/inventory (+ rejects).

    Only the date folders of the run are listed and read, not the whole history.  Parses are staged
    below ``scratch``, which the run removes."""
    names = [cfg.date_folder.format(d) for d in dates]
    order_dirs = writers.existing_folders(spark, cfg.orders_root, names)
    stock_dirs = writers.existing_folders(spark, cfg.stock_root, names)
    orders, rejects = files.ingest_directory(spark, order_dirs, schemas.ORDERS, fmt="json", period=P,
                                             multi_line=cfg.orders_multi_line, ext=cfg.orders_ext,
                                             staging=f"{scratch}/orders")
    stock, stock_rejects = files.ingest_directory(spark, stock_dirs, schemas.INVENTORY_TEXT, fmt="csv",
                                                  period=P, staging=f"{scratch}/stock")
    found = {"orders": orders.drop("source_file"), "stock": stock.drop("source_file"), "rejects": rejects.unionByName(stock_rejects)}
    # a read task of the staged parse may hold rows of many dates: rebalanced, so that a date gets files
    # of the advisory size and not one per task
    for name, (path, schema) in _raw_tables(cfg).items():
        writers.write_partitioned(found[name].where(_in(dates)).select(*schema.names), path, P, touched=dates)
    return ingested(spark, cfg, dates)


def _read(spark: SparkSession, path: str, dates: list[str], like: DataFrame) -> DataFrame:
    """Partition-pruned read of the dates of a table written by this module, with
    the schema it was written with (so an empty table still reads)."""
    cols = [f for f in like.schema.fields if f.name != P] + [like.schema[P]]
    from pyspark.sql import types as T
    return spark.read.schema(T.StructType(cols)).parquet(path).where(_in(dates))


def _materialize(df: DataFrame, path: str, dates: list[str], rebalance: bool = True) -> DataFrame:
    writers.write_partitioned(df, path, P, touched=dates, rebalance=rebalance)
    return _read(df.sparkSession, path, dates, df)


def run(spark: SparkSession, cfg: Config, start_date: str, end_date: str | None = None,
        clock: Column | None = None, dates: list[str] | None = None) -> dict[str, DataFrame]:
    """Run the whole chain for [start_date, end_date] (or the given dates) and return the result tables.

    Everything returned reads tables of ``out_base``; what the run staged elsewhere is removed."""
    dates = dates or dates_between(start_date, end_date or start_date)
    base = cfg.out_base.rstrip("/")
    scratch = scratch_path(spark, "run")
    try:
        return _run(spark, cfg, dates, base, scratch, clock)
    finally:
        writers.remove_folder(spark, scratch)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once below the run's scratch folder and read back: no stage computes it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new(scratch: str, name: str) -> str:
    """A folder of its own for every attempt of a step."""
    return f"{scratch}/{name}-{uuid.uuid4().hex[:8]}"


def _step(steps: Steps, name: str, df: DataFrame, path: str, dates: list[str]) -> DataFrame:
    """A table of the run, written by a step and read back."""
    return steps.run(name, lambda: _materialize(df, path, dates), lambda: _read(df.sparkSession, path, dates, df))


def _export(lines: DataFrame, base: str, scratch: str, dates: list[str], clock: Column | None) -> None:
    """Purchase orders (B3): records with order_date = data_date + 1."""
    docs = ords.order_records(_kept(lines, scratch), P, generated_at=clock)
    writers.write_documents(docs, f"{base}/output/supplier_orders", P, touched=dates)


def _quality(spark: SparkSession, cfg: Config, raw: dict, demand: DataFrame, parsed: DataFrame, products: DataFrame,
             preferred: DataFrame, base: str, scratch: str, dates: list[str], clock: Column | None) -> tuple[DataFrame, DataFrame]:
    """The quality report (B4): its entries and its summary, written and read back."""
    orders = raw["orders"]
    periods = _periods(spark, dates)
    expected_skus = (cfg.expected_skus.select(F.col(cfg.expected_skus.columns[0]).cast("string").alias("sku"))
                     if isinstance(cfg.expected_skus, DataFrame)
                     else spark.createDataFrame([(s,) for s in cfg.expected_skus], "sku string"))
    no_products = bool(cfg.products_json) and not writers.folder_exists(spark, cfg.products_json)
    if no_products:
        pdocs = spark.createDataFrame([], "sku string, value string")
    elif cfg.products_json and cfg.products_json_lines:
        product_lines = spark.read.text(cfg.products_json).where(F.length(F.trim("value")) > 0)
        pdocs = product_lines.select(F.get_json_object("value", "$.sku").alias("sku"), "value")
    elif cfg.products_json:
        # a single JSON array (the master export), read in byte ranges: each element as its own JSON text
        records = json_split.json_records(spark, cfg.products_json, staging=f"{scratch}/products")
        pdocs = records.select(F.get_json_object("record", "$.sku").alias("sku"), F.col("record").alias("value"))
    else:
        pdocs = qc.product_documents(products.drop("supplier_id"), preferred)
    # the orders' store / SKU rollup feeds checks 1 and 4 of both the counts and the
    # entries: built once, checkpointed in the shared folder, read three times
    sums = demand.select(P, F.lit(None).cast(orders.schema["store_id"].dataType).alias("store_id"), "sku",
                         F.col("total_demand").alias("quantity"))   # the orders, added up by the aggregate step
    rollup = _kept(qc.orders_rollup(sums, P, stores=raw["order_files"], folders=raw["order_folders"]), f"{scratch}/rollup")
    counts = _kept(qc.report_counts(periods, orders, parsed, expected_skus, products, pdocs, cfg.expected_stores,
                                    cfg.spike_threshold, P, rollup=rollup, snapshots=raw["stock_files"],
                                    products_absent=no_products), f"{scratch}/counts")   # one row per date
    details = qc.report_details(periods, orders, parsed, expected_skus, products, pdocs, cfg.expected_stores,
                                counts, cfg.spike_threshold, P, clock=clock, rollup=rollup,
                                snapshots=raw["stock_files"], products_absent=no_products)
    writers.write_partitioned(details, f"{base}/logs/exceptions", P, fmt="json", touched=dates)
    writers.write_partitioned(qc.report_summary(counts, P), f"{base}/logs/summary", P, fmt="json", touched=dates)
    return _reports(spark, base, dates)


def _reports(spark: SparkSession, base: str, dates: list[str]) -> tuple[DataFrame, DataFrame]:
    return (_written_json(spark, schemas.REPORT_ENTRY, f"{base}/logs/exceptions", dates),
            _written_json(spark, schemas.REPORT_SUMMARY, f"{base}/logs/summary", dates))


def _run(spark: SparkSession, cfg: Config, dates: list[str], base: str, scratch: str, clock: Column | None
         ) -> dict[str, DataFrame]:
    steps = Steps(spark, base, cfg.run_id, cfg.retries)
    raw = steps.run("ingest", lambda: ingest(spark, cfg, dates, _new(scratch, "ingest")), lambda: ingested(spark, cfg, dates))
    orders, stock_text = raw["orders"], raw["stock"]

    # aggregate (A1) -> processed.aggregated_orders, read back for the next stage
    demand = _step(steps, "aggregate", dem.aggregate_demand(orders, P).select("sku", "total_demand", P),
                   f"{base}/processed/aggregated_orders", dates)

    # net demand (B1) -> processed.net_demand
    parsed = qc.parsed_inventory(stock_text)
    stock = dem.inventory_by_sku(parsed.select(P, "sku", F.col("_avail").alias("available_stock"),
                                               F.col("_resv").alias("reserved_stock")), P)
    products = mst.apply_defaults(cfg.products, schemas.PRODUCTS, schemas.PRODUCT_DEFAULTS)
    # one row per SKU, asked for by the net demand, the orders and the quality report: chosen once
    preferred = _kept(sup.preferred_suppliers(cfg.product_suppliers), _new(scratch, "preferred"))
    master = sup.supplier_master(products, preferred)
    net = _step(steps, "net_demand", mrp.net_demand(demand, stock, master, P), f"{base}/processed/net_demand", dates)

    # purchase orders (B3) and the quality report (B4) need nothing of one another
    names = sup.sku_names(products, preferred, cfg.suppliers)
    lines = ords.order_lines(net, names, P)
    done = steps.side_by_side(
        export=(lambda: _export(lines, base, _new(scratch, "lines"), dates, clock), lambda: None),
        quality=(lambda: _quality(spark, cfg, raw, demand, parsed, products, preferred, base, _new(scratch, "quality"), dates, clock),
                 lambda: _reports(spark, base, dates)))
    details, summary = done["quality"]

    # audit, metrics, run log
    written = {"orders": orders, "inventory": stock_text, "aggregated_orders": demand, "net_demand": net}
    audit = writers.partition_audit(spark, {"aggregated_orders": demand, "net_demand": net}, P)
    if cfg.table_suffix is not None:
        catalog.ensure_tables(spark, base, {n: _period_last(df) for n, df in written.items()}, P, cfg.table_suffix)
    if cfg.snapshot_base:   # readers of the versions see the whole run or nothing of it
        steps.run("publish", lambda: snapshots.publish(spark, cfg.snapshot_base, written, P, dates))
    archived = _periods(spark, dates).withColumn("archived_rows", F.lit(0).cast("long"))
    if cfg.archive_base:
        archived = steps.run("archive", lambda: _archived(spark, cfg, base, written, dates),
                             lambda: _archived_rows(spark, cfg, written, dates))
    metrics = _metrics(spark, dates, raw, demand, lines, net, archived)
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)   # one row per date; the log and the caller use it
    stamp = clock if clock is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    run_row = (metrics.agg(F.count_if(F.col("sku_count") > 0).alias("dates_with_orders"),
                           F.sum("sku_count").alias("sku_count"))
               .select(stamp.alias("run_at"), F.lit(dates[0]).alias("start_date"),
                       F.lit(dates[-1]).alias("end_date"), "dates_with_orders", "sku_count"))
    steps.run("log", lambda: writers.append_run_log(spark, f"{base}/run_log", run_row))
    # read after the run, which removes what it staged
    names = sup.sku_names(products, sup.preferred_suppliers(cfg.product_suppliers), cfg.suppliers)
    return {"orders": orders, "rejects": raw["rejects"], "demand": demand, "net_demand": net, "lines": ords.order_lines(net, names, P),
            "documents": files.read_order_documents(spark, f"{base}/output/supplier_orders"), "report": details, "summary": summary, "audit": audit, "metrics": metrics}


def _written_json(spark: SparkSession, schema, path: str, dates: list[str]) -> DataFrame:
    from pyspark.sql import types as T
    fields = [f for f in schema.fields if f.name != P] + [T.StructField(P, T.StringType())]
    return spark.read.schema(T.StructType(fields)).json(path).where(_in(dates)).select(*schema.names)


def _period_last(df: DataFrame):
    from pyspark.sql import types as T
    return T.StructType([f for f in df.schema.fields if f.name != P] + [df.schema[P]])


def _archived(spark: SparkSession, cfg: Config, base: str, written: dict, dates: list[str]) -> DataFrame:
    """Copies the dates of the four tables and compares contents per table and date (K9) -> date, archived_rows.

    A copy that differs stops the run."""
    folders = {name: folder for (_, name), folder in catalog.TABLES.items()}
    copies = {}
    for name, df in written.items():
        target = f"{cfg.archive_base.rstrip('/')}/{folders[name]}"
        writers.write_partitioned(df, target, P, touched=dates, rebalance=False)   # the files are sized already
        copies[name] = _read(spark, target, dates, df)
    differ = digest.differences(written, copies, P)
    if not differ.isEmpty():
        raise RuntimeError(f"archive differs: {differ.first()}")
    return _archived_rows(spark, cfg, written, dates)


def _archived_rows(spark: SparkSession, cfg: Config, written: dict, dates: list[str]) -> DataFrame:
    folders = {name: folder for (_, name), folder in catalog.TABLES.items()}
    copies = {name: _read(spark, f"{cfg.archive_base.rstrip('/')}/{folders[name]}", dates, df) for name, df in written.items()}
    there = writers.partition_audit(spark, copies, P)
    return there.groupBy(P).agg(F.sum("row_count").alias("archived_rows"))


def _metrics(spark: SparkSession, dates: list[str], ingested: dict, demand: DataFrame, lines: DataFrame,
             net: DataFrame, archived: DataFrame) -> DataFrame:
    """Per date of the run (K11): raw and rejected rows, demanded SKUs, net-demand rows with quantity and
    exact cost, suppliers and items exported, rows archived.  Every part is one row per date."""
    def per_date(df, **columns):
        return df.groupBy(P).agg(*[c.alias(n) for n, c in columns.items()])

    one = F.count(F.lit(1))
    parts = [per_date(ingested["orders"], raw_rows=one), per_date(ingested["rejects"], rejected_rows=one),
             per_date(demand, aggregated_skus=one), mrp.run_metrics(net, P),
             per_date(lines, exported_items=one, exported_suppliers=F.count_distinct("supplier_id")), archived]
    out = _periods(spark, dates)
    for part in parts:
        out = out.join(part, P, "left")
    return out.na.fill(0)


def _master_table(spark: SparkSession, path: str, schema, defaults: dict) -> DataFrame:
    """A master table from a JSON (array or lines) / CSV / Parquet file, columns
    absent from the file filled with their defaults."""
    from pyspark.sql import types as T
    low = path.lower()
    if low.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif low.endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    else:
        # the declared columns only; a column the file never names gets its default, so names are looked up
        # first, in one pass over the file's objects
        text = spark.read.text(path, wholetext=True)
        names = (text.select(F.explode(F.from_json("value", "array<string>")).alias("o"))
                 .select(F.explode(F.json_object_keys("o")).alias("k")).distinct())
        present_names = {r["k"] for r in names.where(F.col("k").isin([f.name for f in schema.fields])).collect()}
        declared = T.StructType([f for f in schema.fields if f.name in present_names])
        df = spark.read.schema(declared).option("multiLine", True).json(path)
    present = [f for f in schema.fields if f.name in df.columns]
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in present])
    return mst.apply_defaults(df, T.StructType(schema.fields), defaults)


def main(argv: list[str] | None = None) -> None:
    """Command line: run one date or a range over a data folder laid out as
    raw/orders/<date>/<STORE>.json, raw/stock/<date>/inventory.csv plus master files."""
    import argparse

    from replenix.session import production_session
    ap = argparse.ArgumentParser(prog="python -m replenix.plans.pipeline")
    ap.add_argument("--data", required=True, help="folder with raw/orders and raw/stock")
    ap.add_argument("--out", required=True, help="output base (tables, documents, reports)")
    ap.add_argument("--products", required=True)
    ap.add_argument("--suppliers", required=True)
    ap.add_argument("--product-suppliers", required=True)
    ap.add_argument("--start", required=True)
    ap.add_argument("--end")
    ap.add_argument("--stores", default="", help="expected stores, comma separated")
    ap.add_argument("--skus", default="", help="expected SKUs, comma separated (default: all products)")
    ap.add_argument("--spike-threshold", type=int, default=qc.DEMAND_SPIKE_THRESHOLD)
    ap.add_argument("--master", default=None, help="Spark master (default: as submitted)")
    a = ap.parse_args(argv)
    spark = production_session("replenix-daily-run", a.master)
    products = _master_table(spark, a.products, schemas.PRODUCTS, schemas.PRODUCT_DEFAULTS)
    cfg = Config(
        orders_root=f"{a.data}/raw/orders", stock_root=f"{a.data}/raw/stock", out_base=a.out,
        products=products,
        suppliers=_master_table(spark, a.suppliers, schemas.SUPPLIERS, schemas.SUPPLIER_DEFAULTS),
        product_suppliers=_master_table(spark, a.product_suppliers, schemas.PRODUCT_SUPPLIERS,
                                        schemas.PRODUCT_SUPPLIER_DEFAULTS),
        products_json=a.products if a.products.lower().endswith(".json") else None,
        expected_stores=[x for x in a.stores.split(",") if x],
        expected_skus=[x for x in a.skus.split(",") if x] or products.select("sku"),
        spike_threshold=a.spike_threshold)
    out = run(spark, cfg, a.start, a.end)
    out["summary"].orderBy(P).show(truncate=False)
    out["metrics"].orderBy(P).show(truncate=False)


if __name__ == "__main__":
    main()
