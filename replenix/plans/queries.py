"""Registry of the queries: one DataFrame builder per operator key.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame over the whole
adapter tables.  Keys and column names match ``replenix.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from replenix import schemas
from replenix.functions.exprs import plus_days_text, round_half_even as half_even
from replenix.operators import audit, bloom, incremental
from replenix.operators import demand as dem
from replenix.operators import master as mst
from replenix.operators import mrp
from replenix.operators import orders as ords
from replenix.operators import quality as qc
from replenix.operators import reports as rep
from replenix.operators import suppliers as sup
from replenix.session import checkpoint_root, scratch_path
from replenix.sinks import catalog, digest, layout, snapshots, writers
from replenix.sources import files, json_split
from replenix.streaming import ingest as stream_ingest
from replenix.streaming import latest as stream_latest
from replenix.plans.adapters import PERIOD as P, POS_YEAR, STORE_COUNT, expected_stores
from replenix.plans.views import Views

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


# --- 1. net demand and its parts -------------------------------------------

@query("pos_orders")
def pos_orders(v: Views) -> DataFrame:
    # one period through a named parameter, as a half-open range that reaches the Parquet scan
    return v.spark.sql("""SELECT order_id, store_id, sku, quantity FROM {pos}
                          WHERE order_ts >= CAST(make_date(:year, 1, 1) AS TIMESTAMP_NTZ)
                            AND order_ts < CAST(make_date(:year + 1, 1, 1) AS TIMESTAMP_NTZ)""",
                       args={"year": POS_YEAR}, pos=v.pos)


@query("raw_orders_partition")
def raw_orders_partition(v: Views) -> DataFrame:
    """The order lines as a raw table partitioned by period; one period read back
    through partition pruning (only its folder is listed and scanned)."""
    path = scratch_path(v.spark, "raw_orders")
    writers.write_partitioned(v.pos.select("order_id", "store_id", "sku", "quantity", P), path, P)
    return files.read_partition(v.spark, path, P, str(POS_YEAR)).select("order_id", "store_id", "sku", "quantity")


@query("aggregated_demand")
def aggregated_demand(v: Views) -> DataFrame:
    return v.demand


@query("inventory_by_sku")
def inventory_by_sku(v: Views) -> DataFrame:
    return v.stock


@query("demand_vs_stock")
def demand_vs_stock(v: Views) -> DataFrame:
    return dem.demand_vs_stock(v.demand, v.stock, P)


@query("ranked_suppliers")
def ranked_suppliers(v: Views) -> DataFrame:
    return sup.rank_suppliers(v.product_suppliers)


@query("preferred_supplier")
def preferred_supplier(v: Views) -> DataFrame:
    return v.preferred.join(v.products.select("sku"), "sku", "left_semi")


@query("master_products")
def master_products(v: Views) -> DataFrame:
    prods = (v.products.join(v.preferred.select("sku", "supplier_id"), "sku", "left")
             .select("sku", "name", F.col("supplier_id").cast("string").alias("supplier_id"),
                     "pack_size", "moq", "safety_stock"))
    out = mst.apply_defaults(prods, schemas.PRODUCTS, schemas.PRODUCT_DEFAULTS)
    # snapshot of the master table, replaced whole, then read like any table
    path = scratch_path(v.spark, "master") + "/products/static=latest"
    writers.write_snapshot(out, path)
    back = v.spark.read.schema(schemas.PRODUCTS).parquet(path)
    # the adapter keys are numbers; keep them numeric for comparison
    return back.withColumn("sku", F.col("sku").cast("long"))


@query("mrp_pack_rounding")
def mrp_pack_rounding(v: Views) -> DataFrame:
    return v.rounded.select(P, "sku", "pack_size", "raw_demand", "final_order_qty")


@query("net_demand")
def net_demand(v: Views) -> DataFrame:
    return v.net


@query("below_moq")
def below_moq(v: Views) -> DataFrame:
    return mrp.below_moq(v.rounded, P)


@query("dropped_skus")
def dropped_skus(v: Views) -> DataFrame:
    return mrp.dropped_skus(v.demand, v.stock, v.products, v.preferred, v.suppliers, P)


@query("run_metrics")
def run_metrics(v: Views) -> DataFrame:
    return mrp.run_metrics(v.net, P)


# --- 2. purchase-order export ------------------------------------------------

def fixed_clock():
    """Run stamps stay out of compared output."""
    return F.lit("1970-01-01T00:00:00")


@query("supplier_order_lines")
def supplier_order_lines(v: Views) -> DataFrame:
    return v.lines


@query("supplier_orders_header")
def supplier_orders_header(v: Views) -> DataFrame:
    return ords.order_headers(v.lines, P)


@query("supplier_orders_doc")
def supplier_orders_doc(v: Views) -> DataFrame:
    """Write the order records, read them back, item by item: must give the lines again."""
    path = scratch_path(v.spark, "supplier_orders")
    writers.write_documents(ords.order_records(v.lines, P, generated_at=fixed_clock()), path, P)
    back = files.read_order_documents(v.spark, path)
    return back.select(
        F.col("data_date").cast("int").alias(P), F.col("supplier_id").cast("long").alias("supplier_id"),
        "supplier_name", F.col("sku").cast("long").alias("sku"), "product_name", "quantity", "unit_cost",
        "total_cost", F.col("order_total_cost").cast("decimal(18,2)").alias("order_total_cost"))


@query("order_dates_shift")
def order_dates_shift(v: Views) -> DataFrame:
    return ords.order_dates_shift(v.table("lineitem"), "l_shipdate")


@query("order_dates")
def order_dates(v: Views) -> DataFrame:
    return v.lines.select(P).distinct().orderBy(F.col(P).desc())


@query("parse_order_docs")
def parse_order_docs(v: Views) -> DataFrame:
    """Document text in both formats (even suppliers: current object, odd: legacy
    list), parsed back by the dual-format reader."""
    item = F.struct("sku", "product_name", "quantity", F.round("unit_cost", 2).alias("unit_cost"),
                    F.round("total_cost", 2).alias("total_cost"))
    data_date = F.col(P).cast("string")
    docs = v.lines.select(P, "supplier_id", F.array(item).alias("items"))   # a document per line: no group is gathered
    obj = F.to_json(F.struct("supplier_id", plus_days_text(data_date, 1).alias("order_date"),
                             data_date.alias("data_date"), "items"))
    legacy = F.to_json(F.transform("items", lambda x: F.struct(x["sku"], x["quantity"])))
    texts = docs.select(F.when(F.col("supplier_id") % 2 == 0, obj).otherwise(legacy).alias("value"),
                        data_date.alias("date_folder"), F.col("supplier_id").cast("string").alias("file_stem"))
    return files.parse_order_documents(texts).select("data_date", "supplier_id", "sku", "quantity", "unit_cost")


# --- 3. quality checks ----------------------------------------------------------

NO_DATA_YEAR = 1994   # a period in the calendar without any input


def qc_periods(v: Views) -> DataFrame:
    """The periods the checks run for: the sales calendar plus one empty period."""
    extra = v.spark.range(1).select(F.lit(NO_DATA_YEAR).cast("int").alias(P))
    return v.years.unionByName(extra).distinct()


def _parsed_inventory(v: Views) -> DataFrame:
    return qc.parsed_inventory(v.inventory_text)


def _product_docs(v: Views) -> DataFrame:
    return qc.product_documents(v.products, v.preferred)


def _counts(v: Views, rollup: DataFrame | None = None) -> DataFrame:
    return qc.report_counts(qc_periods(v), v.pos, _parsed_inventory(v), v.expected_skus, v.products,
                            _product_docs(v), expected_stores(), qc.DEMAND_SPIKE_THRESHOLD, P, rollup=rollup)


@query("stores_found")
def stores_found(v: Views) -> DataFrame:
    return qc.stores_found(v.pos, P)


@query("qc_missing_stores")
def qc_missing_stores(v: Views) -> DataFrame:
    return qc.missing_stores(qc.stores_found(v.pos, P), expected_stores(), P)


@query("qc_missing_inventory")
def qc_missing_inventory(v: Views) -> DataFrame:
    return qc.missing_inventory(qc_periods(v), v.inventory, P)


@query("qc_unmapped_skus")
def qc_unmapped_skus(v: Views) -> DataFrame:
    return qc.unmapped_skus(v.expected_skus, v.products)


@query("qc_missing_fields")
def qc_missing_fields(v: Views) -> DataFrame:
    return qc.missing_fields(_product_docs(v))


@query("qc_demand_spike")
def qc_demand_spike(v: Views) -> DataFrame:
    return qc.demand_spikes(v.pos_lines, qc.DEMAND_SPIKE_THRESHOLD, P)


@query("qc_skus_missing_in_inventory")
def qc_skus_missing_in_inventory(v: Views) -> DataFrame:
    return qc.skus_missing_in_inventory(v.expected_skus, v.inventory, P)


@query("qc_inventory_invalid")
def qc_inventory_invalid(v: Views) -> DataFrame:
    return (_parsed_inventory(v).where(~F.col("valid"))
            .select(P, "sku", "warehouse", "available_stock", "reserved_stock"))


@query("qc_inventory_inconsistency")
def qc_inventory_inconsistency(v: Views) -> DataFrame:
    return qc.inventory_findings(_parsed_inventory(v), P)


@query("qc_report_summary")
def qc_report_summary(v: Views) -> DataFrame:
    return qc.report_summary(_counts(v), P)


@query("qc_report_entries")
def qc_report_entries(v: Views) -> DataFrame:
    """The report body without run stamps and message text: period, seq, level, check, detail."""
    # the store / SKU rollup of the orders is read by the counts and by two entry
    # sections: checkpointed once (shared folder) so the order lines are read once
    checkpoint_root(v.spark)
    rollup = qc.orders_rollup(v.pos, P).checkpoint(eager=True)
    d = qc.report_details(qc_periods(v), v.pos, _parsed_inventory(v), v.expected_skus, v.products,
                          _product_docs(v), expected_stores(), _counts(v, rollup), qc.DEMAND_SPIKE_THRESHOLD, P,
                          clock=fixed_clock(), rollup=rollup)
    return d.select(P, "seq", "level", "check", "detail")


# --- 4. dashboard reports ----------------------------------------------------------

def _products_with_supplier(v: Views) -> DataFrame:
    return v.products.join(v.preferred.select("sku", "supplier_id"), "sku", "left")


@query("products_per_supplier")
def products_per_supplier(v: Views) -> DataFrame:
    return rep.products_per_supplier(_products_with_supplier(v))


@query("qty_per_supplier")
def qty_per_supplier(v: Views) -> DataFrame:
    return rep.qty_per_supplier(v.lines)


@query("qty_per_sku_date")
def qty_per_sku_date(v: Views) -> DataFrame:
    return rep.qty_per_sku_on(v.lines, P)


@query("demand_evolution")
def demand_evolution(v: Views) -> DataFrame:
    return rep.demand_evolution(v.net, P)


@query("dashboard_kpis")
def dashboard_kpis(v: Views) -> DataFrame:
    return rep.dashboard_kpis(v.products, v.suppliers, v.lines, P)


@query("dashboard_kpi_text")
def dashboard_kpi_text(v: Views) -> DataFrame:
    return rep.kpi_text(rep.dashboard_kpis(v.products, v.suppliers, v.lines, P))


@query("orders_for_date")
def orders_for_date(v: Views) -> DataFrame:
    return rep.orders_for_date(v.lines, P)


@query("latest_net_demand")
def latest_net_demand(v: Views) -> DataFrame:
    return rep.latest_rows(v.net, P)


@query("latest_per_sku")
def latest_per_sku(v: Views) -> DataFrame:
    return rep.latest_per_sku(v.net, P)


@query("safety_vs_demand")
def safety_vs_demand(v: Views) -> DataFrame:
    return rep.safety_vs_demand(rep.latest_per_sku(v.net, P))


@query("freshness_status")
def freshness_status(v: Views) -> DataFrame:
    """Per user of the event log: marker = newest signup, data times = newest
    purchase / click / view; status of the marker against the data."""
    ev = v.table("events")

    def newest_of(kind):
        return F.max(F.when(F.col("event_type") == kind, F.col("ts")))

    t = ev.groupBy("user_id").agg(newest_of("signup").alias("flag_ts"), newest_of("purchase").alias("json_ts"),
                                  newest_of("click").alias("nd_ts"), newest_of("view").alias("ao_ts"))
    return t.select("user_id", rep.freshness_status("flag_ts", "json_ts", "nd_ts", "ao_ts").alias("status"))


# --- 5. sources, sinks, catalog, master data ------------------------------------------

def _orders_feed(v: Views) -> DataFrame:
    """The order lines in the stores' delivery shape (ORDERS schema fields)."""
    return v.pos.select("order_id", "store_id", "sku", "quantity",
                        F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), P)


def _write_json_arrays(v: Views, path: str) -> None:
    """JSON Lines in folders date=<period>/store=<store>, a line being the array of one order's lines:
    a few rows are gathered per array, and files of any size split by line."""
    lines = F.collect_list(F.struct("order_id", "store_id", "sku", "quantity", "timestamp"))
    arrays = (_orders_feed(v).groupBy(P, "store_id", F.substring_index("order_id", "-", 1).alias("order"))
              .agg(F.to_json(lines).alias("value"))
              .select(F.col(P).cast("string").alias("date"), F.col("store_id").alias("store"), "value"))
    arrays.write.mode("overwrite").partitionBy("date", "store").text(path)


def _feed_result(df: DataFrame, period_col: str) -> DataFrame:
    return df.select("order_id", "store_id", F.col("sku").cast("long").alias("sku"), "quantity", "timestamp",
                     F.col(period_col).cast("int").alias(P))


@query("scan_orders_json")
def scan_orders_json(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "raw_orders")
    _write_json_arrays(v, path)
    back = files.read_json(v.spark, path, schemas.ORDERS, multi_line=False)
    return _feed_result(back, "date")


@query("stream_ingest_orders")
def stream_ingest_orders(v: Views) -> DataFrame:
    """The JSON array files taken in by the incremental (availableNow) ingest."""
    src = scratch_path(v.spark, "raw_orders")
    _write_json_arrays(v, src)
    table, ckpt = scratch_path(v.spark, "raw_orders_table"), scratch_path(v.spark, "stream_ckpt")
    stream = stream_ingest.order_file_stream(v.spark, src, schemas.ORDERS, period=P, date_pattern=r"date=(\d+)",
                                             ext=".txt", multi_line=False)
    stream_ingest.ingest_available(stream, table, ckpt, period=P)
    return _feed_result(v.spark.read.parquet(table), P)


@query("ingest_paths")
def ingest_paths(v: Views) -> DataFrame:
    """Recursive walk over date folders; the period comes from the folder name."""
    path = scratch_path(v.spark, "landing")
    feed = _orders_feed(v).withColumn("day", F.concat(F.col(P).cast("string"), F.lit("-01-01")))
    feed.drop(P).write.mode("overwrite").partitionBy("day").json(path)
    rows, _ = files.ingest_directory(v.spark, path, schemas.ORDERS, fmt="json", period="exec_date",
                                     multi_line=False)
    return _feed_result(rows.withColumn("_y", F.substring("exec_date", 1, 4)), "_y")


@query("ingest_rejects")
def ingest_rejects(v: Views) -> DataFrame:
    """Lines of quantity 13 arrive truncated; they must land in the rejects, the
    rest in the rows -> exec_year, n_rows, n_rejects."""
    path = scratch_path(v.spark, "landing_damaged")
    feed = _orders_feed(v)
    js = F.to_json(F.struct("order_id", "store_id", "sku", "quantity", "timestamp"))
    text = F.when(F.col("quantity") == 13, F.expr("substring(to_json(struct(order_id, store_id, sku, quantity, "
                                                  "timestamp)), 1, 20)")).otherwise(js)
    (feed.select(text.alias("value"), F.concat(F.col(P).cast("string"), F.lit("-01-01")).alias("day"))
     .write.mode("overwrite").partitionBy("day").text(path))
    rows, rejects = files.ingest_directory(v.spark, path, schemas.ORDERS, fmt="json", period="exec_date",
                                           multi_line=False, ext=".txt")
    ok = rows.groupBy("exec_date").agg(F.count(F.lit(1)).alias("n_rows"))
    bad = rejects.groupBy("exec_date").agg(F.count(F.lit(1)).alias("n_rejects"))
    return (ok.join(bad, "exec_date", "full")
            .select(F.substring("exec_date", 1, 4).cast("int").alias(P),
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_rejects", F.lit(0)).alias("n_rejects")))


@query("scan_inventory_csv")
def scan_inventory_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "raw_stock")
    (v.inventory.withColumn("date", F.col(P).cast("string")).drop(P)
     .select("sku", "available_stock", "reserved_stock", "warehouse", "date")
     .write.mode("overwrite").option("header", True).partitionBy("date").csv(path))
    back = files.read_csv(v.spark, path, schemas.INVENTORY)
    return back.select(F.col("sku").cast("long").alias("sku"), F.col("date").cast("int").alias(P), "warehouse",
                       "available_stock", "reserved_stock")


def _net_back(v: Views, path: str) -> DataFrame:
    back = v.spark.read.parquet(path)
    return back.select(*[F.col(c) for c in v.net.columns if c != P], F.col(P).cast("int").alias(P))


@query("roundtrip_parquet")
def roundtrip_parquet(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "net_demand")
    writers.write_partitioned(v.net, path, P)
    return _net_back(v, path)


@query("idempotent_rerun")
def idempotent_rerun(v: Views) -> DataFrame:
    """Write all periods, then re-run the newest period alone (twice): only that
    folder is replaced, the table is unchanged."""
    path = scratch_path(v.spark, "net_demand")
    writers.write_partitioned(v.net, path, P)
    last = v.net.where(F.col(P) == rep.newest(v.net, P))
    writers.write_partitioned(last, path, P)
    writers.write_partitioned(last, path, P)
    return _net_back(v, path)


@query("archive_partition")
def archive_partition(v: Views) -> DataFrame:
    """Archive the newest period of the net-demand table into a second table."""
    base = scratch_path(v.spark, "processed")
    writers.write_partitioned(v.net, f"{base}/net_demand", P)
    newest = v.net.agg(F.max(P)).first()[0]   # one value
    back = writers.archive(v.spark, f"{base}/net_demand", f"{base}/archive/net_demand", [newest], P)
    return back.select(*[F.col(c) for c in v.net.columns if c != P], F.col(P).cast("int").alias(P))


@query("partition_audit")
def partition_audit(v: Views) -> DataFrame:
    base = scratch_path(v.spark, "processed")
    writers.write_partitioned(v.demand, f"{base}/aggregated_orders", P)
    writers.write_partitioned(v.net, f"{base}/net_demand", P)
    a = writers.partition_audit(v.spark, {"aggregated_orders": f"{base}/aggregated_orders",
                                          "net_demand": f"{base}/net_demand"}, P)
    return a.select("table_name", F.col(P).cast("int").alias(P), "row_count")


@query("ensure_tables")
def ensure_tables(v: Views) -> DataFrame:
    """External partitioned table over written files: created, repaired, read."""
    from pyspark.sql import types as T
    path = scratch_path(v.spark, "aggregated_orders")
    writers.write_partitioned(v.demand, path, P)
    name = "aggregated_orders_" + path.rsplit("-", 1)[-1]
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("total_demand", T.LongType()),
                           T.StructField(P, T.StringType())])
    catalog.ensure_table(v.spark, "processed", name, schema, path, [P], recreate=True)
    t = v.spark.table(f"processed.{name}")
    return t.select(F.col(P).cast("int").alias(P), "sku", "total_demand")


@query("ctas_if_absent")
def ctas_if_absent(v: Views) -> DataFrame:
    """Create-if-absent twice: the second (different) result is ignored."""
    path = scratch_path(v.spark, "aggregated_orders")
    writers.write_if_absent(v.demand, path)
    writers.write_if_absent(v.demand.withColumn("total_demand", F.col("total_demand") + 1), path)
    return v.spark.read.parquet(path).select(P, "sku", "total_demand")


@query("master_insert_if_absent")
def master_insert_if_absent(v: Views) -> DataFrame:
    """Seed with even SKUs, then insert every product with pack_size + 1: existing rows win."""
    existing = v.products.where(F.col("sku") % 2 == 0)
    incoming = v.products.withColumn("pack_size", (F.col("pack_size") + 1).cast("int"))
    return mst.insert_if_absent(existing, incoming, ["sku"], order_by="pack_size")


@query("qc_master_duplicates")
def qc_master_duplicates(v: Views) -> DataFrame:
    ps = v.product_suppliers
    return mst.duplicate_keys(ps.unionByName(ps.where(F.col("sku") % 50 == 0)), ["sku", "supplier_id"])


@query("qc_master_orphans")
def qc_master_orphans(v: Views) -> DataFrame:
    return mst.orphans(v.product_suppliers, [("sku", v.products, "unknown_product"),
                                             ("supplier_id", v.suppliers, "unknown_supplier")],
                       ["sku", "supplier_id"])


def _write_delivery(v: Views, root: str) -> None:
    """The feed of all periods as stores deliver it, one day per period: JSON Lines parts in a folder per
    store, every record of quantity 13 cut short; the stock snapshot with its columns in another order
    than declared."""
    feed = _orders_feed(v)
    day = F.concat(F.col(P).cast("string"), F.lit("-01-01")).alias("day")
    text = F.to_json(F.struct("order_id", "store_id", "sku", "quantity", "timestamp"))
    (feed.select(F.when(F.col("quantity") == 13, F.substring(text, 1, 20)).otherwise(text).alias("value"), day,
                 F.col("store_id").alias("store"))
     .write.partitionBy("day", "store").text(f"{root}/orders"))   # Spark names text files .txt
    (v.inventory_text.select("warehouse", "reserved_stock", "available_stock", "sku", day)
     .write.option("header", True).partitionBy("day").csv(f"{root}/stock"))


@query("daily_run")
def daily_run(v: Views) -> DataFrame:
    """The whole run over a written feed, all periods in one backfill -> per period: rows read and
    rejected, SKUs demanded, net-demand rows with quantity and cost, items and suppliers exported, stores
    missing, and the report's totals."""
    from replenix.plans import pipeline

    def texts(df, *keys):   # the delivered keys are text; padded, so that they sort as the numbers do
        return df.withColumns({k: F.lpad(F.col(k).cast("string"), 12, "0") if k == "supplier_id"
                               else F.col(k).cast("string") for k in keys})

    root = scratch_path(v.spark, "delivery")
    _write_delivery(v, f"{root}/raw")
    days = [f"{r[0]}-01-01" for r in v.years.collect()]   # the calendar
    cfg = pipeline.Config(
        orders_root=f"{root}/raw/orders", stock_root=f"{root}/raw/stock", out_base=f"{root}/out",
        products=texts(v.products, "sku"), suppliers=texts(v.suppliers, "supplier_id"),
        product_suppliers=texts(v.product_suppliers, "sku", "supplier_id"), expected_stores=expected_stores(),
        expected_skus=texts(v.expected_skus, "sku"), date_folder="day={}", orders_ext=".txt", archive_base=f"{root}/archive",
        table_suffix="_" + root.rsplit("-", 1)[-1])
    out = pipeline.run(v.spark, cfg, days[0], clock=fixed_clock(), dates=days)
    missing = (out["report"].where("check = 'missing_pos_files' and level = 'ERROR'")
               .groupBy("exec_date").agg(F.count(F.lit(1)).alias("missing_stores")))
    return (out["metrics"].join(missing, "exec_date", "left").join(out["summary"], "exec_date")
            .select(F.substring("exec_date", 1, 4).cast("int").alias(P), "raw_rows", "rejected_rows", "aggregated_skus",
                    "sku_count", "total_qty", "total_cost", "exported_items", "exported_suppliers",
                    "archived_rows", F.coalesce("missing_stores", F.lit(0).cast("long")).alias("missing_stores"),
                    "errors", "warnings", "infos"))


@query("orders_newest_first")
def orders_newest_first(v: Views) -> DataFrame:
    """O2: the order lines as a load ordered by time."""
    return rep.newest_first(v.pos_lines.select("order_id", "sku", "quantity", "order_ts"), "order_ts", "order_id")


@query("qc_master_nulls")
def qc_master_nulls(v: Views) -> DataFrame:
    """NOT NULL columns of the product master that are NULL."""
    return mst.null_violations(v.products, ["sku", "name", "pack_size", "moq", "safety_stock"], ["sku"])


@query("pipeline_freshness")
def pipeline_freshness(v: Views) -> DataFrame:
    """A4 and B6 over the real inputs: newest period of the four tables, and the status of the run log's
    marker against the newest file of the written tables and order records."""
    base = scratch_path(v.spark, "fresh")
    tables = {"orders": v.pos.select("order_id", "sku", "quantity", P), "inventory": v.inventory, "aggregated_orders": v.demand,
              "net_demand": v.net}
    for name, df in tables.items():
        writers.write_partitioned(df, f"{base}/{name}", P)
    back = {n: v.spark.read.parquet(f"{base}/{n}").withColumn(P, F.col(P).cast("int")) for n in tables}
    # the records of every order, from the net demand just written
    writers.write_documents(ords.order_records(ords.order_lines(back["net_demand"], v.names, P), P), f"{base}/documents", P)
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writers.append_run_log(v.spark, f"{base}/run_log", v.spark.range(1).select(stamp.alias("run_at")))
    times = [rep.newest_file_time(v.spark, f"{base}/{n}") for n in tables]
    times.append(rep.newest_file_time(v.spark, f"{base}/documents", "json"))
    fresh = rep.pipeline_freshness(v.spark, writers.read_run_log(v.spark, f"{base}/run_log"), times)
    return rep.table_maxima(back, P).withColumn("status", fresh.select("status").scalar())


@query("scan_orders_json_split")
def scan_orders_json_split(v: Views) -> DataFrame:
    """S1 over one array file per period and store, indented as exports are, read in byte ranges."""
    path = scratch_path(v.spark, "array_files")
    key, line = (F.substring_index("order_id", "-", at).cast("decimal(20,0)") for at in (1, -1))
    feed = _orders_feed(v).select(F.col(P).cast("string").alias("date"), F.col("store_id").alias("store"), "order_id", "store_id",
                                  "sku", "quantity", "timestamp", (key * F.lit(1 << 31).cast("decimal(10,0)") + line).alias("place"))
    heads = scratch_path(v.spark, "array_heads")   # a row per file, found by numbers alone: nothing is sorted for it
    feed.groupBy("date", "store").agg(F.min("place").alias("first")).write.parquet(heads)
    first = v.spark.read.parquet(heads)
    at = F.when(F.col("place") == F.col("first"), 1).otherwise(2).alias("at")
    rows = feed.join(F.broadcast(first), ["date", "store"]).select(at, *feed.drop("place").columns)
    for at in (0, 3):
        rows = rows.unionByName(first.select(F.lit(at).alias("at"), "date", "store"), allowMissingColumns=True)
    # columns are dealt and sorted, and become text behind it; a task has few files to write
    one = F.to_json(F.struct("order_id", "store_id", "sku", "quantity", "timestamp"), {"pretty": "true"})
    value = F.when(F.col("at") == 0, "[").when(F.col("at") == 3, "]").when(F.col("at") == 1, one).otherwise(F.concat(F.lit(","), one))
    (rows.repartition(max(4 * first.count(), 1), "date", "store").sortWithinPartitions("date", "store", "at")
     .select("date", "store", value.alias("value")).write.partitionBy("date", "store").text(path))
    found = json_split.json_records(v.spark, path).withColumn("date", F.regexp_extract("path", r"/date=(\d+)/", 1)).drop("path")
    return _feed_result(json_split.parsed(found, schemas.ORDERS), "date")


@query("snapshot_publish")
def snapshot_publish(v: Views) -> DataFrame:
    """Two tables published together, then the newest period of both again with changed sums: rows and sums of either
    version, the older one read by its number."""
    base = scratch_path(v.spark, "published")
    net = v.net.select("sku", "total_demand", "final_order_qty", P)
    one = snapshots.publish(v.spark, base, {"demand": v.demand, "net_demand": net}, P)
    newest = F.col(P) == rep.newest(v.demand, P)
    two = snapshots.publish(v.spark, base, {
        "demand": v.demand.where(newest).withColumn("total_demand", F.col("total_demand") + 1),
        "net_demand": net.where(newest).withColumn("total_demand", F.col("total_demand") + 1)}, P)
    out = None
    for seen in (one, two):
        for name, df in (("demand", v.demand), ("net_demand", net)):
            back = snapshots.read(v.spark, base, name, df.schema, P, seen.number)
            part = (back.groupBy(P).agg(F.count(F.lit(1)).alias("row_count"), F.sum("total_demand").alias("total_demand"))
                    .select(F.lit(seen.number).alias("version"), F.lit(name).alias("table_name"), P, "row_count", "total_demand"))
            out = part if out is None else out.unionByName(part)
    return out


@query("archive_digest")
def archive_digest(v: Views) -> DataFrame:
    """Content digests of the demand and of the net demand (money as exact cents) per period, from written tables."""
    base = scratch_path(v.spark, "digests")
    net = v.net.select("sku", "supplier_id", "total_demand", "raw_demand", "final_order_qty",
                       F.col("unit_cost").cast("decimal(10,2)").alias("unit_cost"), "safety_stock", P)
    out = None
    for name, df in (("aggregated_orders", v.demand), ("net_demand", net)):
        writers.write_partitioned(df, f"{base}/{name}", P)
        found = digest.content_digest(v.spark.read.parquet(f"{base}/{name}"), P)
        part = found.select(F.lit(name).alias("table_name"), F.col(P).cast("int").alias(P), "row_count", "digest")
        out = part if out is None else out.unionByName(part)
    return out


@query("audited_master_load")
def audited_master_load(v: Views) -> DataFrame:
    """A price list whose rows all refer to known products and suppliers is published; the whole list with some rows
    repeated is refused.  The published rows (rule 'published') and what was found in the refused load."""
    base = scratch_path(v.spark, "audited")
    rules = audit.Constraints(["sku", "supplier_id"], ["unit_cost", "priority"],
                              [("sku", v.products, "unknown_product"), ("supplier_id", v.suppliers, "unknown_supplier")])
    clean = (v.product_suppliers.where("priority is not null").join(v.products.select("sku"), "sku", "left_semi")
             .join(v.suppliers.select("supplier_id"), "supplier_id", "left_semi").select(*v.product_suppliers.columns))
    audit.audited_load(v.spark, base, "product_suppliers", clean, rules, f"{base}-rejects/1")
    repeated = v.product_suppliers.unionByName(v.product_suppliers.where(F.col("sku") % 50 == 0))
    _, found = audit.audited_load(v.spark, base, "product_suppliers", repeated, rules, f"{base}-rejects/2")
    published = audit.read_master(v.spark, base, "product_suppliers", v.product_suppliers.schema)
    return published.select("sku", "supplier_id", F.lit("published").alias("rule")).unionByName(found.select("sku", "supplier_id", "rule"))


@query("net_demand_incremental")
def net_demand_incremental(v: Views) -> DataFrame:
    """Net demand kept up to date: the feed first comes without the lines of quantity 13 and with those of 7 as 70, the
    price list without supplier ids divisible by 5; then the late lines, the corrections and the missing prices arrive."""
    base = scratch_path(v.spark, "incremental")
    lines = v.pos_lines.select("sku", "quantity", P)
    late, wrong = F.col("quantity") == 13, F.col("quantity") == 7
    first = lines.where(~late).withColumn("quantity", F.when(wrong, 70).otherwise(F.col("quantity")).cast("int"))
    corrections = lines.where(wrong).withColumn("sign", F.lit(1))
    changes = (corrections.unionByName(corrections.withColumn("quantity", F.lit(70)).withColumn("sign", F.lit(-1)))
               .unionByName(lines.where(late).withColumn("sign", F.lit(1))))
    new_prices = F.col("supplier_id") % 5 == 0

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return v.spark.read.schema(df.schema).parquet(f"{base}/{name}")

    state = kept(incremental.demand_state(first, P), "demand-0")
    stock = kept(incremental.stock_state(v.inventory, P), "stock-0")
    preferred = kept(sup.preferred_suppliers(v.product_suppliers.where(~new_prices)), "preferred-0")
    as_stock = stock.select(P, "sku", *[F.col(c).cast("int").alias(c) for c in ("available_stock", "reserved_stock")])
    net = kept(mrp.net_demand(state.drop(incremental.LINES), as_stock, sup.supplier_master(v.products, preferred), P), "net-0")

    change = kept(incremental.demand_state(changes, P, "sign"), "change-1")
    prices = kept(v.product_suppliers.where(new_prices), "prices-1")
    state = kept(incremental.merge(state, change, [P, "sku"]), "demand-1")
    preferred = kept(incremental.merge_preferred(preferred, v.product_suppliers, prices), "preferred-1")
    groups = incremental.touched(change, columns=[P, "sku"])
    return incremental.merge_net(net, state, stock, sup.supplier_master(v.products, preferred), groups,
                                 prices.select("sku").distinct(), P)


@query("round_half_even")
def round_half_even(v: Views) -> DataFrame:
    """line prices after discount and tax, as doubles, rounded to cents by their exact binary value."""
    x = F.col("l_extendedprice").cast("double") * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double"))
    return v.table("lineitem").select("l_orderkey", "l_linenumber", half_even(x, 2).alias("charge"), half_even(x / 8, 0).alias("eighth"))


@query("stream_latest_per_sku")
def stream_latest_per_sku(v: Views) -> DataFrame:
    """A14 as a stream: the net demand arrives in two rounds, the newest periods first; the second round goes on from
    the checkpoint of the first, and its older rows must not replace newer ones."""
    base = scratch_path(v.spark, "stream_latest")
    schema, middle = v.net.schema, F.lit(POS_YEAR)
    for later in (True, False):
        v.net.where((F.col(P) >= middle) == later).write.mode("append").parquet(f"{base}/arriving")
        rows = v.spark.readStream.schema(schema).parquet(f"{base}/arriving")
        stream_latest.keep_latest(stream_latest.latest_stream(rows, "sku", [P]), f"{base}/latest", f"{base}/checkpoint")
    return stream_latest.read_latest(v.spark, f"{base}/latest", schema, "sku", [P])


@query("dropped_skus_bloom")
def dropped_skus_bloom(v: Views) -> DataFrame:
    return bloom.dropped_skus(v.demand, v.stock, v.products, v.preferred, v.suppliers, P)


@query("bucketed_order_lines")
def bucketed_order_lines(v: Views) -> DataFrame:
    """J4 on a co-located layout: order lines and orders in buckets of the order key, joined without a shuffle."""
    lines, orders = _bucketed(v, scratch_path(v.spark, "buckets"))
    return lines.join(orders, "order_key").select("order_id", "store_id", "sku", "quantity", P)


def _bucketed(v: Views, base: str, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    lines = v.table("lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("int").alias("quantity"), F.year("l_shipdate").cast("int").alias(P))
    orders = v.table("orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.concat(F.lit("STORE_"), (F.col("o_custkey") % STORE_COUNT).cast("string")).alias("store_id"))
    suffix = base.rsplit("-", 1)[-1]
    return tuple(catalog.write_bucketed(df, "layout", f"{name}_{suffix}", f"{base}/{name}", "order_key", buckets)
                 for name, df in (("lines", lines), ("orders", orders)))


@query("clustered_net_demand")
def clustered_net_demand(v: Views) -> DataFrame:
    """The net demand written along a curve over SKU and period, and read back."""
    path = scratch_path(v.spark, "clustered")
    layout.write_clustered(v.net, path, ["sku", P], files=8)
    return v.spark.read.schema(v.net.schema).parquet(path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, _fn=fn: _fn(Views(spark, sf_dir))) for k, fn in QUERIES.items()}
