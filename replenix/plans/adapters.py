"""Adapter views: the driver's TPC-H-like tables re-shaped into the
replenishment domain (stores' order lines, stock snapshots, master data).

Integer arithmetic and exact decimals only, so any SQL engine gives the same
values.  The period column is ``exec_year``.  Every view is lazy; nothing is
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PERIOD = "exec_year"

# fixed values: adapter parameters
STORE_COUNT = 7            # store id = customer % 7  ->  STORE_0 … STORE_6
WAREHOUSES = (0, 1)        # WH_1 only for even SKUs
POS_YEAR = 1997            # the single period of the filtered scan
PARTS_PER_TASK = 50_000    # parts whose stock rows one task makes
LINES_PER_TASK = 500_000     # order lines that one task joins with their orders, or sorts by part
SUPPLIER_SHARES = 4        # tasks that the lines of one part may be in


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, opened once per session (file listing and schema read once),
    as a catalog table would be.  The inputs are read-only."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df


def pos(spark: SparkSession, sf_dir: str, with_store: bool = True) -> DataFrame:
    """Order lines: order_id, [store_id], sku, quantity, order_ts, exec_year.

    The store is the ordering customer's; when it is not needed the orders table
    is only checked for existence (semi join on its key, o_orderkey being unique),
    so a demand scan ships 3 columns instead of a joined row.
    """
    li = table(spark, sf_dir, "lineitem")
    lines = li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_orderkey").alias("_ok"),
        F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("order_ts"),
        F.year("l_shipdate").cast("int").alias(PERIOD),
    )
    orders = table(spark, sf_dir, "orders")
    # a task sorts its lines and then adds them up: as many tasks as the lines (counted in the file footers) ask for, where
    # the session's number would give it more
    tasks = -(-li.count() // LINES_PER_TASK)
    many = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))

    def by_order(df: DataFrame) -> DataFrame:
        return df.repartition(tasks, "_ok") if many else df

    lines = by_order(lines)
    if with_store:
        o = by_order(orders.select(
            F.col("o_orderkey").alias("_ok"),
            F.concat(F.lit("STORE_"), (F.col("o_custkey") % STORE_COUNT).cast("string")).alias("store_id")))
        out = lines.join(o, "_ok")
        cols = ["order_id", "store_id", "sku", "quantity", "order_ts", PERIOD]
    else:
        out = lines.join(by_order(orders.select(F.col("o_orderkey").alias("_ok"))), "_ok", "left_semi")
        cols = ["order_id", "sku", "quantity", "order_ts", PERIOD]
    return out.select(*cols)


def years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period calendar: distinct years of the sales feed (bounded by the calendar)."""
    return (table(spark, sf_dir, "lineitem")
            .select(F.year("l_shipdate").cast("int").alias(PERIOD)).distinct())


def years_array(spark: SparkSession, sf_dir: str):
    """The period calendar as one sorted array value (a scalar subquery column).

    Each task contributes at most one entry per year, so the value is bounded by
    the number of periods, never by the data size.
    """
    return (table(spark, sf_dir, "lineitem")
            .agg(F.sort_array(F.collect_set(F.year("l_shipdate").cast("int"))))
            .scalar())


def dealt(parts: DataFrame) -> DataFrame:
    """The parts in as many tasks as their number asks for: every part becomes a row per period and warehouse, and a
    task that reads a whole row group would sort or group all of those.  The count comes from the file footers."""
    tasks = -(-parts.count() // PARTS_PER_TASK)
    return parts.repartition(tasks, "p_partkey") if tasks > 1 else parts


def dealt_lines(lines: DataFrame) -> DataFrame:
    """The order lines by part in as many tasks as their number asks for, a part's suppliers in a few of them: the choice
    of a supplier compares structs, so Spark sorts all lines of a task first, and a task that reads a file's share would
    sort all of that.  The count comes from the file footers."""
    tasks = -(-lines.count() // LINES_PER_TASK)
    share = F.pmod("l_suppkey", F.lit(SUPPLIER_SHARES))
    return lines.repartition(tasks, F.col("l_partkey"), share) if tasks > 1 else lines


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock snapshot rows: sku, exec_year, warehouse, available_stock, reserved_stock.

    One row per (sku, period, warehouse); the period and warehouse lists are
    bounded, so each part row fans out by a fixed small factor (generator, no join).
    """
    p = dealt(table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("sku"))
    y = F.col(PERIOD).cast("long")
    w = F.col("w").cast("long")
    return (p.where(F.col("sku") % 29 != 0)
            .select("sku", F.explode(years_array(spark, sf_dir)).alias(PERIOD))
            .select("sku", PERIOD, F.explode(F.array(*[F.lit(x) for x in WAREHOUSES])).alias("w"))
            .where((F.col("w") == 0) | (F.col("sku") % 2 == 0))
            .select(
                "sku", PERIOD,
                F.concat(F.lit("WH_"), F.col("w").cast("string")).alias("warehouse"),
                F.when(F.col("sku") % 97 == 5, F.lit(-3))
                 .otherwise(40 + (F.col("sku") * 37 + y * 11 + w * 5) % 81).cast("int").alias("available_stock"),
                F.when(F.col("sku") % 31 == 3, F.lit(130))
                 .otherwise(5 + (F.col("sku") * 13 + y * 7 + w * 3) % 21).cast("int").alias("reserved_stock"),
            ))


def inventory_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as raw CSV text; SKUs divisible by 71 carry an unparsable
    available_stock ('<n>x'), as a damaged file would."""
    inv = inventory(spark, sf_dir)
    bad = F.col("sku") % 71 == 0
    return inv.select(
        "sku", PERIOD, "warehouse",
        F.when(bad, F.concat(F.col("available_stock").cast("string"), F.lit("x")))
         .otherwise(F.col("available_stock").cast("string")).alias("available_stock"),
        F.col("reserved_stock").cast("string").alias("reserved_stock"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master: sku, name, pack_size, moq, safety_stock (NULL for some)."""
    p = table(spark, sf_dir, "part")
    pack = (4 + F.col("p_size") % 9)
    return (p.where(F.col("p_partkey") % 41 != 0)
            .select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"),
                    pack.cast("int").alias("pack_size"), (2 * pack).cast("int").alias("moq"),
                    F.when(F.col("p_partkey") % 53 == 0, F.lit(None).cast("int"))
                     .otherwise(F.col("p_size")).alias("safety_stock")))


def product_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sku x supplier price list: unit_cost DECIMAL(10,2), priority (NULL for some, many ties)."""
    pairs = (dealt_lines(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))
             .select(F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("supplier_id")).distinct())
    cents = 50 + (F.col("sku") * 7 + F.col("supplier_id") * 13) % 400
    return pairs.select(
        "sku", "supplier_id",
        (cents.cast("decimal(10,0)") / 100).cast("decimal(10,2)").alias("unit_cost"),
        F.when(F.col("supplier_id") % 11 == 0, F.lit(None).cast("int"))
         .otherwise((1 + F.col("supplier_id") % 3).cast("int")).alias("priority"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return (s.where(F.col("s_suppkey") % 37 != 4)
            .select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
                    F.concat(F.lit("orders"), F.col("s_suppkey").cast("string"),
                             F.lit("@example.com")).alias("contact_email")))


def expected_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every SKU the business expects to see (the whole part catalogue)."""
    return dealt(table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("sku"))


def expected_stores() -> list[str]:
    # fixed values: the stores expected to report every period (one more than exist)
    return [f"STORE_{i}" for i in range(STORE_COUNT + 1)]
