"""Data-quality checks (B4) and the exception report.

Five checks per period, each a DataFrame job over whole tables:

1 missing_pos_files        no orders for the period -> one ERROR; else one ERROR per
                           expected store that sent nothing; INFO only when the stores
                           found equal the expected ones (extra stores: neither)
2 missing_inventory        no snapshot -> ERROR, else INFO
3 missing_supplier_mapping expected SKU not in products -> ERROR each; product lacking
                           a required field -> ERROR each; else INFO (period independent)
4 demand_spike             only with orders: SKU total > threshold -> WARNING each, else INFO
5 inventory_inconsistency  only with a snapshot: expected SKU absent -> WARNING; per row
                           reserved > available -> WARNING, a negative value -> ERROR (both
                           can fire), unparsable -> ERROR; else INFO

Each detail table is one row per finding; the summary is built from per-period
counts (one row per period per table), never by gathering findings in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replenix import DEFAULT_PERIOD
from replenix.functions.exprs import ERROR, INFO, WARNING, missing_keys

# fixed values: check names, in report order
CHECKS = ["missing_pos_files", "missing_inventory", "missing_supplier_mapping", "demand_spike",
          "inventory_inconsistency"]
# fixed values: required product fields and the spike threshold
REQUIRED_PRODUCT_FIELDS = ["sku", "supplier_id", "pack_size", "moq", "safety_stock"]
DEMAND_SPIKE_THRESHOLD = 200

# message templates (configurable; reports are compared on check, level and detail)
MESSAGES = {
    "orders_absent": "Order files missing for %s",
    "store_missing": "POS file missing: %s",
    "stores_ok": "All POS files present",
    "inventory_absent": "Inventory snapshot missing for %s",
    "inventory_ok": "Inventory snapshot present",
    "sku_unmapped": "SKU without supplier: %s",
    "fields_missing": "Missing fields for %s: %s",
    "products_absent": "Products file missing",
    "mapping_ok": "All SKUs have a valid supplier",
    "spike": "Demand spike for %s: %s units (threshold=%s)",
    "no_spike": "No demand spike",
    "sku_not_in_inventory": "SKU missing from inventory snapshot: %s",
    "reserved_gt_available": "Reserved stock > available for %s",
    "negative": "Negative inventory value for %s",
    "invalid": "Invalid inventory data for %s",
    "inventory_consistent": "Inventory consistent",
}


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# --- check 1 ---------------------------------------------------------------------

def stores_found(orders: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    return orders.select(period, "store_id").distinct()


def missing_stores(found: DataFrame, expected_stores: list[str], period: str = DEFAULT_PERIOD) -> DataFrame:
    """Expected stores without orders in a period that has orders -> period, store_id."""
    expected = F.array(*[F.lit(s) for s in expected_stores])
    wanted = found.select(period).distinct().select(period, F.explode(expected).alias("store_id"))
    return wanted.join(found, [period, "store_id"], "left_anti")


# --- check 2 ---------------------------------------------------------------------

def missing_inventory(periods: DataFrame, inventory: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """-> period, level (ERROR: no snapshot rows for the period, INFO: present)."""
    have = inventory.select(period).distinct().withColumn("_has", F.lit(True))
    return (periods.join(have, period, "left")
            .select(period, F.when(F.col("_has").isNull(), F.lit(ERROR)).otherwise(F.lit(INFO)).alias("level")))


# --- check 3 ---------------------------------------------------------------------

def unmapped_skus(expected_skus: DataFrame, products: DataFrame) -> DataFrame:
    return expected_skus.select("sku").distinct().join(products.select("sku"), "sku", "left_anti")


def product_documents(products: DataFrame, preferred: DataFrame) -> DataFrame:
    """Products as JSON text, the way a master-data file carries them: absent
    (NULL) fields are left out of the object -> sku, value."""
    p = products.join(preferred.select("sku", "supplier_id"), "sku", "left")
    return p.select("sku", F.to_json(F.struct("sku", "name", "supplier_id", "pack_size", "moq",
                                               "safety_stock")).alias("value"))


def missing_fields(product_docs: DataFrame, required: list[str] = REQUIRED_PRODUCT_FIELDS) -> DataFrame:
    """Products whose JSON object lacks required keys -> sku, missing ('a,b' sorted)."""
    m = product_docs.select("sku", missing_keys("value", required).alias("missing"))
    return m.where(F.col("missing") != "")


# --- check 4 ---------------------------------------------------------------------

def demand_spikes(orders: DataFrame, threshold: int = DEMAND_SPIKE_THRESHOLD,
                  period: str = DEFAULT_PERIOD) -> DataFrame:
    """SKU totals above the threshold (strictly) -> period, sku, total_demand.
    A missing quantity counts 0; a missing sku is its own (NULL) group."""
    d = orders.groupBy(period, "sku").agg(
        F.sum(F.coalesce(F.col("quantity").cast("long"), F.lit(0))).alias("total_demand"))
    return d.where(F.col("total_demand") > threshold)


# --- check 5 ---------------------------------------------------------------------

def int_text(c: str) -> Column:
    """Integer text as a Python ``int()`` reads it: an optional sign, digit groups
    joined by single underscores ('1_000'), blanks around; anything else
    (decimals, exponents, empty text) and values outside INTEGER give NULL."""
    ok = F.col(c).rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
    return F.when(ok, F.regexp_replace(F.col(c), r"[_\s]", "").try_cast("int"))


def parsed_inventory(inventory_text: DataFrame) -> DataFrame:
    """Text snapshot with parsed values; ``valid`` is false when either value does
    not parse as an integer (see ``int_text``)."""
    a = int_text("available_stock")
    r = int_text("reserved_stock")
    return (inventory_text.withColumn("_avail", a).withColumn("_resv", r)
            .withColumn("valid", F.col("_avail").isNotNull() & F.col("_resv").isNotNull()))


def skus_missing_in_inventory(expected_skus: DataFrame, inventory: DataFrame,
                              period: str = DEFAULT_PERIOD, snapshots: DataFrame | None = None) -> DataFrame:
    """Expected SKUs absent from a period's snapshot (periods with a snapshot only).

    One row per SKU holds the periods it was found in (bounded by the calendar); what the
    list of snapshot periods has beyond them are the gaps, and only gaps become rows.
    ``snapshots`` (period) lists the periods whose snapshot file exists, when that is known
    from the files (an empty snapshot misses every SKU); else the periods with rows.
    """
    src = snapshots if snapshots is not None else inventory
    snap_periods = src.agg(F.sort_array(F.collect_set(period))).scalar()
    found = inventory.groupBy("sku").agg(F.collect_set(period).alias("_found"))
    gaps = F.array_except(snap_periods, F.coalesce("_found", F.array()))
    return (expected_skus.select("sku").distinct().join(found, "sku", "left")
            .select("sku", F.explode(gaps).alias(period)).select(period, "sku"))


def inventory_findings(parsed: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """Row-level findings of check 5 -> period, sku, warehouse, level, rule.

    A row with both reserved > available and a negative value gives two findings;
    an unparsable row gives one 'invalid' finding and no other.
    """
    rules = F.array(
        F.when(~F.col("valid"), F.struct(F.lit(ERROR).alias("level"), F.lit("invalid").alias("rule"))),
        F.when(F.col("valid") & (F.col("_resv") > F.col("_avail")),
               F.struct(F.lit(WARNING).alias("level"), F.lit("reserved_gt_available").alias("rule"))),
        F.when(F.col("valid") & ((F.col("_avail") < 0) | (F.col("_resv") < 0)),
               F.struct(F.lit(ERROR).alias("level"), F.lit("negative").alias("rule"))),
    )
    hits = parsed.select(period, "sku", "warehouse", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("f"))
    return hits.select(period, "sku", "warehouse", "f.level", "f.rule")


# --- report ----------------------------------------------------------------------

def orders_rollup(orders: DataFrame, period: str = DEFAULT_PERIOD, stores: DataFrame | None = None,
                  folders: DataFrame | None = None) -> DataFrame:
    """The one aggregate of the orders that checks 1 and 4 need, in one pass:
    GROUPING SETS ((period, store_id), (period, sku)) with the quantity summed.

    -> period, store_id, sku, quantity, kind ('store': one row per store that
    sent orders, sku NULL; 'sku': the period total of one SKU over all stores,
    store_id NULL).  Both kinds come from one scan, one partial aggregation and
    one shuffle; a NULL sku or store stays its own group (told apart by the
    grouping id, not by the NULL).

    File-level presence, as the source checks it: ``stores`` (period, store_id)
    lists the store files found (an empty file still counts) and replaces the
    stores seen in the rows; ``folders`` (period) lists the date folders that
    exist, each adding a 'folder' row, so a period whose folder exists but holds
    no file still counts as delivered.
    """
    if stores is None:
        g = (orders.groupingSets([[period, "store_id"], [period, "sku"]], period, "store_id", "sku")
             .agg(F.sum(F.coalesce(F.col("quantity").cast("long"), F.lit(0))).alias("quantity"),
                  F.grouping_id().alias("_gid")))
        kind = F.when(F.col("_gid") == 1, F.lit("store")).otherwise(F.lit("sku"))
        out = g.select(period, "store_id", "sku", "quantity", kind.alias("kind"))
    else:
        sku_t, store_t = orders.schema["sku"].dataType, orders.schema["store_id"].dataType
        skus = (orders.groupBy(period, "sku")
                .agg(F.sum(F.coalesce(F.col("quantity").cast("long"), F.lit(0))).alias("quantity"))
                .select(period, F.lit(None).cast(store_t).alias("store_id"), "sku", "quantity",
                        F.lit("sku").alias("kind")))
        found = (stores.select(period, F.col("store_id").cast(store_t).alias("store_id")).distinct()
                 .select(period, "store_id", F.lit(None).cast(sku_t).alias("sku"),
                         F.lit(None).cast("long").alias("quantity"), F.lit("store").alias("kind")))
        out = skus.unionByName(found)
    if folders is not None:
        out = out.unionByName(folders.select(period).distinct().select(
            period, F.lit(None).cast(out.schema["store_id"].dataType).alias("store_id"),
            F.lit(None).cast(out.schema["sku"].dataType).alias("sku"),
            F.lit(None).cast("long").alias("quantity"), F.lit("folder").alias("kind")))
    return out


def rollup_stores(rollup: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """(period, store_id) of every store with orders, from ``orders_rollup``."""
    return rollup.where(F.col("kind") == "store").select(period, "store_id")


def rollup_spikes(rollup: DataFrame, threshold: int = DEMAND_SPIKE_THRESHOLD,
                  period: str = DEFAULT_PERIOD) -> DataFrame:
    """SKU totals above the threshold from ``orders_rollup`` -> period, sku, total_demand."""
    return (rollup.where((F.col("kind") == "sku") & (F.col("quantity") > threshold))
            .select(period, "sku", F.col("quantity").alias("total_demand")))


def report_counts(periods: DataFrame, orders: DataFrame, parsed_inv: DataFrame, expected_skus: DataFrame,
                  products: DataFrame, product_docs: DataFrame, expected_stores: list[str],
                  threshold: int = DEMAND_SPIKE_THRESHOLD, period: str = DEFAULT_PERIOD,
                  rollup: DataFrame | None = None, snapshots: DataFrame | None = None,
                  products_absent: bool = False) -> DataFrame:
    """Per period: how many findings of each kind (the inputs of the summary).

    ``snapshots`` (period): the periods whose snapshot file exists, when known from
    the files — a snapshot with no row is then present (check 2 INFO) and misses
    every expected SKU; without it a period has a snapshot when it has rows.

    The order side is one chain: ``orders_rollup`` and then one aggregate per
    period counting both kinds of rows, so the orders are read once.  Pass
    ``rollup`` to reuse one already built (e.g. checkpointed).
    """
    exp = F.array(*[F.lit(s) for s in expected_stores])
    r = rollup if rollup is not None else orders_rollup(orders, period)
    is_store = F.col("kind") == "store"
    order_side = (r.groupBy(period)
                  .agg(F.count_if(is_store & F.array_contains(exp, F.col("store_id"))).alias("n_found_expected"),
                       F.count_if(is_store & ~F.array_contains(exp, F.col("store_id"))).alias("n_extra"),
                       F.count_if((F.col("kind") == "sku") & (F.col("quantity") > threshold)).alias("n_spikes"))
                  .withColumn("has_orders", F.lit(True)))
    # one pass over the snapshot: row findings, and the expected SKUs it holds.  The SKUs
    # absent from a snapshot are counted as n_expected minus those, without pairing
    # every expected SKU with every period (the entries need the rows; the counts don't)
    exp_skus = expected_skus.select("sku").distinct()
    n_expected = exp_skus.agg(F.count(F.lit(1))).scalar()
    flagged = parsed_inv.join(exp_skus.withColumn("_expected", F.lit(True)), "sku", "left")
    inv = (flagged.groupBy(period)
           .agg(F.count(F.lit(1)).alias("n_inv_rows"),
                F.count_if(~F.col("valid")).alias("n_invalid"),
                F.count_if(F.col("valid") & (F.col("_resv") > F.col("_avail"))).alias("n_reserved_gt"),
                F.count_if(F.col("valid") & ((F.col("_avail") < 0) | (F.col("_resv") < 0))).alias("n_negative"),
                F.count_distinct(F.when(F.col("_expected"), F.col("sku"))).alias("_n_present")))
    if snapshots is None:
        inv = inv.withColumn("_has_snapshot", F.col("n_inv_rows") > 0)
    else:
        inv = (snapshots.select(period).distinct().withColumn("_has_snapshot", F.lit(True))
               .join(inv, period, "full"))
    inv = inv.withColumn("n_sku_absent", F.when(F.col("_has_snapshot"),
                                                n_expected - F.coalesce(F.col("_n_present"), F.lit(0))))
    if products_absent:   # one ERROR stands for the whole of check 3
        n_unmapped, n_fields = F.lit(1).cast("long"), F.lit(0).cast("long")
    else:
        n_unmapped = unmapped_skus(expected_skus, products).agg(F.count(F.lit(1))).scalar()
        n_fields = missing_fields(product_docs).agg(F.count(F.lit(1))).scalar()
    z = F.lit(0).cast("long")
    return (periods.select(period).distinct()
            .join(order_side, period, "left")
            .join(inv, period, "left")
            .select(period,
                    F.coalesce("has_orders", F.lit(False)).alias("has_orders"),
                    (F.lit(len(expected_stores)) - F.coalesce("n_found_expected", z)).alias("n_missing_stores"),
                    F.coalesce("n_extra", z).alias("n_extra"),
                    F.coalesce("n_spikes", z).alias("n_spikes"),
                    F.coalesce("_has_snapshot", F.lit(False)).alias("has_inventory"),
                    F.coalesce("n_invalid", z).alias("n_invalid"),
                    F.coalesce("n_reserved_gt", z).alias("n_reserved_gt"),
                    F.coalesce("n_negative", z).alias("n_negative"),
                    F.coalesce("n_sku_absent", z).alias("n_sku_absent"),
                    n_unmapped.alias("n_unmapped"), n_fields.alias("n_missing_fields")))


def report_summary(counts: DataFrame, period: str = DEFAULT_PERIOD) -> DataFrame:
    """-> period, errors, warnings, infos, total (as in the report header)."""
    c = F.col
    one, zero = F.lit(1), F.lit(0)
    check1_err = F.when(c("has_orders"), c("n_missing_stores")).otherwise(one)
    check1_info = F.when(c("has_orders") & (c("n_missing_stores") == 0) & (c("n_extra") == 0), one).otherwise(zero)
    check2_err = F.when(c("has_inventory"), zero).otherwise(one)
    check2_info = F.when(c("has_inventory"), one).otherwise(zero)
    check3_err = c("n_unmapped") + c("n_missing_fields")
    check3_info = F.when(check3_err == 0, one).otherwise(zero)
    check4_warn = F.when(c("has_orders"), c("n_spikes")).otherwise(zero)
    check4_info = F.when(c("has_orders") & (c("n_spikes") == 0), one).otherwise(zero)
    inv5 = c("has_inventory")
    check5_err = F.when(inv5, c("n_invalid") + c("n_negative")).otherwise(zero)
    check5_warn = F.when(inv5, c("n_sku_absent") + c("n_reserved_gt")).otherwise(zero)
    check5_info = F.when(inv5 & (check5_err + check5_warn == 0), one).otherwise(zero)
    errors = (check1_err + check2_err + check3_err + check5_err).cast("long")
    warnings = (check4_warn + check5_warn).cast("long")
    infos = (check1_info + check2_info + check3_info + check4_info + check5_info).cast("long")
    return (counts.select(period, errors.alias("errors"), warnings.alias("warnings"), infos.alias("infos"))
            .withColumn("total", F.col("errors") + F.col("warnings") + F.col("infos")))


def report_details(periods: DataFrame, orders: DataFrame, parsed_inv: DataFrame, expected_skus: DataFrame,
                   products: DataFrame, product_docs: DataFrame, expected_stores: list[str],
                   counts: DataFrame, threshold: int = DEMAND_SPIKE_THRESHOLD,
                   period: str = DEFAULT_PERIOD, clock: Column | None = None,
                   rollup: DataFrame | None = None, snapshots: DataFrame | None = None,
                   products_absent: bool = False) -> DataFrame:
    """Every report entry as a row -> period, seq, timestamp, level, check, message, detail.

    ``seq`` is the check number, which orders entries as in the report.  The INFO
    lines come from ``counts`` (one row per period), the findings from the detail
    tables; nothing is gathered per period.  Checks 1 and 4 read ``orders_rollup``
    twice (missing stores, spikes): pass a checkpointed ``rollup`` to read the
    orders once.
    """
    ts = clock if clock is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    M = MESSAGES

    def entry(df, seq, level, check, message, detail):
        return df.select(period, F.lit(seq).alias("seq"), ts.alias("timestamp"), F.lit(level).alias("level"),
                         F.lit(check).alias("check"), message.alias("message"), _s(detail).alias("detail"))

    cp = counts
    r = rollup if rollup is not None else orders_rollup(orders, period)
    found = rollup_stores(r, period)
    # expected stores without a delivery, for every period that has orders (as the
    # counts define it: a folder that exists with no file misses every store)
    exp = F.array(*[F.lit(x) for x in expected_stores])
    wanted = cp.where(F.col("has_orders")).select(period, F.explode(exp).alias("store_id"))
    parts = [
        entry(cp.where(~F.col("has_orders")), 1, ERROR, CHECKS[0],
              F.format_string(M["orders_absent"], _s(period)), F.col(period)),
        entry(wanted.join(found, [period, "store_id"], "left_anti"), 1, ERROR, CHECKS[0],
              F.format_string(M["store_missing"], F.col("store_id")), F.col("store_id")),
        entry(cp.where(F.col("has_orders") & (F.col("n_missing_stores") == 0) & (F.col("n_extra") == 0)),
              1, INFO, CHECKS[0], F.lit(M["stores_ok"]), F.lit("")),
        entry(cp.where(~F.col("has_inventory")), 2, ERROR, CHECKS[1],
              F.format_string(M["inventory_absent"], _s(period)), F.col(period)),
        entry(cp.where(F.col("has_inventory")), 2, INFO, CHECKS[1], F.lit(M["inventory_ok"]), F.lit("")),
    ]
    per = periods.select(period).distinct()
    unm = unmapped_skus(expected_skus, products)
    mf = missing_fields(product_docs)
    # check 3 does not depend on the period; its findings repeat in every period's report
    periods_arr = per.agg(F.sort_array(F.collect_set(period))).scalar()
    if products_absent:
        parts.append(entry(per, 3, ERROR, CHECKS[2], F.lit(M["products_absent"]), F.lit("products")))
        unm, mf = unm.limit(0), mf.limit(0)
    parts += [
        entry(unm.select(F.explode(periods_arr).alias(period), "sku"), 3, ERROR, CHECKS[2],
              F.format_string(M["sku_unmapped"], _s("sku")), F.col("sku")),
        entry(mf.select(F.explode(periods_arr).alias(period), "sku", "missing"), 3, ERROR, CHECKS[2],
              F.format_string(M["fields_missing"], _s("sku"), F.col("missing")), F.col("missing")),
        entry(cp.where(F.col("n_unmapped") + F.col("n_missing_fields") == 0), 3, INFO, CHECKS[2],
              F.lit(M["mapping_ok"]), F.lit("")),
        entry(rollup_spikes(r, threshold, period), 4, WARNING, CHECKS[3],
              F.format_string(M["spike"], _s("sku"), _s("total_demand"), F.lit(str(threshold))),
              F.concat(F.lit("total_demand="), _s("total_demand"))),
        entry(cp.where(F.col("has_orders") & (F.col("n_spikes") == 0)), 4, INFO, CHECKS[3],
              F.lit(M["no_spike"]), F.lit("")),
        entry(skus_missing_in_inventory(expected_skus, parsed_inv, period, snapshots), 5, WARNING, CHECKS[4],
              F.format_string(M["sku_not_in_inventory"], _s("sku")), F.col("sku")),
    ]
    f = inventory_findings(parsed_inv, period)
    msg = (F.when(F.col("rule") == "invalid", F.format_string(M["invalid"], _s("sku")))
           .when(F.col("rule") == "negative", F.format_string(M["negative"], _s("sku")))
           .otherwise(F.format_string(M["reserved_gt_available"], _s("sku"))))
    parts.append(f.select(period, F.lit(5).alias("seq"), ts.alias("timestamp"), F.col("level"),
                          F.lit(CHECKS[4]).alias("check"), msg.alias("message"),
                          F.concat_ws(":", _s("sku"), F.col("warehouse"), F.col("rule")).alias("detail")))
    c5 = (F.col("n_invalid") + F.col("n_negative") + F.col("n_sku_absent") + F.col("n_reserved_gt"))
    parts.append(entry(cp.where(F.col("has_inventory") & (c5 == 0)), 5, INFO, CHECKS[4],
                       F.lit(M["inventory_consistent"]), F.lit("")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
