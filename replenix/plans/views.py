"""Lazily built, shared DataFrames of one (session, data folder): the adapter
views and the pipeline stages over them.  Nothing here triggers a job."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import SparkSession

from replenix.operators import demand as dem
from replenix.operators import mrp
from replenix.operators import orders as ords
from replenix.operators import suppliers as sup
from replenix.plans import adapters as A

P = A.PERIOD


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name):
        return A.table(self.spark, self.sf_dir, name)

    # --- adapter views -------------------------------------------------
    @cached_property
    def pos(self):
        return A.pos(self.spark, self.sf_dir, with_store=True)

    @cached_property
    def pos_lines(self):
        return A.pos(self.spark, self.sf_dir, with_store=False)

    @cached_property
    def years(self):
        return A.years(self.spark, self.sf_dir)

    @cached_property
    def years_array(self):
        return A.years_array(self.spark, self.sf_dir)

    @cached_property
    def inventory(self):
        return A.inventory(self.spark, self.sf_dir)

    @cached_property
    def inventory_text(self):
        return A.inventory_text(self.spark, self.sf_dir)

    @cached_property
    def products(self):
        return A.products(self.spark, self.sf_dir)

    @cached_property
    def product_suppliers(self):
        return A.product_suppliers(self.spark, self.sf_dir)

    @cached_property
    def suppliers(self):
        return A.suppliers(self.spark, self.sf_dir)

    @cached_property
    def expected_skus(self):
        return A.expected_skus(self.spark, self.sf_dir)

    # --- pipeline stages -------------------------------------------------
    @cached_property
    def demand(self):
        return dem.aggregate_demand(self.pos_lines, P)

    @cached_property
    def stock(self):
        return dem.inventory_by_sku(self.inventory, P)

    @cached_property
    def preferred(self):
        return sup.preferred_suppliers(self.product_suppliers)

    @cached_property
    def master(self):
        return sup.supplier_master(self.products, self.preferred)

    @cached_property
    def rounded(self):
        return mrp.pack_rounding(self.demand, self.stock, self.master, P)

    @cached_property
    def net(self):
        return mrp.net_demand(self.demand, self.stock, self.master, P)

    @cached_property
    def names(self):
        return sup.sku_names(self.products, self.preferred, self.suppliers)

    @cached_property
    def lines(self):
        return ords.order_lines(self.net, self.names, P)
