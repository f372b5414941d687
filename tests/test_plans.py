"""Plan shape of every registered query (sf0.001, broadcasts disabled so the
plan is the one Spark falls back to at volume): no Python evaluation, no
cartesian product or nested-loop join, and no window over the whole input
in one task."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from replenix.plans import queries

SF = "/root/testdata/sf0.001"
KEYS = sorted(queries.queries())

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue().split("== Physical Plan ==", 1)[1]


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(no_broadcast, key):
    plan = _plan(E.queries()[key](no_broadcast, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"
    # a window without PARTITION BY runs in one task
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert m.group(1).strip(), f"{key}: window without partition keys"


# columns of the driver's tables that no adapter view uses: a scan reading them
# has lost column pruning
UNUSED = {"lineitem": ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"),
          "orders": ("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
          "part": ("p_brand", "p_type", "p_retailprice"),
          "supplier": ("s_nationkey", "s_acctbal")}


# the rounding query computes a price from them
USED = {"round_half_even": ("l_extendedprice", "l_discount", "l_tax")}


@pytest.mark.parametrize("key", KEYS)
def test_scans_read_only_used_columns(spark, key):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[key](spark, SF).explain("formatted")
    plan = buf.getvalue()
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        loc = re.search(r"Location: \S+ \[.*?/(\w+)\.parquet", block)
        schema = re.search(r"ReadSchema: (.+)", block)
        if loc and schema and loc.group(1) in UNUSED:
            for c in set(UNUSED[loc.group(1)]) - set(USED.get(key, ())):
                assert c not in schema.group(1), f"{key}: {loc.group(1)} scan reads {c}"
