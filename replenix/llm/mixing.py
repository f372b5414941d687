"""Operator 1, mixing sources to target weights: minimum-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to.  A flow routes every pattern's words to the quotas
of its sources, where using words once more costs ever more (convex), up to ``max_repeats`` uses.  Sources that no
pattern joins do not compete: sets of sources that patterns connect are solved apart, each in its own task, and a
source with a pattern of its own alone needs no solving.  Sources, targets, patterns and their flows are tables, of any
number.  Each pattern's flow is then laid out over passes through its documents in a seeded order, and documents are selected by their
place in that order.  Documents above 1/200 of their pattern (fewer than 200 of each) are placed one by one, first
fit, so that the many small ones can fill every share closely; no order is ever computed over a whole pattern:
4096 seeded buckets are summed, and only buckets that a boundary cuts are ordered document by document.

Defined results: null texts have size 0; a null source is a source of its own, last in order; rows that share a
document id and sources are taken alike; empty sources get target 0; a row of no source is never used; an empty table gives an empty mix; reruns
agree, as all choices follow from hashes of ids and the seed.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from replenix.llm.common import WORD_RE, ship, stored
from replenix.llm.components import components
from replenix.llm.flow import route
from replenix.operators.ranking import balanced_row_number

_BUCKETS = 4096
_LARGE = 200


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (3, 1, 2)   # of the sources in order, repeating
    share: float = 1.5                       # of all sizes, over all targets
    max_repeats: int = 2                     # uses of a document, and limit of a target over its source's size
    seed: int = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def _segments(size: int, flows: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(source, pass, from, to) pieces of the passes through a pattern that its flows fill one after the other."""
    out, at = [], 0
    for source, flow in sorted(flows.items()):
        while flow > 0:
            epoch, lo = divmod(at, size)
            piece = min(flow, size - lo)
            out.append((source, epoch, lo, lo + piece))
            at, flow = at + piece, flow - piece
    return out


def _fitted(items: list[tuple[str, int]], budget: int) -> tuple[list, list]:
    """First fit in the given order, then up to three exchanges that bring the sum closest to the budget."""
    chosen, others, gap = [], [], budget
    for item in items:
        if item[1] <= gap:
            chosen.append(item)
            gap -= item[1]
        else:
            others.append(item)
    for _ in range(3):
        swaps = [(o[1] - c[1], i, j) for i, c in enumerate(chosen) for j, o in enumerate(others) if 0 < o[1] - c[1] <= gap]
        if not swaps:
            break
        gain, i, j = max(swaps, key=lambda s: (s[0], -s[1], -s[2]))
        chosen[i], others[j] = others[j], chosen[i]
        gap -= gain
    return chosen, others


def _place_large(size: int, segments: list, large: list[tuple[str, int]]) -> tuple[dict, list]:
    """Uses of every large document, and the pieces that are left to the small ones, in their own measure.

    A piece gets its proportion of the large documents' words, first fit in seeded order.
    """
    uses: dict[str, list] = defaultdict(list)
    small_total = size - sum(s for _, s in large)
    left, pieces, place = [], [], defaultdict(int)
    by_pass: dict[int, list] = defaultdict(list)
    for segment in segments:
        by_pass[segment[1]].append(segment)
    for epoch, parts in sorted(by_pass.items()):
        left = list(large)
        for source, _, lo, hi in parts:
            length = hi - lo
            budget = length if not small_total else round(length * (size - small_total) / size)
            chosen, left = _fitted(left, budget)
            for key, _ in chosen:
                uses[key].append((source, epoch))
            taken = sum(s for _, s in chosen)
            rest = min(length - taken, small_total - place[epoch])
            if rest > 0:
                pieces.append((source, epoch, place[epoch], place[epoch] + rest))
                place[epoch] += rest
    return uses, pieces


def _sources(patterns: DataFrame, params: Mix) -> DataFrame:
    """A written table of the sources: source, number (from 0, by code point, null last), size and target (goal)."""
    found = (patterns.select(F.explode("sources").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("all", F.lit(0)))
    numbered = balanced_row_number(found, ["all"], [F.col("source").asc_nulls_last()], "n").select(
        "source", "source_size", (F.col("n") - 1).alias("number"))
    numbered = stored(numbered, "mix-sources")
    k = F.pmod("number", F.lit(len(params.weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in params.weights]), k + 1)
    most = params.max_repeats * F.col("source_size")
    whole = params.share * (numbered.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        # sums of whole numbers per weight: the level does not depend on the order of the rows
        above = F.lit(False) if capped < 0 else weight * level > most
        parts = numbered.groupBy(k.alias("k")).agg(F.count_if(~above).alias("open"), F.count_if(above).alias("capped"),
                                                   F.sum(F.when(above, F.col("source_size")).otherwise(0)).alias("size")).collect()
        now, open_ = sum(p["capped"] for p in parts), sum(p["open"] * params.weights[p["k"]] for p in parts)
        if now == capped or not open_:
            break
        level, capped = (whole - params.max_repeats * sum(p["size"] for p in parts)) / open_, now
    goal = most.cast("double") if not open_ else F.least(weight * level, most.cast("double"))
    return stored(numbered.withColumn("goal", goal), "mix-targets")


_FLOWS = "pattern string, flows array<struct<at:int,flow:bigint>>"


def _flows(members: DataFrame, params: Mix) -> DataFrame:
    """(pattern, flows): words of a pattern that each of its sources (by place) gets.

    ``members`` has a row per pattern and source: pattern, pattern_size, at, n_sources, number, goal.
    """
    quota = F.round("goal").cast("long")
    shared = members.where("n_sources > 1")
    first = F.min("number").over(Window.partitionBy("pattern"))
    edges = stored(shared.select(first.alias("a"), F.col("number").alias("b")).where("a <> b").distinct(), "mix-edges")
    sets = components(edges).select(F.col("node").alias("number"), "component")
    placed = stored(members.join(sets, "number", "left"), "mix-members")
    alone = placed.where("component is null").select("pattern", F.array(F.struct(
        F.col("at"), F.least(quota, F.col("pattern_size") * params.max_repeats).alias("flow"))).alias("flows"))

    def solve(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["pattern", "at"])
        numbers = sorted(set(table["number"]))
        place = {n: i for i, n in enumerate(numbers)}
        quotas = [0] * len(numbers)
        for n, q in zip(table["number"], table["quota"]):
            quotas[place[n]] = int(q)
        names, patterns = [], []
        for name, rows in table.groupby("pattern", sort=False):
            names.append(name)
            patterns.append((tuple(place[n] for n in rows["number"]), int(rows["pattern_size"].iloc[0])))
        flows = route(patterns, quotas, params.max_repeats)
        return pd.DataFrame({"pattern": names, "flows": [
            [{"at": sources.index(s), "flow": f} for s, f in sorted(to.items())] for (sources, _), to in zip(patterns, flows)]})

    joined = placed.where("component is not null").select("component", "pattern", "pattern_size", "at", "number", quota.alias("quota"))
    return alone.union(joined.groupBy("component").applyInPandas(solve, _FLOWS))


_USES = "array<struct<source:int,pass:int>>"
_PIECES = f"pattern string, pieces array<struct<source:int,pass:int,lo:long,hi:long>>, placed array<struct<k:string,uses:{_USES}>>"


def _plans(flows: DataFrame, large: DataFrame) -> DataFrame:
    """(pattern, pieces, placed): what the small documents fill, and the uses of the large ones, pattern by pattern."""
    def plan(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                flow = {f["at"]: f["flow"] for f in r["flows"] or []}
                size, mine = r["pattern_size"], sorted(r["large"] or [], key=lambda x: (x["h"], x["k"] or ""))
                uses, pieces = _place_large(size, _segments(size, flow) if size else [], [(x["k"], x["size"]) for x in mine])
                out.append({"pattern": r["pattern"],
                            "pieces": [{"source": s, "pass": e, "lo": lo, "hi": hi} for s, e, lo, hi in pieces],
                            "placed": [{"k": k, "uses": [{"source": s, "pass": e} for s, e in u]} for k, u in uses.items()]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(T._parse_datatype_string(_PIECES))
    return flows.join(large, "pattern", "left").select("pattern", "pattern_size", "flows", "large").mapInArrow(plan, _PIECES)


def mix(docs: DataFrame, doc_id: str = "doc_id", sources: Column | None = None, size: Column | None = None,
        params: Mix = Mix()) -> DataFrame:
    """One row per input row: doc_id, sources, size, uses array<struct<source, pass>> and the targets' table values.

    ``sources`` is an array column (default: the one source of the row); ``size`` a long column (default: words of
    ``text``).  ``target`` and ``source_size`` are arrays parallel to ``sources``.
    """
    ship(docs.sparkSession)
    sources = F.array(F.col("source")) if sources is None else sources
    size = word_count(F.col("text")) if size is None else size
    rows = stored(docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                              F.sort_array(F.array_distinct(sources)).alias("sources"), size.alias("size"))
                  .withColumn("pattern", F.to_json(F.struct("sources"))), "mix-rows")
    patterns = stored(rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size")), "mix-patterns")
    goals = _sources(patterns, params)
    members = patterns.select("pattern", F.col("size").alias("pattern_size"), F.size("sources").alias("n_sources"),
                              F.posexplode("sources").alias("at", "of"))
    members = stored(members.join(goals, F.col("of").eqNullSafe(F.col("source"))).drop("of"), "mix-memberships")
    by_place = F.sort_array(F.collect_list(F.struct("at", "goal", "source_size")))   # sources of one pattern
    info = members.groupBy("pattern").agg(by_place.alias("m")).select(
        "pattern", F.transform("m", lambda x: x["goal"]).alias("target"), F.transform("m", lambda x: x["source_size"]).alias("source_size"))

    order = F.xxhash64("doc_id", F.lit(params.seed))
    keys = rows.join(patterns.select("pattern", F.col("size").alias("pattern_size")), "pattern")
    keys = keys.groupBy("pattern", "doc_id").agg(F.sum("size").alias("size"), F.first("pattern_size").alias("pattern_size"))
    keys = stored(keys.select("pattern", "doc_id", "size", order.alias("h"), F.pmod(order, F.lit(_BUCKETS)).alias("b"),
                              (F.col("size") * _LARGE > F.col("pattern_size")).alias("large")), "mix-keys")
    # fewer than 200 documents of each pattern
    large = keys.where("large").groupBy("pattern").agg(F.collect_list(
        F.struct("h", F.col("doc_id").cast("string").alias("k"), "size")).alias("large"))
    flows = patterns.select("pattern", F.col("size").alias("pattern_size")).join(_flows(members, params), "pattern", "left")
    plans = stored(_plans(flows, large), "mix-plans")

    small = _placed(keys.where("not large"), plans.select("pattern", "pieces"))
    small = small.select("pattern", "doc_id", F.expr(
        f"cast(transform(filter(pieces, s -> s.lo <= at and at < s.hi), s -> struct(s.source, s.pass)) as {_USES})").alias("uses"))
    placed = plans.select("pattern", F.explode("placed").alias("u")).select("pattern", "u.k", "u.uses")
    big = (keys.where("large").withColumn("k", F.col("doc_id").cast("string")).alias("d")
           .join(placed.alias("u"), (F.col("d.pattern") == F.col("u.pattern")) & F.col("d.k").eqNullSafe(F.col("u.k")), "left")
           .select("d.pattern", "d.doc_id", F.coalesce("uses", F.array().cast(_USES)).alias("uses")))
    chosen = small.union(big)
    named = F.transform("c.uses", lambda u: F.struct(F.get("sources", u["source"]).alias("source"), u["pass"].alias("pass")))
    none = F.array()
    return (rows.join(info, "pattern", "left").alias("r")
            .join(chosen.alias("c"), (F.col("r.pattern") == F.col("c.pattern")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")))
            .select("r.doc_id", "sources", "size", named.alias("uses"), F.coalesce("target", none.cast("array<double>")).alias("target"),
                    F.coalesce("source_size", none.cast("array<bigint>")).alias("source_size")))


def _placed(keys: DataFrame, pieces: DataFrame) -> DataFrame:
    """Place ``at`` of every key in its pattern's seeded order, exact where a piece begins or ends nearby."""
    before = Window.partitionBy("pattern").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = keys.groupBy("pattern", "b").agg(F.sum("size").alias("n"))
    buckets = buckets.select("pattern", "b", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    buckets = buckets.join(pieces, "pattern").withColumn("cut", F.expr(
        "exists(pieces, s -> (start < s.lo and s.lo < start + n) or (start < s.hi and s.hi < start + n))"))
    placed = stored(keys.drop("large").join(buckets, ["pattern", "b"]), "mix-placed")
    within = Window.partitionBy("pattern", "b").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    exact = placed.where("cut").withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    whole = placed.where("not cut").withColumn("at", F.col("start"))
    return exact.unionByName(whole)


def mixed(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every document as often as it is used, with its own columns."""
    source = F.sort_array(F.array_distinct(options.get("sources", F.array("source"))))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(f"`{doc_id}`").alias("key"), F.to_json(F.struct(source.alias("s"))).alias("pattern"))
    times = (mix(docs, doc_id, **options)
             .select(F.col("doc_id").alias("id"), F.to_json(F.struct(F.col("sources").alias("s"))).alias("of"),
                     F.size("uses").alias("times")).where("times > 0").distinct())
    return (marked.join(times, F.col("key").eqNullSafe(F.col("id")) & (F.col("pattern") == F.col("of")))
            .select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*"))
