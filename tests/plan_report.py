"""Summarise the physical plan of every registered query (initial AQE plan).

For each key: shuffle exchanges, broadcast exchanges, join strategies,
aggregates, windows, and every Parquet scan of the source tables with its
read schema and pushed filters.  Run with broadcasts disabled (``--no-broadcast``)
to see the plan Spark falls back to when no side is small enough — the shape
that matters at large volume.

    python tests/plan_report.py [sf_dir] [--no-broadcast] [key ...] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NODE = re.compile(r"^\((\d+)\) (.+?)\s*$")


def summarize(plan: str) -> dict:
    # node ids are unique; a subquery listed again under another host keeps its ids
    ids = {}
    for m in (NODE.match(line) for line in plan.splitlines()):
        if m:
            ids[m.group(1)] = m.group(2)
    nodes = list(ids.values())
    out = {
        "shuffles": sum(1 for n in nodes if n == "Exchange"),
        "broadcasts": sum(1 for n in nodes if n == "BroadcastExchange"),
        "joins": sorted({n for n in nodes if "Join" in n}),
        "aggregates": sum(1 for n in nodes if n.endswith("Aggregate")),
        "windows": sum(1 for n in nodes if n == "Window"),
        "python": sum(1 for n in nodes if "Python" in n or "ArrowEval" in n),
        "scans": [],
    }
    blocks = re.split(r"\n(?=\(\d+\) )", plan)
    seen = set()
    for b in blocks:
        if not re.match(r"\(\d+\) Scan parquet", b):
            continue
        loc = re.search(r"Location: \S+ \[(.+?)\]", b)
        schema = re.search(r"ReadSchema: (.+)", b)
        pushed = re.search(r"PushedFilters: (.+)", b)
        part = re.search(r"PartitionFilters: (.+)", b)
        name = Path(loc.group(1).split(",")[0]).name if loc else "?"
        item = (name, schema.group(1) if schema else "", pushed.group(1) if pushed else "",
                part.group(1) if part else "")
        if item not in seen:
            seen.add(item)
            out["scans"].append(item)
    return out


def main(argv):
    from replenix.session import build_session
    import __spark_entry__ as E
    sf = next((a for a in argv if a.startswith("/")), "/root/testdata/sf0.1")
    nobc = "--no-broadcast" in argv
    keys = [a for a in argv if not a.startswith("/") and not a.startswith("--")] or sorted(E.queries())
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if nobc else {}
    spark = build_session(extra=extra)
    print(f"# Plan report ({sf}{', broadcasts disabled' if nobc else ''})\n")
    print("| key | shuffles | broadcasts | joins | aggregates | windows | python |")
    print("| --- | ---: | ---: | --- | ---: | ---: | ---: |")
    details = []
    for k in keys:
        df = E.queries()[k](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        s = summarize(plan)
        print(f"| {k} | {s['shuffles']} | {s['broadcasts']} | {', '.join(s['joins'])} | {s['aggregates']} | "
              f"{s['windows']} | {s['python']} |")
        details.append((k, s))
    print("\n## Source scans (read schema, pushed filters, partition filters)\n")
    for k, s in details:
        for name, schema, pushed, part in s["scans"]:
            if "replenix-scratch" in name or name.startswith(("raw_", "net_", "processed", "aggregated")):
                continue
            print(f"- `{k}` {name}: `{schema}` pushed `{pushed}`" + (f" partitions `{part}`" if part else ""))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
