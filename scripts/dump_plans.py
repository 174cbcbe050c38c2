"""Write the physical plan trees of the main queries to docs/plans.md.

Usage: python scripts/dump_plans.py [sf_dir]
Uses ``explain("formatted")`` and keeps its operator tree (the per-node
details are omitted to keep the file short).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.config import builder  # noqa: E402
from eventide.plans.catalog import QUERIES  # noqa: E402

NAMES = ["repository_metrics", "user_activity", "language_trends", "dedup_events",
         "top_repositories", "event_type_summary", "panel_repository_activity",
         "aggregated_metrics", "validate_rejected", "keyed_append", "session_activity",
         "push_then_star", "asof_repository_counters", "events_in_incidents",
         "repository_trend", "type_language_rollup", "user_distinct_repositories"]


KEEP = ("Arguments", "Keys", "Functions", "ReadSchema", "PushedFilters",
        "PartitionFilters", "Condition", "Join type", "Output")


def _details(text: str) -> dict[str, str]:
    """Node id -> one short annotation from the formatted details."""
    notes = {}
    for block in text.split("\n\n"):
        lines = block.strip().splitlines()
        m = re.match(r"\((\d+)\) (.*)", lines[0]) if lines else None
        if not m:
            continue
        attrs = {}
        for line in lines[1:]:
            if ": " in line:
                k, v = line.split(": ", 1)
                attrs[k.split(" [")[0]] = v
        name = m.group(2).strip()
        if name.startswith("Exchange") or name.startswith("BroadcastExchange"):
            note = attrs.get("Arguments", "")
        elif "Aggregate" in name:
            note = f"keys={attrs.get('Keys', '[]')} fns={attrs.get('Functions', '[]')}"
        elif name.startswith("Scan"):
            note = f"ReadSchema={attrs.get('ReadSchema', '')} Pushed={attrs.get('PushedFilters', '[]')}"
        elif "Join" in name:
            note = f"{attrs.get('Join type', '')} keys={attrs.get('Left keys', '')}"
        elif name.startswith("TakeOrderedAndProject"):
            note = attrs.get("Arguments", "")
        else:
            note = ""
        notes[m.group(1)] = re.sub(r"#\d+L?", "", note)[:150]
    return notes


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    head, _, details = buf.getvalue().partition("\n\n\n")
    notes = _details(details)
    out = []
    for line in head.splitlines():
        m = re.search(r"\((\d+)\)\s*$", line)
        note = notes.get(m.group(1), "") if m else ""
        out.append(line.rstrip() + (f"   -- {note}" if note else ""))
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = builder("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the main queries",
           "",
           f"Generated by `scripts/dump_plans.py` ({os.path.basename(sf)}, local[8], AQE on; "
           "initial plans, before AQE re-optimisation).",
           ""]
    for name in NAMES:
        out += [f"## {name}", "", "```", tree(QUERIES[name](spark, sf)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "plans.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
