"""Write PLANS.md: for every batch query, the shape of its physical plan
(scans with read schema and pushed filters, shuffles, joins, per-task top-n,
aggregates).  Stream keys run whole replays and are not planned here.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopflow.plans.catalogue import QUERIES  # noqa: E402
from shopflow.session import build_session  # noqa: E402

PATTERNS = [
    ("scan", re.compile(r"FileScan parquet [^\n]*")),
    ("shuffle", re.compile(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)")),
    ("join", re.compile(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                        r" \[[^\]]*\], \[[^\]]*\], \w+")),
    ("top-n", re.compile(r"WindowGroupLimit \[[^\]]*\], \[[^\]]*\], \w+\(\), \d+, Partial|TakeOrderedAndProject\(limit=\d+")),
    ("aggregate", re.compile(r"(HashAggregate|ObjectHashAggregate|SortAggregate)\(keys=\[[^\]]*\]")),
]


def clean(s: str) -> str:
    s = re.sub(r"#\d+L?", "", s)
    s = re.sub(r"Location: InMemoryFileIndex\(\d+ paths?\)\[file:[^\]]*/", "Location: ", s)
    s = re.sub(r", (Batched|Format|DataFilters|PartitionFilters): [^,]*(\[[^\]]*\])?", "", s)
    return s[:230]


def scan_text(line: str) -> str:
    table = re.search(r"/([A-Za-z_]+)\.parquet\]", line)
    pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
    return (f"{table.group(1) if table else '?'} read {schema.group(1) if schema else '?'}"
            f" pushed {pushed.group(1) if pushed else '[]'}")


def summarize(plan: str) -> list[str]:
    out = []
    for kind, pat in PATTERNS:
        seen = []
        for m in pat.finditer(plan):
            if kind == "scan":
                seen.append(re.sub(r"#\d+L?", "", scan_text(m.group(0))))
                continue
            text = clean(m.group(0))
            if kind == "aggregate":
                text = text.split("(")[0] + " on " + text.split("=", 1)[1]
            seen.append(text)
        if kind in ("shuffle", "aggregate"):
            counts = {}
            for t in seen:
                counts[t] = counts.get(t, 0) + 1
            seen = [f"{t} ×{n}" if n > 1 else t for t, n in counts.items()]
        else:
            seen = list(dict.fromkeys(seen))
        out += [f"  - {kind}: `{t}`" for t in seen]
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    lines = ["# Physical plans", "",
             f"Generated by `scripts/plan_report.py` on `{os.path.basename(sf)}` (AQE's initial plan; at run time AQE "
             "may still coalesce partitions, turn a small shuffle join into a broadcast, split skewed partitions, "
             "and reuse identical exchanges). Stream keys are Structured Streaming replays and are not listed.", ""]
    for key, q in QUERIES.items():
        if key.startswith("stream_"):
            continue
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines.append(f"* **{key}**")
        lines += summarize(plan)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
