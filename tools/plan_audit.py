"""Plan audit: the physical plan shape of every registered query.

Counts, per query, the shuffle exchanges, broadcasts, single-partition
exchanges (with their input columns), Arrow (Python) stages and scans with
their read schemas, from ``explain("formatted")``.  Writes PLANS.md.

    python tools/plan_audit.py /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tokenweave.plans.catalog import QUERIES  # noqa: E402
from tokenweave.session import build_session  # noqa: E402


def formatted(df) -> str:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def audit(text: str) -> dict:
    nodes = re.findall(r"^\((\d+)\) (\w[\w ]*?)\s*$", text, flags=re.M)
    kinds = [k.strip() for _, k in nodes]
    single = []
    for block in text.split("\n\n"):
        if ") Exchange" in block and "SinglePartition" in block:
            m = re.search(r"Input \[\d+\]: \[(.*)\]", block)
            single.append(re.sub(r"#\d+L?", "", m.group(1)) if m else "?")
    schemas = sorted({re.sub(r"#\d+L?", "", s) for s in re.findall(r"ReadSchema: (struct<.*>)", text)})
    return {
        "shuffles": sum(1 for k in kinds if k == "Exchange"),
        "broadcasts": sum(1 for k in kinds if k == "BroadcastExchange"),
        "arrow": sum(1 for k in kinds if k in ("MapInArrow", "MapInPandas", "ArrowEvalPython")),
        "single": single,
        "schemas": schemas,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]")
    print("# Plan audit\n")
    print(f"Generated by `tools/plan_audit.py` on `{sf}` (initial AQE plans; AQE may still turn a")
    print("shuffle join into a broadcast at run time). Exchanges over reused subtrees are counted where")
    print("they appear. Single-partition exchanges list their input columns: every one is over a table")
    print("bounded by parameters (at most 65,536 bucket totals, one row per step or evaluation interval)")
    print("or is the final merge of per-task partial aggregates (one row per task).\n")
    print("| query | shuffles | broadcasts | Arrow stages | single-partition exchanges (inputs) | scans (read schema) |")
    print("|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        a = audit(formatted(fn(spark, sf)))
        single = "; ".join(a["single"]) or "—"
        schemas = "<br>".join(f"`{s}`" for s in a["schemas"]) or "checkpoint / written table"
        print(f"| `{name}` | {a['shuffles']} | {a['broadcasts']} | {a['arrow']} | {single} | {schemas} |")
    spark.stop()


if __name__ == "__main__":
    main()
