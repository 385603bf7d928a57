"""Write docs/PLANS.md: the flagship's formatted physical plan and, for every
acceptance query, counts of scans, shuffles, broadcasts, joins and windows in
the final adaptive plan (after execution).

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")
from emberledger.plans.acceptance import QUERIES  # noqa: E402
from emberledger.session import get_session  # noqa: E402


def final_plan(df) -> str:
    # run this DataFrame's own query execution (a write would plan a new
    # one), JVM-side, so its adaptive plan becomes final
    df._jdf.collectAsList()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in text  # plans without an exchange are not adaptive
    return text.split("== Initial Plan ==")[0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "200")
    out = ["# Physical plans", "",
           f"Generated by `tools/plan_report.py` on `{sf}` (final adaptive plans, after execution).", "",
           "| Query | Parquet scans | Shuffle exchanges | Broadcast exchanges | Broadcast hash joins | "
           "Sort-merge joins | Windows | Python UDF |", "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in QUERIES:
        p = final_plan(QUERIES[name](spark, sf))
        counts = [
            len(re.findall(r"FileScan parquet|Scan parquet", p)),
            p.count("Exchange hashpartitioning") + p.count("Exchange SinglePartition") + p.count("Exchange rangepartitioning"),
            p.count("BroadcastExchange"),
            p.count("BroadcastHashJoin"),
            p.count("SortMergeJoin"),
            p.count("Window ["),
            "yes" if ("ArrowEvalPython" in p or "BatchEvalPython" in p) else "no",
        ]
        out.append(f"| {name} | " + " | ".join(map(str, counts)) + " |")
    buf = io.StringIO()
    df = QUERIES["q08_emissions"](spark, sf)
    df._jdf.collectAsList()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    out += ["", "## Flagship q08_emissions, formatted", "", "```", buf.getvalue().rstrip(), "```", ""]
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
