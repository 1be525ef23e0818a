"""Physical-plan audit of every registered query (after execution, so the
adaptive plan is final).  Writes a markdown table.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.registry import load_all  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    body = text.split("\n\n")[0]  # the tree part
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r"[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|RightOuter|FullOuter|ExistenceJoin|Cross)?\b", body)
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    return {
        "exchanges": body.count("Exchange") - body.count("BroadcastExchange") - body.count("ReusedExchange"),
        "broadcasts": body.count("BroadcastExchange"),
        "joins": ", ".join(sorted({f"{j[0].replace('Join', '')}" for j in joins})) or "–",
        # A not-null check alone prunes nothing: only other predicates count.
        "pushed": sum(1 for s in scans if re.sub(r"IsNotNull\([^)]*\),? ?", "", s).strip()),
        "scans": len(scans),
        "wgl": "yes" if "WindowGroupLimit" in text else "",
        "python": "yes" if re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", text) else "no",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[4]", shuffle_partitions=16)
    reg = load_all()
    print(f"# Physical plans ({sf_dir}, local[4], adaptive execution, final plans)\n")
    print("Shuffle exchanges exclude broadcasts and reused exchanges. `pushed` = scans with "
          "pushed-down filters other than not-null / all scans that show filters. `WGL` = partial `WindowGroupLimit` before the shuffle. "
          "Generated by `tools/plan_report.py`.\n")
    print("| query | operators | shuffles | broadcasts | joins | pushed | WGL | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, r in reg.items():
        s = summarise(final_plan(r.build(spark, sf_dir)))
        print(f"| `{name}` | {r.operators} | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | "
              f"{s['pushed']}/{s['scans']} | {s['wgl']} | {s['python']} |")


if __name__ == "__main__":
    main()
