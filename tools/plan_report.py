"""Summarise the physical plans of queries (after their fit jobs) into PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange), broadcasts, code-generated stages, Python
stages, and each scan's pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from prepspark.catalog import queries  # noqa: E402
from prepspark.session import local_session  # noqa: E402

DEFAULT = ["profile_column_summary", "analyze_columns_orders", "issues_summary", "drop_duplicates", "cap_iqr",
           "encode_all", "encode_label", "scale_standard", "bin_equal_freq", "mutual_info", "knn_impute",
           "table_digest", "audit_chain", "fingerprint_similarity", "train_test_split", "full_prep"]


def plan_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or DEFAULT
    spark = local_session()
    qs = queries()
    print("# Physical plans of headline queries\n")
    print(f"Input: `{sf}`. Plans are of the returned DataFrame, i.e. after the fit jobs ran; "
          "shuffles count `Exchange` nodes (incl. the final single-partition merge of global aggregates).\n")
    print("| query | shuffles | broadcasts | python stages | scans: file, columns read, pushed filters |")
    print("|---|---|---|---|---|")
    for n in names:
        df = qs[n](spark, sf)
        txt = plan_text(df)
        tree = txt.split("\n\n")[0]
        shuffles = len(re.findall(r"\+- Exchange|^\s*Exchange", tree, re.M))
        bcast = tree.count("BroadcastExchange")
        cg = len(set(re.findall(r"\[codegen id : (\d+)\]", txt)))
        py = len(re.findall(r"(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)", tree))
        scans = []
        for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\(\d+\)|\Z)", txt, re.S):
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            loc = re.search(r"Location: \w+ \[file:[^\]]*/([\w.]+)\]", block)
            ncols = len(re.findall(r"[\w]+:", rs.group(1))) if rs else 0
            scans.append(f"{loc.group(1) if loc else '?'}: {ncols} cols" + (f", pushed [{pf.group(1)[:50]}]" if pf and pf.group(1) else ""))
        print(f"| {n} | {shuffles} | {bcast} | {py} | {'; '.join(scans) or 'checkpointed input (fit ran first)'} |")
    spark.stop()


if __name__ == "__main__":
    main()
