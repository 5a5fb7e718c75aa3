"""Shuffle/broadcast/join structure of every registered query's physical plan.

    python tools/plan_report.py [--scale] [--sf-dir DIR]

With ``--scale`` automatic broadcast joins are disabled, approximating the
plans at production size where dimension tables exceed any broadcast
threshold (explicit broadcasts of bounded tables remain). Materializations
done while building a query (mart tables, change feed) are listed
separately: they run before the final plan.
"""

import argparse
import json
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash_shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "window": r"\bWindow \[",
    "group_limit_partial": r"WindowGroupLimit .* Partial",
    "take_ordered": r"TakeOrderedAndProject",
    "python_udf": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def report(spark, sf_dir):
    from lakecraft.plans import QUERIES
    import lakecraft.session as S
    out = {}
    for name, fn in QUERIES.items():
        before = len(S._SHARED)
        calls = []
        orig = S.materialize

        def spy(df, name_="table", _orig=orig):
            calls.append(name_)
            return _orig(df, name_)
        S.materialize = spy
        import lakecraft.plans.mart as PM
        PM.materialize = spy
        try:
            plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        finally:
            S.materialize = PM.materialize = orig
        rec = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        rec["materialized"] = calls
        out[name] = rec
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--scale", action="store_true")
    a = ap.parse_args()
    from lakecraft.session import get_session
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if a.scale else {}
    spark = get_session("local[8]", shuffle_partitions=8, extra=extra)
    for k, v in report(spark, a.sf_dir).items():
        print(json.dumps({"query": k, **v}))


if __name__ == "__main__":
    main()
