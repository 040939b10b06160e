"""Summarise the final (adaptive) physical plan of registered queries.

Usage: python tests/plan_summary.py [sf_dir] [names...]
Runs each query once (noop sink) and counts, in the executed plan: parquet
scans, checkpoint reads, shuffles, broadcasts and sort-merge joins.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["shard_token_counts", "global_positions", "pack_sequences", "sample_windows",
            "pretoken_counts", "bpe_pair_counts", "bpe_encode", "clean_generated", "corpus_loss"]


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]   # AQE prints the final plan first
    count = lambda pat: len(re.findall(pat, plan))
    return {"parquet_scans": count(r"FileScan parquet|Scan parquet"),
            "checkpoint_reads": count(r"Scan ExistingRDD|ExistingRDD"),
            "shuffles": count(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                              r"\bExchange SinglePartition|\bExchange RoundRobinPartitioning"),
            "broadcasts": count(r"BroadcastExchange"),
            "sort_merge_joins": count(r"SortMergeJoin"),
            "python_udfs": count(r"PythonUDF|ArrowEvalPython|BatchEvalPython")}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/")] or HEADLINE
    import __spark_entry__ as E
    from tokenloom.session import get_spark
    spark = get_spark("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    for name in names:
        df = E.queries()[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(name, summarise(plan), flush=True)


if __name__ == "__main__":
    main(sys.argv)
