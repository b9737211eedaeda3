"""Print the executed plan of queries in brief: scans, exchanges, reuse, risky nodes."""

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palaver.session import build_session  # noqa: E402
from registry import QUERIES  # noqa: E402


def shape(spark, sf_dir: str, name: str) -> dict[str, int]:
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    found = {key: len(re.findall(pattern, final)) for key, pattern in {
        "scans": r"FileScan parquet", "exchanges": r"\bExchange (?:hash|range|Single|Round)",
        "reused": r"ReusedExchange", "single": r"Exchange SinglePartition",
        "cross": r"CartesianProduct|BroadcastNestedLoopJoin", "smj": r"SortMergeJoin",
        "bhj": r"BroadcastHashJoin", "python": r"ArrowEvalPython|BatchEvalPython|MapInPandas"}.items()}
    return found


def main() -> None:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[1:] or list(QUERIES):
        start = time.time()
        found = shape(spark, sf_dir, name)
        print(f"{name} {time.time() - start:.2f}s",
              " ".join(f"{k}={v}" for k, v in found.items() if v), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
