"""Command line check of all (or the named) queries: name, seconds, verdict."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import difference  # noqa: E402
from palaver.session import build_session  # noqa: E402
from registry import ORACLE, QUERIES  # noqa: E402


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                verdict = difference(spark, sf_dir, QUERIES[name], ORACLE[name])
            else:
                rows = QUERIES[name](spark, sf_dir).count()
                verdict = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:900]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {time.time() - start:.2f}s"
              + (f"\n {verdict}" if verdict else ""), flush=True)
    spark.stop()
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
