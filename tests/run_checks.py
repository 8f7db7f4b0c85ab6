"""python tests/run_checks.py [sf] [key ...]: compare registered queries with their SQL."""

import os
import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

import checking  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from riskloom.session import local_session  # noqa: E402


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    if os.environ.get("PLAIN_SESSION"):  # the settings a stranger's session would have
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session()
    con = checking.connect(sf_dir)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    failed = 0
    for key in wanted or queries:
        begin = time.time()
        try:
            frame = queries[key](spark, sf_dir)
            if key in oracles:
                problem = checking.compare(frame, con, oracles[key])
                verdict = "ok" if problem is None else "DIFF " + problem[:1500]
            else:
                count = len(frame.collect())
                verdict = f"rows only: {count}" if count else "DIFF empty"
        except Exception as exc:  # report and go on with the next key
            verdict = "FAIL " + str(exc)[:1500]
            if wanted:
                traceback.print_exc()
        failed += verdict.startswith(("DIFF", "FAIL"))
        print(f"{key:32s} {time.time() - begin:6.2f}s  {verdict}", flush=True)
    print("queries", len(wanted or queries), "failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
