"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Building the query
(with its small driver jobs) and running it to a no-op sink are both timed; listing files and
reading schemas falls into the warm-up, since tables are kept per session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cutline.plans.queries import QUERIES  # noqa: E402
from cutline.session import local_session  # noqa: E402

HEADLINE = [
    "label_purchase_bucketed", "label_churn", "label_value_median", "feat_numeric", "feat_mode",
    "feat_depth2", "feat_diff", "decile", "auc", "profit_report_classifier", "comment_words",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "cutline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, folder, name)
        seconds[name] = round(statistics.median(run(spark, folder, name) for _ in range(REPEATS)), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
