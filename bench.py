"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Each query is planned and run to its last row once warm; arguments name
other queries ("all" for every one).
"""

import json
import os
import sys
import time

from lendmart.plans.queries import QUERIES
from lendmart.session import local_session

HEADLINE = [
    "default_rate_by_month", "ledger_dpd", "customer_snapshot", "clean_audit",
    "gold_features_wide", "ema_latest", "ema_latest_sparse", "training_set",
    "stratified_split", "feature_matrix", "gini", "threshold_search", "psi_by_batch",
    "csi_by_batch", "performance_by_batch", "drift_status",
]


def run(query, spark, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(argv):
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = list(QUERIES) if argv == ["all"] else argv or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(run(QUERIES[name], spark, sf_dir), 3)
    print(json.dumps({"metric": "total_query_seconds",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main(sys.argv[1:])
