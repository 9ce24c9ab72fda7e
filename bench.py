"""Time the headline queries: one JSON line with seconds per query.

$BENCH_SF_DIR is the data folder, $BENCH_CPUS the cores, $BENCH_RUNS the timed
runs after a warm-up (the median counts). Every column of every result row is
produced and hashed, so nothing can be skipped by column pruning.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerline.plans.queries import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

HEADLINE = [
    "au_profiles", "ca_profiles", "uk_profiles", "all_countries", "country_summary", "expand_entities",
    "prefer_current", "latest_per_key", "join_stats", "normalize_name", "match_key", "detect_country",
    "page_records", "page_title", "register_with_pdf", "integrate_pages", "document_result", "document_stats",
    "signature_records", "sig_v5_records", "source_summary", "detection_select", "line_context", "signer_rows",
    "stream_log",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        consume(QUERIES[name](spark, folder))
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            consume(QUERIES[name](spark, folder))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
