"""Time the headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is materialised with the ``noop`` sink (full computation, no
driver collect); the reported time per query is the best of ``BENCH_RUNS`` (default 3),
after one untimed pass over all queries (JIT compilation of the decode and
aggregate code paths, file listing caches), so the numbers are steady-state
execution, as in a long-running job. Queries over the stored speed view include
the streaming job that writes the view, so no part of their work is untimed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickpulse.plans.catalog import BY_NAME, forget_stored_view  # noqa: E402
from clickpulse.session import local_session  # noqa: E402

HEADLINE = (
    "raw_clicks",
    "speed_window_counts",
    "speed_partials",
    "all_time_totals",
    "latest_windows",
    "check_speed_view",
    "batch_report",
    "page_stats_15s",
    "page_stats_json",
    "page_visits",
    "spend_rows",
    "spend_by_account",
    "stream_final_counts",
    "speed_stream_totals",
    "spend_stream_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else 8)),
                          app="clickpulse-bench")

    def run(name: str) -> None:
        # queries over the stored speed view write it anew, in the time that counts
        forget_stored_view(spark, sf_dir)
        BY_NAME[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    # a failing query is reported (time null, its error) instead of ending the bench
    errors: dict[str, str] = {}
    for name in names:  # warm-up: JIT and file listing caches, not timed
        try:
            run(name)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]

    times: dict[str, float | None] = {}
    for name in names:
        if name in errors:
            times[name] = None
            continue
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            run(name)
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
