"""Time every registered query and print one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    cores of the local session (default 8)

``queries`` holds the best of the warm runs in seconds, from building the plan to the
last row; ``cold`` the first run.  ``value`` is the sum of the warm times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness.compare import local_session  # noqa: E402
from harness.queries import QUERIES  # noqa: E402

WARM_RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    cold, warm = {}, {}
    for name, query in QUERIES.items():
        times = []
        for _ in range(1 + WARM_RUNS):
            started = time.perf_counter()
            # All rows and columns are computed, but not carried to the driver.
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
        print(f"{warm[name]:8.3f}  {name}", file=sys.stderr)
    report = {
        "metric": "sum of warm query times",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cores": int(cores),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
