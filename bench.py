"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all cores) choose the data and
the size of the local Spark. Every query is run to the end once for warm-up and once timed; lake
tables are written by the `lake_build` step, which is timed as its own entry.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starfold.plans.lake import lake_table  # noqa: E402
from starfold.plans.queries import QUERIES  # noqa: E402
from starfold.session import get_spark  # noqa: E402

HEADLINE = (
    "snapshot_summary",
    "compact_object_history",
    "binary_energetics_class",
    "class_counts",
    "bin_label_backfill",
    "compact_binary_summary",
    "b_type_binaries",
    "lagrangian_profile",
    "particle_history",
    "particle_summary",
    "triple_systems",
    "imbh_snapshots",
    "imbh_mergers",
    "merger_generations",
    "imbh_objects",
    "ttot_dedup",
    "forward_clean",
    "galactic_energy",
    "orbital_frame",
    "orbit_elements",
    "hist2d_loglog",
    "percentile_limits",
    "text_events",
)
LAKE = ("snapshot_singles", "snapshot_binaries", "snapshot_scalars", "snapshot_steps")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    only = sys.argv[1:] or HEADLINE
    spark = get_spark(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-shared-"),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    start = time.perf_counter()
    for name in LAKE:
        lake_table(spark, sf_dir, name)
    times["lake_build"] = round(time.perf_counter() - start, 3)
    for name in only:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
