"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (optional) a comma-separated choice of queries. Each time covers
the whole query from the raw tables, written tables included, with every output
row computed (noop sink); one untimed run of the flagship starts the engine.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vidpulse.plans.registry import QUERIES  # noqa: E402
from vidpulse.session import build_session  # noqa: E402

HEADLINE = [
    "parse_messages",
    "clean_strict",
    "clean_clamp",
    "clean_feature_input",
    "video_features",
    "video_features_split",
    "video_features_big",
    "hot_max_p99",
    "hot_minmax_p99",
    "top_hot",
    "cache_rank",
    "cache_recommendation",
    "cache_kpis",
    "cache_policy",
    "serve_requests",
    "request_stats",
    "running_stats",
    "replay_policy",
    "sample_n",
    "inject_trend",
    "describe_numeric",
    "duplicate_profile",
    "histogram",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    settings = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    }
    if not os.environ.get("BENCH_SHARED_DIR"):
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-")
    else:
        settings["spark.checkpoint.dir"] = os.environ["BENCH_SHARED_DIR"]
    spark = build_session(
        "vidpulse-bench", f"local[{cpus}]", **{k.replace(".", "__"): v for k, v in settings.items()}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.monotonic() - began, 3)

    run("hot_max_p99")
    times = {name: run(name) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
