"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the cores,
BENCH_QUERIES a comma-separated choice of queries (default: the headline ones).
Every query is run to the end into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tenderlake.session import local_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "mart_annuale_bandi",
    "mart_trend_pnrr",
    "mart_top_stazioni",
    "mart_esiti_per_procedura",
    "mart_trend_settore",
    "mart_sa_profilo",
    "mart_annuale_aggiudicazioni",
    "mart_panoramica",
    "mart_imprese",
    "mart_ritardi_per_sa",
    "mart_competitivita",
    "mart_esecuzione",
    "mart_ritardi_contratto",
    "mart_collaudo_ritardo",
    "mart_sforamento",
    "mart_chi_paga",
    "clean_bandi_gara",
    "clean_aggiudicazioni",
    "clean_stati_avanzamento",
    "clean_fonti_finanziamento",
    "consortia",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed pass on the smallest data, so that compiling is not part of the times.
    warm = str(Path(sf_dir).parent / "sf0.001")
    for name in chosen:
        run(spark, name, warm if Path(warm).is_dir() else sf_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
