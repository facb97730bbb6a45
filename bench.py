"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query runs once to warm
up and then BENCH_RUNS times; the median counts. Results go to a sink that reads every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hog_counts", "expansion_reference", "sig_counts", "hog_level", "all_species_overview", "name_hits",
    "hits_touching", "rank_hits", "extended_genes", "closest_hogs", "cumulative_gene_sets", "longest_isoform",
    "hog_terms", "term_enrichment", "term_scores", "count_features", "size_factors", "bh_adjust",
    "read_quality_trim", "root_distance",
]


def main() -> None:
    from kinfold.plans.catalog import QUERIES
    from kinfold.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus=cpus, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
