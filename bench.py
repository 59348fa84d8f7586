"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores.
BENCH_QUERIES: names to run instead of the headline list, separated by commas.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from playrank.plans import QUERIES
from playrank.session import build_session

HEADLINE = [
    "src3_load_events",
    "rel1_latest_wins",
    "rel3_time_split",
    "rel2_most_recent",
    "ag1_user_aggregate",
    "ag8_exact_quantiles",
    "rec1_random",
    "rec2_popularity",
    "rec4_factor_recommendations",
    "rec8_vector_recommendations",
    "sim1_vector_search",
    "sim2_similar_items",
    "smp4_one_positive_many_negatives",
    "smp5_pair_negatives",
    "cnd1_ranking_candidates",
    "rec5_user_tower_inputs",
    "rec6_item_tower_inputs",
    "ft1_user_features",
    "ft3_category_affinity",
    "ft8_feature_build",
    "ev5_all_metrics",
    "ev6_ranker_metrics",
    "ev7_model_comparison",
    "ex1_dataset_summary",
    "ex6_split_profile",
    "sv1_trending",
    "sv5_because_you_liked",
    "rec3_bpr_training",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        spark = build_session(
            "bench",
            f"local[{cpus}]",
            **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
        )
        spark.sparkContext.setLogLevel("ERROR")
        # Writing the splits once is part of preparation, timed on its own.
        seconds: dict[str, float] = {}
        start = time.perf_counter()
        QUERIES["src6_row_counts"](spark, sf_dir).collect()
        seconds["prepare_splits"] = round(time.perf_counter() - start, 3)
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
        spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total wall time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
