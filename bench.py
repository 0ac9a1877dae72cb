"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from claimtide.plans import load_all
from claimtide.plans.catalog import QUERIES
from claimtide.session import local_session

HEADLINE = [
    "flagship_claims_per_language",
    "J6_keyword_search",
    "J5_messages_near_claim",
    "J7_match_media",
    "J3_attach_claim_attributes",
    "J18_with_group_size",
    "A22_cooccurrence",
    "A30_vote_language",
    "A6_per_day_claim",
    "A8_value_counts",
    "A9_crosstab",
    "A11_describe",
    "A16_engagement_mean_per_hour_offset",
    "A24_class_report",
    "A28_tune_threshold",
    "A34_wilcoxon",
    "F1_strip_html",
    "F20_select_keywords",
    "M1_score_pairs",
    "M3_classify_finer",
    "P19_subset_flags_claims",
    "W2_sample_per_claim",
    "W7_last_writer",
    "X4_day_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    load_all()
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
