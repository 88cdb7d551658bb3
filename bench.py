"""Time the headline queries once each and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores. Each query's rows are written to a sink that discards them,
so all columns are computed and none travel to the driver. One untimed query
starts the session and stores the derived feeds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from portrisk.registry import QUERIES  # noqa: E402
from portrisk.session import local_session  # noqa: E402

HEADLINES = (
    "a01_read_events_tsv", "a03_read_zipped_tsv", "a16_upsert", "a16_upsert_stored",
    "a17_upsert_composite", "a18_insert_only_merge", "e1_daily_tables", "st01_incremental_ingest",
    "b12_geodesic_km", "f02_port_themes_broad", "j01_label_cameo", "j03_densify",
    "j04_daily_features", "j06_attach_pages", "j07_ports_within_radius",
    "j07_ports_within_radius_shuffled", "g01_weighted_report", "g02_theme_growth_base",
    "g06_daily_goldstein", "g09_winsorize", "g12_spearman", "g15_dickey_fuller_t",
    "w01_rank_negative", "w01_rank_negative_ranges", "w01_top_negative", "w02_top_themes",
    "w03_growth", "w06_sliding_windows", "t02_feature_frame", "t03_model_mae",
    "t05_extract_paragraphs", "t06_extractive_summary", "t07_news_detail_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    for warm in ("g08_row_count", "j07_events_per_port", "j06_attach_pages"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
