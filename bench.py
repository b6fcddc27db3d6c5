"""Times the headline queries and prints one JSON line.

Each query is warmed up once on the smallest tables and then run once in full; the
result is written to Spark's noop sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from affinia.plans import QUERIES
from affinia.session import build_session, clear_scratch

HEADLINE = [
    "AGG-01_term_stats", "DICT-01_token_dictionary", "DOC-01_text_document", "DOC-03_txt2url_hashed",
    "DOC-05_tfidf_document", "COO-01_token_cooccurrence_hashed", "SRT-04_top_neighbours_cooccur",
    "COO-03_dice_similarity", "SRC-11_scan_tables_sql", "AGG-08_item_viewers", "WIN-03_latest_rating",
    "SIM-01_user_similarity", "SIM-03_affinity", "JOIN-11_asof_features", "WIN-09_session_sequence",
    "DICT-03_uri_dictionaries", "WIN-05_split_context_next", "EVAL-01_recall_at_k", "RET-01_knn_inner_product",
    "RET-07_ann_search", "RET-03_centroid_search", "RET-08_inverted_index", "RET-10_bloom_contains",
    "REC-11_diversify", "STR-03_stream_hourly_metrics",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    times = {}
    for name in wanted:
        if os.path.isdir(small):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
