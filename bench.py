"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import corpus  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from newsflow.session import build_session  # noqa: E402

HEADLINE = (
    "extract_links", "crawl_frontier", "extract_articles", "parse_publish_date", "is_valid_author",
    "ingest_batch", "ingest_articles", "ingest_counters", "dedup_titles", "clean_text", "split_authors", "run_etl",
    "chunk_text", "chunk_view", "point_id", "new_chunks", "vec_5", "vec_6", "vec_7", "vec_8",
    "dense_topk", "sparse_topk", "hybrid_topk", "rerank", "format_context", "retrieve",
    "context_precision", "answer_relevancy", "model_scoreboard",
    "warehouse_metrics", "latest_articles", "articles_by_month",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    start = time.perf_counter()
    corpus.shared_warehouse(spark, sf_dir)
    corpus.shared_points(spark, sf_dir)
    timings = {"warehouse_and_points": round(time.perf_counter() - start, 3)}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf_dir}))


if __name__ == "__main__":
    main()
