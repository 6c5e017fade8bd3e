"""Seconds per headline query; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES

HEADLINES = (
    "token_stats", "corpus_summary", "chunk_100", "heur_stats", "heuristic_filter", "heur_word_repetition",
    "heur_char_repetition", "quality_filter", "toxic_filter", "domain_tag", "token_count", "encode_docs",
    "pack_blocks", "shingles", "minhash_signature", "dedup_keep", "dedup_keep_verified", "html_to_text",
    "page_records", "page_links", "pagination_chain", "epub_status_summary", "corpus_funnel", "stream_filter",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINTS") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINES
    spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(length(text))").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
