"""Timing of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the local cores. Each query runs once to warm up and then
BENCH_RUNS times (default 2); the best run counts. Results are consumed by the
``noop`` sink, so every output column is computed.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagewell.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "f1_clean_text",
    "f2_window_chunks",
    "f3_separator_chunks",
    "chunk_table",
    "w1_chunk_index_flat_pages",
    "w3_sequence_ids",
    "w4_request_batches",
    "w4_request_batches_nested",
    "f7_embedding_request",
    "f9_response_status",
    "j3_positional_zip",
    "x1_embed_chunks",
    "l2_exact_topk",
    "l2_exact_topk_cells",
    "j2_hit_lookup",
    "n1_search_lists",
    "retrieve_chunks",
    "s8_vector_text",
    "s4_chunk_append",
    "a1_count_per_topic",
    "w5_work_slices",
    "i1_backlog_drain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "pagewell-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The tables have one row group each and would be scanned by one task: the
    # queries run on copies in several files, and their plans stay as shipped.
    split_dir = tempfile.mkdtemp(prefix="pagewell-bench-")
    for name in "documents embeddings pages benchmark labels conversations".split():
        rows = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        rows.repartition(cpus).write.parquet(os.path.join(split_dir, f"{name}.parquet"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, split_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in only:
        once(name)
        timings[name] = round(min(once(name) for _ in range(runs)), 3)
        print(name, timings[name], file=sys.stderr)
    spark.stop()
    shutil.rmtree(split_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
