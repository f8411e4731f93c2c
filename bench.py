"""Benchmark the registered queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Derived inputs are written once to Parquet under the
session's shared checkpoint folder; each query then runs warm ``BENCH_RUNS``
times (forced with a no-op write, so every output column is computed) and
its median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hitlens.plans.fixtures import StoredTables  # noqa: E402
from hitlens.plans.registry import QUERIES  # noqa: E402
from hitlens.session import local_session, stored_table_path  # noqa: E402


# Variants that write text files and read them back: timed with the writing
# and listed apart, so that the headline sum keeps its meaning.
FILE_FED = {"top_position_counts_from_csv", "enrich_ranking_from_files", "series_mean_from_tsv", "word_count_from_text",
            "report_headerless_parts", "report_tuples_read_back", "mean_tuples_read_back", "resolved_parts_read_back",
            "odd_rows_read_back", "ragged_lines", "flatten_works_from_dump", "texts_with_line_breaks", "extension_skipping_two"}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(sys.argv[1:])
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="hitlens-bench")

    t0 = time.perf_counter()
    tables = StoredTables.materialize(spark, sf_dir, stored_table_path(spark, "bench-inputs"))
    prepare = time.perf_counter() - t0

    timings: dict[str, float] = {}
    file_fed: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        run(query(tables))  # warm-up: JIT, file listing, broadcast of small sides
        samples = []
        for _ in range(runs):
            start = time.perf_counter()
            run(query(tables))
            samples.append(time.perf_counter() - start)
        into = file_fed if name in FILE_FED else timings
        into[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {into[name]}s", file=sys.stderr)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "file_fed_queries": file_fed,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "prepare_sec": round(prepare, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
