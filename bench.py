"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with a ``noop`` write (no collect to the driver).
JVM start-up and a small warm-up query are excluded from the timings.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_text",
    "clean_text_pages",
    "filter_nonempty_input",
    "stats_total_pooled",
    "corpus_stats",
    "dedup_exact",
    "minhash_signature",
    "dedup_near_greedy",
    "dedup_pipeline",
    "clean_columns",
    "tsv_tokens_to_sentences",
    "token_rows_to_documents",
    "category_texts",
    "write_sized_gzip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from corpusmill.plans.registry import queries
    from corpusmill.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="corpusmill-bench")
    qs = queries()

    # warm-up: JVM code paths and the Python worker used by the Arrow UDFs
    qs["normalize_nfc"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            df = qs[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
        except Exception as exc:  # keep the JSON line: report the failure instead of a time
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)

    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
