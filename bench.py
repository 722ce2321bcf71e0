"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input
and the cores. Each result is computed in full and thrown away (`noop` sink), so no
time goes into moving rows to the driver.
"""

from __future__ import annotations

import json
import os
import time

from pairmill.plans.catalog import QUERIES
from pairmill.session import build_session, release

HEADLINE = [
    "ngram_counts",
    "pair_counts",
    "token_marginals",
    "word_marginals",
    "decade_totals",
    "pair_stats",
    "top_pairs",
    "ranked_pairs",
    "stage_record_counts",
    "kv_parse",
    "gold_pmi",
    "f_measure_best",
    "pages_to_text",
    "docs_to_html",
    "convert_dispatch",
    "job_completion",
    "html_report",
    "stream_job_completion",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "pairmill-bench",
        f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query, so that starting the JVM's workers is in no query's time.
    QUERIES["pages_to_text"](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_time", "value": total, "unit": "sec"}
    result.update(queries=seconds, sf=os.path.basename(sf.rstrip("/")).removeprefix("sf"))
    print(json.dumps(result))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
