"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query runs to
the end over its whole tables; the result goes to a sink that discards it.  Queries that
parse records read text files which are written beforehand, outside the timing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridgepole.checks import QUERIES, fixed_width  # noqa: E402
from ridgepole.operators.fixed_width import parse_lines, parse_lines_inferred  # noqa: E402
from ridgepole.operators.layout import column_spans  # noqa: E402
from ridgepole.session import local_session, remove_dir, scratch_dir  # noqa: E402
from ridgepole.sources.text_lines import read_lines  # noqa: E402

#: What makes the records, and what is timed on them.
STORED = {
    "fixed_width_parse": (fixed_width.line_item_lines, lambda lines: parse_lines(lines, fixed_width.LINE_ITEM)),
    "fixed_width_agg": (fixed_width.line_item_lines, lambda lines: fixed_width.summary(parse_lines(lines, fixed_width.LINE_ITEM))),
    "fixed_width_infer_types": (fixed_width.untyped_order_lines, lambda lines: parse_lines_inferred(lines, fixed_width.UNTYPED_ORDER)),
    "fixed_width_infer_layout": (fixed_width.spaced_order_lines, column_spans),
}

HEADLINE = [
    "fixed_width_agg",
    "fixed_width_parse",
    "fixed_width_load",
    "fixed_width_infer_types",
    "fixed_width_infer_layout",
    "layout_build",
    "acq_clean_full",
    "sentinel_to_null_loans",
    "century_fix",
    "union_relaxed",
    "combine_by_type",
    "outer_join_halves",
    "acq_recent_columns",
    "range_expand_names",
    "dedupe_keep_first",
    "gap_detect",
    "resolve_dictionary",
    "hive_partition_roundtrip",
    "silver_build",
    "page_links",
    "incremental_convert",
]


def store_lines(spark, sf_dir: str) -> dict:
    """Text files of every maker's records, as a release would bring them."""
    paths = {}
    for make, _ in STORED.values():
        if make not in paths:
            paths[make] = scratch_dir(spark, "bench-lines")
            make(spark, sf_dir).selectExpr("cast(value as string) as value").repartition(8).write.text(paths[make])
    return paths


def run(spark, name: str, sf_dir: str, stored: dict) -> float:
    began = time.perf_counter()
    if name in STORED:
        make, timed = STORED[name]
        found = timed(read_lines(spark, stored[make]))
    else:
        found = QUERIES[name](spark, sf_dir)
    found.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "8g"), shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    stored = store_lines(spark, sf_dir)
    run(spark, HEADLINE[0], sf_dir, stored)  # start the engine
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir, stored)
        times[name] = round(run(spark, name, sf_dir, stored), 3)
    for path in stored.values():
        remove_dir(spark, path)
    print(
        json.dumps(
            {
                "metric": "headline queries, second run each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
