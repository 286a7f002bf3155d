"""Headline queries, timed once each; prints one JSON line."""

from __future__ import annotations

import importlib
import json
import os
import time

from quillmere.session import build_session

HEADLINE = [
    "p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_ids", "p8_mix", "p9_found",
    "label_histogram", "page_classifier", "segment_sections", "tiered_match", "session_numbering", "dense_ids_shift",
    "entity_rollup", "quantiles_linear", "date_shift_text", "scrub_names_dictionary", "json_repair", "run_diff", "stem_join",
]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus)
    queries = importlib.import_module("__spark_entry__").queries()
    queries["event_type_counts"](spark, folder).write.format("noop").mode("overwrite").save()  # starts the executors
    took = {}
    for name in HEADLINE:
        if name in queries:
            began = time.time()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
