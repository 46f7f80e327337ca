"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quaywork.plans.catalog import QUERIES  # noqa: E402
from quaywork.session import build_session  # noqa: E402

HEADLINE = (
    "a2_isa_fields",
    "a6_locate_files",
    "b7_headers",
    "b9_details",
    "b12_parse_status",
    "b15_envelope_check",
    "b16_render_roundtrip",
    "c1_stage_headers",
    "c2_stage_lines",
    "c5_transitions",
    "c6_integration_log",
    "d1_merge_orders",
    "d2_merge_batch",
    "e3_dashboard_summary",
    "e6_daily_volume",
    "e9_pipeline_funnel",
    "e10_file_reconciliation",
    "e11_report_detail",
    "e17_processing_report",
    "f3_isa_lookup",
    "f4_po_lookup",
    "f7_explain_error",
    "f10_history_tail",
    "f14_rate_limit",
    "f15_search_lines",
    "h2_forced_tier",
    "h7_progress_fold",
    "h9_validate_record",
    "i1_predict_capacity",
    "r1_effective_permissions",
    "s3_stream_parse",
    "s5_order_state",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM and the Python workers once, outside the timings.
    QUERIES["e1_file_summary"](spark, folder).collect()
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
