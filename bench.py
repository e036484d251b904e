"""Time the headline queries: prints one JSON line.

Every query runs twice to completion (all rows computed, none kept); the faster run counts.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = (
    "a2_log_scan", "a7_write_fact", "b18_parse_requests", "c1_apply_vocabulary", "c8_future_events", "c9_future_calls_filled",
    "c12_state_asof", "d1_rollup_flags", "d2_dispositions", "d3_daily_state", "d4_offer_report", "d11_weekly", "d14_median",
    "e1_state_history_first", "e2_state_history_last", "e3_session_state", "e4_current_state", "e5_repeat_penalty", "e6_steps",
    "e7_next_values", "e14_n_step_return", "f4_balance_groups", "f6_epoch_sample", "f7_sample_actions", "h2_diff_in_diff", "h3_offer_before_after",
    "i2_importance_sampling", "i3_weighted_importance_sampling", "i4_doubly_robust", "i7_fitted_q", "j1_stable_runs",
    "j2_best_runs", "j3_metric_rows", "k1_score_policy", "k2_encode_states", "k4_fit_embedding", "k6_decode_tokens", "k7_cold_start", "s2_tail", "t3_decide_stream",
    "t4_assemble_episodes", "t5_sessionize_stream", "t6_ingest_stream", "t7_volume_stream", "v1_build_vocabulary", "v2_dense_id",
)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from offerloom.queries import QUERIES
    from offerloom.session import build_session, configure

    spark = configure(build_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    times = {name: round(min(run(name) for _ in range(2)), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
