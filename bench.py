"""Time the headline queries, or those named, or ``--all``: prints one JSON line.

Each query is run to the end of its plan and its rows are thrown away (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tutelage.plans.catalog import QUERIES
from tutelage.session import local_session

HEADLINE = """
a1_read_labeled a5_write_distill_sets a8_pairs_from_turns b3_credit_train_prompt b4_credit_chat_prompt b12_few_shot_prompt b13_strip_prompt
b18_route_models c1_class_distribution c2_balance_orders c3_balanced_val c4_stratified_n c7_train_test_split c8_shuffle_rank c11_build_sets
d1_tokenize d2_mask_prompt d4_length_report e2_token_logprob e3_sequence_score e4_raw_scores e5_null_prior e7_predict e10_score_requests
e11_perplexity e12_infer_batch e13_fit_count_lm e13_count_lm_scores calibrated_eval f3_full_report f8_json_eval f11_eval_sft f13_compare_models
f14_margin_distribution f15_field_prf f16_class_drift g1_validate_json g3_extract_invoice g5_line_items g5_reconcile g8_pair_quality h1_join_teacher
h3_train_student i1_score_stream i2_kpi_batch
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = sys.argv[1:]
    if asked == ["--all"]:
        names = list(QUERIES)
    elif asked:
        names = [n for n in QUERIES if n.startswith(tuple(asked))]
    else:
        names = HEADLINE
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    warm = spark.read.parquet(f"{sf_dir}/orders.parquet")
    warm.groupBy("o_orderstatus").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        fn = QUERIES[name]
        start = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
        if os.environ.get("BENCH_VERBOSE"):
            print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
