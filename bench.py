"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from intentspark.operators import learners  # noqa: E402
from intentspark.operators.contract import batch_score, learn_rules  # noqa: E402
from intentspark.operators.policy import decide  # noqa: E402
from intentspark.operators.scorers import Scorecard  # noqa: E402
from intentspark.operators.whatif import sensitivity_summary  # noqa: E402
from intentspark.plans import decision_queries, registry  # noqa: E402
from intentspark.plans.frames import lines, scored_lines, side  # noqa: E402
from intentspark.session import build_session  # noqa: E402

INPUTS = decision_queries.INPUTS


def run(df):
    """Executes the whole plan and throws the rows away."""
    df.write.format("noop").mode("overwrite").save()


def score_whole_table(spark, sf):
    frame = lines(spark, sf).select("row_id", *INPUTS)
    decisions, rejects = batch_score(frame, learn_rules(frame), Scorecard(), passthrough=("row_id",))
    run(decisions)
    run(rejects)


def feature_pipeline(spark, sf):
    frame = lines(spark, sf)
    model = learners.matrix_pipeline("linear").fit(side(frame, "train"))
    run(model.transform(frame).select("row_id", "features"))


def trees(spark, sf):
    learners.fit_tree(side(lines(spark, sf), "train"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "intentspark-bench")
    queries = registry.queries()
    registered = lambda name: lambda s, d: run(queries[name](s, d))
    cases = {
        "batch_score": score_whole_table,
        "policy_frame": lambda s, d: run(decide(scored_lines(s, d))),
        "policy_band_summary": registered("policy_band_summary"),
        "classifier_metrics": registered("classifier_metrics"),
        "segment_performance": registered("segment_performance"),
        "fairness_gaps": registered("fairness_gaps"),
        "threshold_sweep": registered("threshold_sweep"),
        "sensitivity_summary": lambda s, d: run(sensitivity_summary(decision_queries.variants(s, d))),
        "rerun_consistency": registered("rerun_consistency"),
        "customer_profile": registered("customer_profile"),
        "quantile_bands": registered("quantile_bands"),
        "stratified_split_exact": registered("stratified_split_exact"),
        "feature_pipeline": feature_pipeline,
        "fit_logistic": lambda s, d: learners.fit_logistic(side(lines(s, d), "train")),
        "fit_decision_tree": trees,
    }
    run(registry.flagship(spark, sf))  # warm-up: class loading and first code generation
    rows = lines(spark, sf).count()
    timings = {}
    for name, case in cases.items():
        start = time.perf_counter()
        case(spark, sf)
        timings[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    whole_table = ("batch_score", "policy_frame", "segment_performance", "threshold_sweep", "sensitivity_summary")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "rows": rows,
        "rows_per_sec": {n: round(rows / timings[n]) for n in whole_table},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
