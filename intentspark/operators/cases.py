"""Reference cases: a few typical and wrong decisions picked from a whole scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.quantiles import exact_quantiles
from intentspark.operators.policy import decide
from intentspark.roles import DEFAULT_ROLES


def _categories(high_time: float, low_history: float, target: str):
    """Ordered (id, predicate, ascending sort keys); the row key settles ties."""
    p, y, hat = F.col("p"), F.col(target), F.col("yhat")
    edge = F.round(F.abs(p - 0.5), 6)
    zero = F.lit(0.0)
    return [
        ("high_confidence_true_positive", (y == 1) & (hat == 1) & (p >= 0.8), -p, zero),
        ("high_confidence_true_negative", (y == 0) & (hat == 0) & (p <= 0.2), p, zero),
        ("boundary_case", F.lit(True), edge, zero),
        ("false_positive", (y == 0) & (hat == 1), -p, zero),
        ("false_negative", (y == 1) & (hat == 0), -p, zero),
        ("loyalty_positive_intent", (F.col("LoyaltyProgram") == 1) & (p >= 0.65), -p, zero),
        ("non_loyal_high_time", (F.col("LoyaltyProgram") == 0) & (F.col("TimeSpentOnWebsite") >= high_time),
         -F.col("TimeSpentOnWebsite").cast("double"), -p),
        ("low_history_surprise_purchase", (F.col("NumberOfPurchases") <= low_history) & (y == 1), -p, zero),
        ("fallback", F.lit(True), edge, zero),
    ]


def reference_cases(scored: DataFrame, max_cases: int = 8, key: str = "row_id", target: str = fixed.TARGET) -> DataFrame:
    """Up to ``max_cases`` distinct rows: the best unused row of each category, then the rows nearest 0.5.

    Each category can lose at most ``max_cases`` rows to the others, so 2 x max_cases candidates per
    category decide the pick. They come from one pass: the row_number filter is applied inside every task
    before the exchange, so no category is ever gathered. The greedy exclusion then runs over those few
    rows on the driver.
    """
    q = exact_quantiles(scored, {"TimeSpentOnWebsite": [0.75], "NumberOfPurchases": [0.25]})
    categories = _categories(q["TimeSpentOnWebsite"][0], q["NumberOfPurchases"][0], target)
    keep = 2 * max_cases
    fields = [key, "p", "yhat", *DEFAULT_ROLES.columns]
    entries = F.array_compact(F.array(*[
        F.when(condition, F.struct(F.lit(i).alias("c"), first.cast("double").alias("k1"), second.cast("double").alias("k2")))
        for i, (_, condition, first, second) in enumerate(categories)]))
    rank = F.row_number().over(Window.partitionBy("c").orderBy("k1", "k2", key))
    candidates = (
        scored.select(*fields, F.explode(entries).alias("e")).select(*fields, "e.*")
        .withColumn("rn", rank).where(F.col("rn") <= keep)
        .orderBy("c", "rn").collect()
    )
    used: set[str] = set()
    picked = []
    for i, (name, *_rest) in enumerate(categories):
        pool = [r for r in candidates if r["c"] == i]
        quota = max_cases - len(picked) if name == "fallback" else 1
        for r in pool:
            if quota <= 0:
                break
            if r[key] in used:
                continue
            used.add(r[key])
            label = f"fallback_{len(picked) + 1}" if name == "fallback" else name
            picked.append((label, *[r[f] for f in fields]))
            quota -= 1
    schema = "case_id string, " + ", ".join(f"`{f}` {scored.schema[f].dataType.simpleString()}" for f in fields)
    return scored.sparkSession.createDataFrame(picked[:max_cases], schema)


def case_policy(cases: DataFrame, explanations: DataFrame | None = None, bands: dict[str, float] | None = None) -> DataFrame:
    """Decisions of the cases with their two strongest drivers; a case without explanation has none."""
    decided = decide(cases, bands)
    if explanations is None:
        return decided.withColumn("top_drivers", F.array().cast("array<string>"))
    drivers = explanations.select("row_id", F.slice("drivers", 1, 2).alias("top_drivers"))
    return decided.join(drivers, "row_id", "left").withColumn(
        "top_drivers", F.coalesce("top_drivers", F.array().cast("array<string>")))


def case_checks(decided_cases: DataFrame) -> DataFrame:
    """Three policy expectations; NULL where the case is absent."""
    check = lambda case, holds: F.max(F.when(F.col("case_id") == case, holds.cast("int"))).cast("boolean")
    rate, review = F.col("recommended_discount_rate"), F.col("requires_manual_review")
    return decided_cases.agg(
        check("false_positive", rate == 0.0).alias("false_positive_margin_protection"),
        check("boundary_case", review).alias("boundary_case_manual_review"),
        check("non_loyal_high_time", (rate > 0.0) | review).alias("non_loyal_high_time_not_ignored"))


def case_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Cases of several origins in one table; an id that repeats within its origin is an error."""
    both = None
    for origin, cases in parts.items():
        one = cases.select("case_id", *DEFAULT_ROLES.contract_inputs).withColumn("origin", F.lit(origin))
        both = one if both is None else both.unionByName(one)
    if not both.groupBy("origin", "case_id").count().where("count > 1").isEmpty():
        raise ContractError("case ids repeat")
    return both


def scoring_log(decided: DataFrame, reference: DataFrame | None = None, key: str = "row_id") -> DataFrame:
    """Flat log: flags joined by a pipe, with match columns against an earlier run where there is one."""
    log = decided.select(
        key, F.round("p", 6).alias("predicted_probability"), F.col("yhat").alias("predicted_label"), "score_band",
        "recommended_action", "recommended_discount_rate", "requires_manual_review",
        F.array_join("guardrail_flags", "|").alias("guardrail_flags"))
    if reference is None:
        return log
    earlier = reference.select(
        key, F.col("recommended_action").alias("_action"), F.col("score_band").alias("_band"), F.col("p").alias("_p"))
    return log.join(earlier, key, "left").select(
        *log.columns,
        (F.col("recommended_action") == F.col("_action")).alias("action_match"),
        (F.col("score_band") == F.col("_band")).alias("band_match"),
        F.round(F.abs(F.col("predicted_probability") - F.col("_p")), 6).alias("probability_delta"))


def scoring_overview(decisions: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows, share of manual review per outcome; rejected rows appear as their own outcome."""
    everything = Window.partitionBy()
    accepted = decisions.select(F.col("recommended_action").alias("outcome"), F.col("requires_manual_review").cast("int").alias("review"))
    refused = rejects.select(F.lit("rejected").alias("outcome"), F.lit(0).alias("review"))
    return (
        accepted.unionByName(refused).groupBy("outcome").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("review").alias("manual_review_count"))
        .withColumn("share", F.round(F.col("row_count") / F.sum("row_count").over(everything), 6))
    )
