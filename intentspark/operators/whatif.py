"""What-if sensitivity and rerun consistency of the decision surface, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.functions.scalars import clip, usable_score
from intentspark.operators.contract import Rule
from intentspark.operators.policy import ACTIONS, BANDS, recommend, recommend_arrays, validate_bands
from intentspark.operators.scorers import Additive, Scorer


def perturbations(rules: list[Rule]) -> list[tuple[str, Rule, float | None]]:
    """(variant, rule of its field, difference) of each bounded one-field change; without a difference the next allowed code."""
    rule = {r.column: r for r in rules}
    changes: list[tuple[str, Rule, float | None]] = []
    if "TimeSpentOnWebsite" in rule:
        r = rule["TimeSpentOnWebsite"]
        step = max(fixed.SENSITIVITY_MIN_TIME_STEP, (r.high - r.low) * fixed.SENSITIVITY_SHARE)
        changes += [("time_spent_up", r, step), ("time_spent_down", r, -step)]
    if "NumberOfPurchases" in rule:
        r = rule["NumberOfPurchases"]
        changes += [("purchase_count_up", r, 1), ("purchase_count_down", r, -1)]
    if "AnnualIncome" in rule:
        r = rule["AnnualIncome"]
        step = (r.high - r.low) * fixed.SENSITIVITY_SHARE
        changes += [("income_up", r, step), ("income_down", r, -step)]
    if "LoyaltyProgram" in rule and len(rule["LoyaltyProgram"].allowed) > 1:
        changes.append(("loyalty_toggle", rule["LoyaltyProgram"], None))
    return changes


def _moved(rule: Rule, delta: float | None) -> Column:
    """The changed value, inside the rule's range; of codes the next one, wrapping round."""
    if delta is None:
        following = F.lit(float(rule.allowed[0]))
        for i, code in enumerate(rule.allowed):
            following = F.when(
                F.col(rule.column) == code, F.lit(float(rule.allowed[(i + 1) % len(rule.allowed)]))).otherwise(following)
        return following
    value = clip(F.col(rule.column).cast("double") + F.lit(delta), rule.low, rule.high)
    return F.bround(value, 0) if rule.kind == "integer_range" else F.round(value, 6)


def _moved_array(rule: Rule, delta: float | None, own: np.ndarray) -> np.ndarray:
    if delta is None:
        following = np.full(own.shape, float(rule.allowed[0]))
        for i, code in enumerate(rule.allowed):
            following[own == code] = rule.allowed[(i + 1) % len(rule.allowed)]
        return following
    value = own + delta
    value = np.clip(value, rule.low, rule.high) + (value - value)
    return np.rint(value) if rule.kind == "integer_range" else rounded(value)


def rounded(x: np.ndarray) -> np.ndarray:
    """`round(x, 6)` of Spark: halves away from zero, judged on the shortest decimal text of the number. Only a value next
    to a tie, or a large one, needs the decimals."""
    shifted = np.abs(x) * 1_000_000.0 + 0.5
    whole = np.floor(shifted)
    out = np.copysign(whole / 1_000_000.0, x) + 0.0
    part = shifted - whole
    for i in np.argwhere(np.isfinite(x) & ~((part > 0.001) & (part < 0.999) & (shifted < 1e14))):
        v = float(x[tuple(i)])
        out[tuple(i)] = v if abs(v) > 1e15 else float(Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) + 0.0
    return np.where(np.isfinite(x), out, x)


def sensitivity_variants(valid: DataFrame, rules: list[Rule], scorer: Scorer,
                         bands: dict[str, float] | None = None, key: str = "row_id") -> DataFrame:
    """Every row's variants, scored and decided, against the row's own baseline.

    The baseline travels with the row, so nothing is joined back and nothing is shuffled. No-op changes
    are left out, and so is a change that repeats an earlier one of the same field. A row's real changes are gathered in
    an array first, so only these are exploded, and scoring them is a generated method of its own, short enough to be compiled.
    """
    features = [r.column for r in rules]
    types = dict(valid.dtypes)
    baseline = recommend(scorer.score(valid.select(key, *features)), bands).select(
        key, *features, F.col("p").alias("base_p"), F.col("score_band").alias("base_band"),
        F.col("recommended_action").alias("base_decision"), F.col("requires_manual_review").alias("base_review"))
    changes = perturbations(rules)
    moved = []
    for i, (_, rule, step) in enumerate(changes):
        field, value = rule.column, _moved(rule, step)
        fresh = value != F.col(field).cast("double")
        for _, earlier, earlier_step in changes[:i]:
            if earlier.column == field:
                fresh = fresh & (value != _moved(earlier, earlier_step))
        inputs = [(value.cast(types[c]) if c == field else F.col(c)).alias(c) for c in features]
        moved.append(F.when(fresh, F.struct(F.lit(i).alias("_v"), *inputs)))
    # rows carry only the number of their variant; names are attached after scoring
    pick = lambda values: _by_number([F.lit(v) for v in values])
    changed = baseline.select(key, "base_p", "base_band", "base_decision", "base_review",
                              F.inline(F.array_compact(F.array(*moved))))
    decided = recommend(scorer.score(changed), bands)
    delta = F.abs(F.col("p") - F.col("base_p"))
    return decided.select(
        key, pick([v for v, _, _ in changes]).alias("variant_id"), pick([r.column for _, r, _ in changes]).alias("field_name"),
        "base_p", "base_band", "base_decision", "p", "score_band", "recommended_action", "requires_manual_review",
        F.round(delta, 6).alias("probability_delta"), delta.alias("raw_delta"),
        (F.col("recommended_action") != F.col("base_decision")).alias("action_changed"),
        (F.col("score_band") != F.col("base_band")).alias("band_changed"),
        (F.col("requires_manual_review") != F.col("base_review")).alias("manual_review_changed"))


def _by_number(values: list[Column]) -> Column:
    out = F.when(F.col("_v") == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        out = out.when(F.col("_v") == i, value)
    return out


@dataclass
class Changes:
    """A batch's real changes, rows by changes, against the rows' own baselines."""

    batch: pa.RecordBatch
    base_p: np.ndarray
    unscored: np.ndarray
    base_band: np.ndarray
    base_action: np.ndarray
    real: np.ndarray
    unusable: np.ndarray
    delta: np.ndarray
    action: np.ndarray
    band: np.ndarray
    review: np.ndarray


def _changes(additive: Additive, rules: list[Rule], bands: dict[str, float], history: str = "DiscountsAvailed"):
    """`Changes` of Arrow batches: parts of the score that a change leaves alone are computed once for all changes."""
    moves = perturbations(rules)

    def run(batch: pa.RecordBatch) -> Changes:
        read = lambda name: batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
        own = {r.column: read(r.column) for r in rules}
        null = np.zeros(batch.num_rows, bool)
        for name in additive.needs:
            null |= batch.column(name).is_null().to_numpy(zero_copy_only=False)
        past = np.nan_to_num(own[history], posinf=np.inf, neginf=-np.inf) if history in own else np.zeros(batch.num_rows)
        kept = [value(*[own[f] for f in names]) for names, value in additive.parts]
        real = np.zeros((batch.num_rows, len(moves)), bool)

        def score(field: str | None, moved: np.ndarray | None) -> np.ndarray:
            total = np.full(batch.num_rows, additive.start)
            for (names, value), same in zip(additive.parts, kept, strict=True):
                total = total + (value(*[moved if f == field else own[f] for f in names]) if field in names else same)
            return np.where(null, np.nan, rounded(additive.curve(total)))

        base = score(None, None)
        p, before = np.empty(real.shape), []
        for i, (_, rule, step) in enumerate(moves):
            field, value = rule.column, _moved_array(rule, step, own[rule.column])
            real[:, i] = ~np.isnan(own[field]) & (value != own[field])
            for earlier_field, earlier in before:
                if earlier_field == field:
                    real[:, i] &= (value != earlier) & ~(np.isnan(value) & np.isnan(earlier))
            before.append((field, value))
            p[:, i] = score(field, value)
        base_band, base_action, base_review = recommend_arrays(base, past, bands)
        band, action, review = recommend_arrays(p, past[:, None], bands)
        compared = (action >= 0) & (base_action >= 0)[:, None] & real
        return Changes(batch, base, null, base_band, base_action, real, real & ~((p >= 0.0) & (p <= 1.0)),
                       np.where(real & ~null[:, None], np.abs(p - base[:, None]), -1.0), compared & (action != base_action[:, None]),
                       real & (band != base_band[:, None]), real & (review != base_review[:, None]))

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[Changes]:
        for batch in batches:
            with np.errstate(all="ignore"):
                yield run(batch)

    return changes


def _largest(delta: np.ndarray, axis: int) -> pa.Array:
    """NULL where no real change has a score."""
    most = delta.max(axis=axis, initial=-1.0)
    return pa.array(most, pa.float64(), mask=most == -1.0)


def _by_row(changes: Callable, key: str):
    names = [key, "base_p", "_band", "_action", "variant_count", "raw_delta", "action_change_count", "band_change_count", "manual_review_change_count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in changes(batches):
            count = lambda flags: pa.array(flags.sum(axis=1), pa.int64())
            rows = pa.RecordBatch.from_arrays([
                c.batch.column(key), pa.array(c.base_p, mask=c.unscored), pa.array(c.base_band, pa.int32()),
                pa.array(c.base_action, pa.int32(), mask=c.base_action < 0), count(c.real), _largest(c.delta, 1), count(c.action), count(c.band),
                count(c.review)], names)
            yield rows.filter(pa.array(c.real.any(axis=1)))

    return run


def _by_variant(changes: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in changes(batches):
            count = lambda flags: pa.array(flags.sum(axis=0), pa.int64())
            scored = c.delta != -1.0
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(c.real.shape[1]), pa.int32()), count(c.real), count(scored), pa.array(np.where(scored, c.delta, 0.0).sum(axis=0), pa.float64()),
                _largest(c.delta, 0), count(c.unusable), count(c.action), count(c.band), count(c.review)],
                ["_v", "n", "scored", "total", "most", "unusable", "action", "band", "review"])

    return run


def _in_arrays(valid: DataFrame, rules: list[Rule], scorer: Scorer, bands: dict[str, float] | None) -> Callable | None:
    """`_changes` if the scorer states its score over arrays and the columns have the contract's types."""
    types = dict(valid.dtypes)
    additive = scorer.additive(types) if hasattr(scorer, "additive") else None
    columns = {r.column for r in rules}
    if not additive or any(f not in columns for names, _ in additive.parts for f in names) or any(
            types[r.column] != ("double" if r.kind == "float_range" else "int") for r in rules):
        return None
    return _changes(additive, rules, validate_bands(bands or fixed.DEFAULT_BANDS))


def row_sensitivity(valid: DataFrame, rules: list[Rule], scorer: Scorer, bands: dict[str, float] | None = None,
                    key: str = "row_id") -> DataFrame:
    """`sensitivity_summary` of the variants of `valid`. A scorer that is a curve over a sum of parts scores a row's changes
    in arrays and reduces them there; only the reduced record is exchanged, since rows with one key and baseline count as one."""
    changes = _in_arrays(valid, rules, scorer, bands)
    if not changes:
        return sensitivity_summary(sensitivity_variants(valid, rules, scorer, bands, key), key)
    counts = ("variant_count", "action_change_count", "band_change_count", "manual_review_change_count")
    rows = valid.select(key, *[r.column for r in rules]).mapInArrow(
        _by_row(changes, key), f"`{key}` {dict(valid.dtypes)[key]}, base_p double, _band int, _action int, variant_count long, raw_delta double, "
        "action_change_count long, band_change_count long, manual_review_change_count long")
    name = lambda names, at: F.get(F.array(*[F.lit(n) for n in names]), F.col(at))
    stable = (F.col("action_change_count") == 0) & (F.col("band_change_count") == 0)
    return rows.groupBy(key, "base_p", "_band", "_action").agg(
        F.max("raw_delta").alias("raw_delta"), *[F.sum(c).alias(c) for c in counts]).select(
        key, "base_p", name(BANDS, "_band").alias("base_band"), name(ACTIONS, "_action").alias("base_decision"), "variant_count",
        F.round("raw_delta", 6).alias("max_probability_delta"), *counts[1:],
        F.when(stable, "stable").otherwise("monitor").alias("stability_assessment"))


def variant_totals(valid: DataFrame, rules: list[Rule], scorer: Scorer, bands: dict[str, float] | None = None,
                   key: str = "row_id") -> DataFrame:
    """`variant_effects` of the variants of `valid`, and how many have no usable score."""
    changes = _in_arrays(valid, rules, scorer, bands)
    if not changes:
        variants = sensitivity_variants(valid, rules, scorer, bands, key)
        return _effects(variants, F.count_if(~usable_score(F.col("p"))).alias("unusable_count"))
    parts = valid.select(*[r.column for r in rules]).mapInArrow(
        _by_variant(changes), "_v int, n long, scored long, total double, most double, unusable long, action long, band long, review long")
    moves = perturbations(rules)
    return parts.groupBy("_v").agg(
        F.sum("n").alias("variant_count"), F.round(F.sum("total") / F.nullif(F.sum("scored"), F.lit(0)), 6).alias("mean_probability_delta"),
        F.round(F.max("most"), 6).alias("max_probability_delta"), F.sum("action").alias("action_change_count"),
        F.sum("band").alias("band_change_count"), F.sum("review").alias("manual_review_change_count"),
        F.sum("unusable").alias("unusable_count")).where("variant_count > 0").select(
        _by_number([F.lit(v) for v, _, _ in moves]).alias("variant_id"), _by_number([F.lit(r.column) for _, r, _ in moves]).alias("field_name"), "*").drop("_v")


def sensitivity_summary(variants: DataFrame, key: str = "row_id") -> DataFrame:
    """Largest change and change counts per base row. A row's variants sit in one task, so the
    map-side combine already reduces them to a single record before the exchange."""
    stable = (F.col("action_change_count") == 0) & (F.col("band_change_count") == 0)
    return (
        variants.groupBy(key, "base_p", "base_band", "base_decision").agg(
            F.count(F.lit(1)).alias("variant_count"),
            F.round(F.max("raw_delta"), 6).alias("max_probability_delta"),
            F.count_if("action_changed").alias("action_change_count"),
            F.count_if("band_changed").alias("band_change_count"),
            F.count_if("manual_review_changed").alias("manual_review_change_count"))
        .withColumn("stability_assessment", F.when(stable, "stable").otherwise("monitor"))
    )


def variant_effects(variants: DataFrame) -> DataFrame:
    return _effects(variants)


def _effects(variants: DataFrame, *more: Column) -> DataFrame:
    return variants.groupBy("variant_id", "field_name").agg(
        F.count(F.lit(1)).alias("variant_count"),
        F.round(F.avg("raw_delta"), 6).alias("mean_probability_delta"),
        F.round(F.max("raw_delta"), 6).alias("max_probability_delta"),
        F.count_if("action_changed").alias("action_change_count"),
        F.count_if("band_changed").alias("band_change_count"),
        F.count_if("manual_review_changed").alias("manual_review_change_count"), *more)


def sensitivity_overview(summary: DataFrame) -> DataFrame:
    return summary.groupBy("base_band", "stability_assessment").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("variant_count").alias("variant_count"),
        F.round(F.avg("max_probability_delta"), 6).alias("mean_max_delta"),
        F.max("max_probability_delta").alias("max_probability_delta"),
        F.sum("action_change_count").alias("action_change_count"),
        F.sum("band_change_count").alias("band_change_count"),
        F.sum("manual_review_change_count").alias("manual_review_change_count"))


def rerun_consistency(frame: DataFrame, scorer: Scorer, bands: dict[str, float] | None = None,
                      key: str = "row_id", reruns: int = 2) -> DataFrame:
    """Scores the table again under another partitioning and compares every decision by key.

    The rows are exchanged once and scored anew for every rerun after that. A key that one side lacks counts as missing and breaks determinism.
    """
    def surface(df: DataFrame, prefix: str) -> DataFrame:
        return recommend(scorer.score(df), bands).select(
            key, F.col("p").alias(f"{prefix}_p"), F.col("recommended_action").alias(f"{prefix}_action"),
            F.col("score_band").alias(f"{prefix}_band"), F.col("requires_manual_review").alias(f"{prefix}_review"))

    again = frame.repartition(key).withColumn("run_index", F.explode(F.sequence(F.lit(1), F.lit(reruns))))
    rerun = recommend(scorer.score(again), bands).select(
        key, "run_index", F.col("p").alias("again_p"), F.col("recommended_action").alias("again_action"),
        F.col("score_band").alias("again_band"), F.col("requires_manual_review").alias("again_review"))
    joined = surface(frame, "first").join(rerun, key, "full")
    missing = F.col("first_action").isNull() | F.col("again_action").isNull()
    differs = lambda name: F.count_if(~F.col(f"first_{name}").eqNullSafe(F.col(f"again_{name}")))
    delta = F.max(F.round(F.abs(F.col("first_p") - F.col("again_p")), 6))
    out = joined.agg(
        F.lit(reruns).alias("runs_evaluated"), F.count(F.lit(1)).alias("compared_rows"),
        delta.alias("max_probability_delta"), differs("action").alias("action_mismatch_count"),
        differs("band").alias("band_mismatch_count"), differs("review").alias("manual_review_mismatch_count"),
        F.count_if(missing).alias("missing_rows"))
    return out.withColumn(
        "deterministic",
        (F.col("max_probability_delta") <= fixed.ALIGNMENT_TOLERANCE) & (F.col("action_mismatch_count") == 0)
        & (F.col("band_mismatch_count") == 0) & (F.col("manual_review_mismatch_count") == 0)
        & (F.col("missing_rows") == 0))


def replay_alignment(first: DataFrame, second: DataFrame, key: str = "row_id") -> DataFrame:
    """Two decided runs by key: do action, band and review agree and is the score within tolerance?"""
    side = lambda df, s: df.select(
        key, F.col("p").alias(f"p_{s}"), F.col("recommended_action").alias(f"action_{s}"),
        F.col("score_band").alias(f"band_{s}"), F.col("requires_manual_review").alias(f"review_{s}"))
    joined = side(first, "a").join(side(second, "b"), key, "full")
    same = lambda name: F.col(f"{name}_a").eqNullSafe(F.col(f"{name}_b"))
    close = F.coalesce(F.round(F.abs(F.col("p_a") - F.col("p_b")), 9) <= fixed.ALIGNMENT_TOLERANCE, F.lit(False))
    return joined.select(
        key, same("action").alias("action_match"), same("band").alias("band_match"),
        same("review").alias("manual_review_match"), F.round(F.abs(F.col("p_a") - F.col("p_b")), 6).alias("probability_delta"),
        (same("action") & same("band") & same("review") & close).alias("aligned"))
