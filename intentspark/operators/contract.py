"""Input contracts: rules learned from a table, applied to every row of another one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.scalars import ceil_step, floor_step, labels, lenient_double, round_step, total
from intentspark.operators.policy import decide
from intentspark.operators.scorers import Scorer
from intentspark.roles import DEFAULT_ROLES, RoleSpec
from intentspark.sources.contracts import require_columns

MAX_ALLOWED_VALUES = 10_000
RULE_SCHEMA = (
    "column_name string, kind string, min_value double, max_value double, allowed_values array<int>, "
    "example_value double"
)


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    low: float | None = None
    high: float | None = None
    allowed: tuple[int, ...] = ()
    example: float = 0.0


def learn_rules(df: DataFrame, roles: RoleSpec = DEFAULT_ROLES) -> list[Rule]:
    """One rule per contract column: allowed codes, integer range or float range.

    Only extremes and code lists reach the driver; a code list is refused beyond MAX_ALLOWED_VALUES.
    """
    require_columns(df, roles.contract_inputs)
    ranged = [c for c in roles.contract_inputs if c not in roles.categorical]
    coded = [c for c in roles.contract_inputs if c in roles.categorical]
    bounds = df.agg(*[f(lenient_double(c)).alias(f"{n}_{c}") for c in ranged for n, f in (("lo", F.min), ("hi", F.max))])
    row = bounds.first()
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), lenient_double(c).cast("int").alias("v")) for c in coded]))
    codes: dict[str, list[int]] = {c: [] for c in coded}
    distinct = df.select(pairs.alias("e")).select("e.*").where(F.col("v").isNotNull()).distinct()
    for r in distinct.limit(MAX_ALLOWED_VALUES + 1).collect():
        codes[r["c"]].append(r["v"])
    if sum(len(v) for v in codes.values()) > MAX_ALLOWED_VALUES:
        raise ContractError("too many category codes for an allowed-value rule")
    rules = []
    for c in roles.contract_inputs:
        if c in codes:
            if not codes[c]:
                raise ContractError(f"{c} holds no usable number")
            allowed = tuple(sorted(codes[c]))
            rules.append(Rule(c, "categorical_integer", allowed=allowed, example=float(allowed[0])))
            continue
        low, high = row[f"lo_{c}"], row[f"hi_{c}"]
        if low is None:
            raise ContractError(f"{c} holds no usable number")
        if c in roles.integer_like:
            low, high = float(int(low)), float(int(high))
            rules.append(Rule(c, "integer_range", low, high, example=float(round((low + high) / 2))))
        else:
            rules.append(Rule(c, "float_range", round(low, 6), round(high, 6), example=round((low + high) / 2, 6)))
    return rules


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.column, r.kind, r.low, r.high, list(r.allowed) or None, r.example) for r in rules], RULE_SCHEMA)


def widen_rules(rules: DataFrame) -> DataFrame:
    """Float ranges widened to friendly steps, leaky fields left out."""
    step = F.lit(1.0)
    for column, size in fixed.RULE_STEPS.items():
        step = F.when(F.col("column_name") == column, F.lit(size)).otherwise(step)
    is_float = F.col("kind") == "float_range"
    pick = lambda name, f: F.when(is_float, f(F.col(name), step)).otherwise(F.col(name)).alias(name)
    return rules.where(~F.col("column_name").isin(*fixed.LEAKY)).select(
        "column_name", "kind", pick("min_value", floor_step), pick("max_value", ceil_step), "allowed_values",
        pick("example_value", round_step))


def _violation(df: DataFrame, rule: Rule) -> Column:
    """First failing reason of one column, or NULL."""
    name = rule.column
    label = lambda reason: F.lit(f"{name}:{reason}")
    if name not in df.columns:
        return label("missing")
    data_type = df.schema[name].dataType
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(F.col(name).isNull(), label("blank")).otherwise(label("not_scalar"))
    if isinstance(data_type, T.NumericType):
        # already a number: no detour over text
        number = F.col(name).cast("double")
        chain = F.when(number.isNull(), label("blank"))
        if isinstance(data_type, (T.DoubleType, T.FloatType)):
            chain = chain.when(F.isnan(number), label("not_numeric")).when(
                F.abs(number) == float("inf"), label("not_finite"))
    else:
        text = F.trim(F.col(name).cast("string"))
        number = text.try_cast("double")
        chain = (
            F.when(text.isNull() | (text == ""), label("blank"))
            .when(number.isNull() | F.isnan(number), label("not_numeric"))
            .when(F.abs(number) == float("inf"), label("not_finite"))
        )
    if rule.kind in ("categorical_integer", "integer_range"):
        chain = chain.when(number != F.floor(number), label("not_integer"))
    if rule.kind == "categorical_integer":
        return chain.when(~number.isin(*[float(v) for v in rule.allowed]), label("not_allowed"))
    return chain.when((number < rule.low) | (number > rule.high), label("out_of_range"))


def _reasons(df: DataFrame, rules: list[Rule], passthrough: tuple[str, ...]) -> list[Column]:
    known = {r.column for r in rules} | set(passthrough)
    return [F.lit(f"{c}:unexpected") for c in df.columns if c not in known] + [_violation(df, r) for r in rules]


def check_rows(df: DataFrame, rules: list[Rule], passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``violations``: one reason per failing column of each row, in rule order."""
    return df.withColumn("violations", labels(*_reasons(df, rules, passthrough)))


def normalise(checked: DataFrame, rules: list[Rule]) -> DataFrame:
    """Contract types for rows that passed: whole numbers as int, fractions at 6 decimals."""
    for r in rules:
        number = F.col(r.column)
        if not isinstance(checked.schema[r.column].dataType, T.NumericType):
            number = F.trim(number.cast("string")).try_cast("double")
        checked = checked.withColumn(
            r.column, F.round(number.cast("double"), 6) if r.kind == "float_range" else number.cast("int"))
    return checked


def split_valid(df: DataFrame, rules: list[Rule], passthrough: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid normalised rows, rejects with their violations); nothing is dropped silently.

    The valid side only tests the reasons; the list of reasons is built for rejected rows alone.
    """
    clean = F.lit(True)
    for reason in _reasons(df, rules, passthrough):
        clean = clean & reason.isNull()
    return normalise(df.where(clean), rules), check_rows(df.where(~clean), rules, passthrough)


def contract_summary(df: DataFrame, rules: list[Rule], passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Rows per violation reason, plus the rows that passed."""
    reasons = F.when(F.size("violations") == 0, F.array(F.lit("valid"))).otherwise(F.col("violations"))
    return (
        check_rows(df, rules, passthrough).select(F.explode(reasons).alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
    )


def batch_score(df: DataFrame, rules: list[Rule], scorer: Scorer, bands: dict[str, float] | None = None,
                passthrough: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Validate, score and decide a whole table: (decisions in the output contract, rejects of the contract).

    A valid row that the scorer gives no probability, or whose history is negative, stays among the decisions without an
    action, flagged for manual review: a filter on the score would repeat the whole scoring expression in its predicate.
    """
    valid, rejects = split_valid(df, rules, passthrough)
    decided = decide(scorer.score(valid), bands)
    return output_contract(decided, passthrough), rejects


def output_contract(decided: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    rationale = F.concat(
        F.lit("score in "), F.col("score_band"), F.lit(" suggests "), F.col("base_action"),
        F.when(F.col("recommended_action") != F.col("base_action"),
               F.concat(F.lit("; moved to "), F.col("recommended_action"))).otherwise(""),
        F.when(F.col("requires_manual_review"), "; manual review").otherwise(""))
    return decided.select(
        *passthrough,
        F.round("p", 6).alias("purchase_score"), F.col("yhat").alias("predicted_label"),
        F.col("score_band").alias("risk_band"), "recommended_action", "recommended_discount_rate",
        "requires_manual_review", "guardrail_flags", rationale.alias("short_rationale"))


def mutations(rules: list[Rule]) -> list[tuple[str, str, bool, str | None]]:
    """(mutation, column, whether it must be accepted, value as text) for every rule, from its kind."""
    out: list[tuple[str, str, bool, str | None]] = []
    for r in rules:
        if r.kind == "categorical_integer":
            out += [("known_code", r.column, True, str(r.allowed[-1])), ("unknown_code", r.column, False, str(r.allowed[-1] + 1))]
        else:
            whole = r.kind == "integer_range"
            text = lambda v: str(int(v)) if whole else repr(float(v))  # noqa: B023 (used at once)
            out += [("at_lower_bound", r.column, True, text(r.low)), ("at_upper_bound", r.column, True, text(r.high)),
                    ("below_range", r.column, False, text(r.low - 1)), ("above_range", r.column, False, text(r.high + 1))]
        out += [("left_blank", r.column, False, None), ("not_a_number", r.column, False, "n/a")]
    return out


def mutate(df: DataFrame, rules: list[Rule], passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Every row once per mutation, as text, with one field replaced."""
    each = F.array(*[
        F.struct(F.lit(m).alias("mutation"), F.lit(c).alias("column_name"), F.lit(ok).alias("expected_valid"), F.lit(v).cast("string").alias("value"))
        for m, c, ok, v in mutations(rules)])
    field = lambda c: F.when(F.col("_m.column_name") == c, F.col("_m.value")).otherwise(F.col(c).cast("string")).alias(c)
    return df.withColumn("_m", F.explode(each)).select(*passthrough, "_m.mutation", "_m.column_name", "_m.expected_valid", *[field(r.column) for r in rules])


def mutation_matrix(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per mutation and column: how many of the table's valid rows are accepted and refused after it.

    Rows that break a rule before any change are left to `contract_summary`. A changed row is accepted if its new value is
    and its other fields, as text, are. The value is the same for all rows, so it is checked once, and every row's own
    fields are: no row is repeated for each mutation."""
    valid, _ = split_valid(df.select(*[r.column for r in rules]), rules)
    text = valid.select(*[F.col(r.column).cast("string").alias(r.column) for r in rules])
    wrong = text.select(*[_violation(text, r).isNotNull().cast("int").alias(r.column) for r in rules])
    faults = wrong.withColumn("_n", total([F.col(r.column) for r in rules]))
    rows = faults.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.count_if(F.col("_n") == F.col(r.column)).alias(f"_{r.column}") for r in rules])
    each = F.explode(F.array(*[
        F.struct(F.lit(m).alias("mutation"), F.lit(c).alias("column_name"), F.lit(ok).alias("expected_valid"),
                 F.lit(v).cast("string").alias("_value"), F.col(f"_{c}").alias("_others"))
        for m, c, ok, v in mutations(rules)]))
    changed = rows.where("_rows > 0").select("_rows", each.alias("_m")).select("_rows", "_m.*").withColumns({r.column: F.col("_value") for r in rules})
    fits = F.coalesce(*[F.when(F.col("column_name") == r.column, _violation(changed, r).isNull()) for r in rules])
    accepted = F.when(fits, F.col("_others")).otherwise(F.lit(0).cast("long"))
    return changed.select("mutation", "column_name", "expected_valid", "_rows", accepted.alias("accepted_rows")).select(
        "mutation", "column_name", "expected_valid", "accepted_rows", (F.col("_rows") - F.col("accepted_rows")).alias("refused_rows"),
        F.when(F.col("accepted_rows") == F.when(F.col("expected_valid"), F.col("_rows")).otherwise(0), "passed").otherwise("failed").alias("status"))
