from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentspark.errors import ContractError, SinkError
from intentspark.functions.scalars import rounded_score
from intentspark.operators import cases, contract, explain, learners, whatif
from intentspark.operators.scorers import ExpressionScorer, RuleScorer, Scorecard
from intentspark.plans.decision_queries import INPUTS
from intentspark.plans.frames import lines, scored_lines, side
from intentspark.roles import DEFAULT_ROLES
from intentspark.sources.sinks import scratch_path
from intentspark.streaming.scoring import profile_stream, score_stream

SCHEMA = ("Age int, Gender int, AnnualIncome double, NumberOfPurchases int, ProductCategory int, "
          "TimeSpentOnWebsite double, LoyaltyProgram int, DiscountsAvailed int")
ROWS = [(18, 0, 20000.0, 0, 0, 1.0, 0, 0), (44, 1, 85000.0, 10, 2, 30.0, 1, 3), (70, 0, 150000.0, 20, 4, 60.0, 1, 5)]
# stub scorer: three rules of thumb
STUB = ExpressionScorer("0.15 + 0.35 * LoyaltyProgram + 0.01 * NumberOfPurchases + 0.004 * TimeSpentOnWebsite")


@pytest.fixture(scope="module")
def rules(spark):
    return contract.learn_rules(spark.createDataFrame(ROWS, SCHEMA))


def test_rules(spark, rules):
    by = {r.column: r for r in rules}
    assert (by["Age"].low, by["Age"].high, by["Age"].example) == (18, 70, 44)
    assert by["ProductCategory"].allowed == (0, 2, 4)
    with pytest.raises(ContractError):
        contract.learn_rules(spark.createDataFrame([(None,) * 8], SCHEMA))


def test_violations_name_every_failing_field(spark, rules):
    raw = spark.createDataFrame(
        [("99", "0", "50000", "3", "2", "10", "1", "0"), ("30", " ", "x", "2.5", "3", "inf", "1", None), ("30", "0", "50000", "3", "2", "10", "1", "0")],
        ", ".join(f"{c} string" for c in INPUTS))
    rows = [r["violations"] for r in contract.check_rows(raw, rules).collect()]
    assert rows[0] == ["Age:out_of_range"] and rows[2] == []
    assert rows[1] == ["Gender:blank", "AnnualIncome:not_numeric", "NumberOfPurchases:not_integer", "ProductCategory:not_allowed",
                       "TimeSpentOnWebsite:not_finite", "DiscountsAvailed:blank"]
    valid, rejected = contract.split_valid(raw, rules)
    assert valid.count() == 1 and rejected.count() == 2
    assert valid.schema["Age"].dataType.simpleString() == "int"


def test_schema_level_violations(spark, rules):
    df = spark.createDataFrame(ROWS, SCHEMA)
    missing = contract.check_rows(df.drop("Age"), rules).first()["violations"]
    assert missing == ["Age:missing"]
    extra = contract.check_rows(df.withColumn("Note", F.lit("x")), rules).first()["violations"]
    assert extra == ["Note:unexpected"]
    nested = contract.check_rows(df.withColumn("Age", F.array("Age")), rules).first()["violations"]
    assert nested == ["Age:not_scalar"]


def test_every_row_passes_or_fails_each_change_as_it_must(spark, rules):
    rows = contract.mutation_matrix(spark.createDataFrame(ROWS, SCHEMA), rules).collect()
    assert {r["status"] for r in rows} == {"passed"} and {r["column_name"] for r in rows} == {r.column for r in rules}
    assert {r["accepted_rows"] + r["refused_rows"] for r in rows} == {len(ROWS)}
    assert {r["expected_valid"] for r in rows} == {True, False}


def test_a_rule_that_is_too_wide_fails_the_matrix(spark, rules):
    loose = [replace(r, high=r.high + 10) if r.column == "Age" else r for r in rules]
    checked = contract.check_rows(contract.mutate(spark.createDataFrame(ROWS, SCHEMA), rules), loose, ("mutation", "column_name", "expected_valid"))
    assert checked.where("mutation = 'above_range' and column_name = 'Age' and size(violations) = 0").count() == len(ROWS)


def test_the_matrix_counts_every_changed_row_without_repeating_rows(spark):
    """Also where a row that keeps the contract breaks it as text: incomes are rounded to 6 decimals, below the lower bound."""
    rules = [contract.Rule("Age", "integer_range", 18.0, 70.0), contract.Rule("AnnualIncome", "float_range", 1.0000003, 5.0),
             contract.Rule("Gender", "categorical_integer", allowed=(0, 1))]
    df = spark.createDataFrame([(20 + i, 1.0000004 if i % 3 == 0 else 1.0 + i, i % 2) for i in range(4)] + [(None, 2.0, 1), (99, 2.0, 0), (30, 2.0, 1)],
                               "Age int, AnnualIncome double, Gender int")
    valid, _ = contract.split_valid(df, rules)
    accepted = F.size("violations") == 0
    want = contract.check_rows(contract.mutate(valid, rules), rules, ("mutation", "column_name", "expected_valid")).groupBy(
        "mutation", "column_name", "expected_valid").agg(
        F.count_if(accepted).alias("accepted_rows"), F.count_if(~accepted).alias("refused_rows"),
        F.when(F.count_if(accepted != F.col("expected_valid")) == 0, "passed").otherwise("failed").alias("status"))
    got = contract.mutation_matrix(df, rules)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and {r["status"] for r in got.collect()} == {"passed", "failed"}
    plan = contract.mutation_matrix(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate"), "mutations are listed over the counts, not over the rows"
    assert contract.mutation_matrix(df.limit(0), rules).isEmpty()


def test_reruns_exchange_the_rows_once(spark, sf):
    plan = whatif.rerun_consistency(lines(spark, sf), Scorecard())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("REPARTITION_BY_COL")


def test_variants_are_bounded_unique_and_real(spark, rules):
    valid = spark.createDataFrame([(f"r{i}", *r) for i, r in enumerate(ROWS)], f"row_id string, {SCHEMA}")
    variants = whatif.sensitivity_variants(valid, rules, STUB)
    rows = variants.collect()
    assert len({(r["row_id"], r["variant_id"]) for r in rows}) == len(rows)
    got = {}
    for r in rows:
        got.setdefault(r["row_id"], set()).add(r["variant_id"])
    # the row at the lower end cannot go down, the row at the upper end cannot go up
    assert got["r0"] == {"time_spent_up", "purchase_count_up", "income_up", "loyalty_toggle"}
    assert got["r1"] == {v for v, _, _ in whatif.perturbations(rules)}
    assert got["r2"] == {"time_spent_down", "purchase_count_down", "income_down", "loyalty_toggle"}
    summary = {r["row_id"]: r for r in whatif.sensitivity_summary(variants).collect()}
    assert summary["r1"]["max_probability_delta"] == 0.35
    assert {k: r["variant_count"] for k, r in summary.items()} == {k: len(v) for k, v in got.items()}
    assert "Exchange" not in variants._jdf.queryExecution().executedPlan().toString()


class General:
    """A scorer without its form over arrays."""

    def __init__(self, scorer):
        self.score = scorer.score


def test_changes_in_arrays_equal_the_exploded_variants(spark):
    """Also on rows with NULL, NaN and infinite values, histories that are refused, repeated rows and repeated or NULL keys."""
    rules = contract.learn_rules(spark.createDataFrame(ROWS, SCHEMA))
    rows = [(None if i % 59 == 0 else f"r{i % 390}", None if i % 61 == 0 else 18 + i % 53, i % 2, None if i % 67 == 0 else 20000.0 + 331.37 * (i % 397),
             None if i % 71 == 0 else i % 21, i % 5, None if i % 73 == 0 else float("nan") if i % 79 == 0 else float("inf") if i % 83 == 0 else 1.0 + i % 60,
             None if i % 89 == 0 else i % 2, None if i % 97 == 0 else -1 if i % 101 == 0 else i % 6) for i in range(1_200)]
    frame = spark.createDataFrame(rows, f"row_id string, {SCHEMA}")
    frame = frame.unionByName(frame.limit(50))
    for scorer in (Scorecard(), RuleScorer(10.0, 25.0)):
        variants = whatif.sensitivity_variants(frame, rules, scorer)
        for fast, plain in ((whatif.row_sensitivity(frame, rules, scorer), whatif.sensitivity_summary(variants)),
                            (whatif.variant_totals(frame, rules, scorer), whatif.variant_totals(frame, rules, General(scorer)))):
            assert "MapInArrow" in fast._jdf.queryExecution().executedPlan().toString()
            assert "Generate" not in fast._jdf.queryExecution().executedPlan().toString()
            assert fast.dtypes == plain.dtypes
            text = lambda df: sorted(map(repr, df.collect()))
            assert text(fast) == text(plain)
    plain = whatif.row_sensitivity(frame, rules, STUB)
    assert "MapInArrow" not in plain._jdf.queryExecution().executedPlan().toString()
    assert whatif.row_sensitivity(frame.limit(0), rules, Scorecard()).isEmpty() and whatif.variant_totals(frame.limit(0), rules, Scorecard()).isEmpty()


def test_array_rounding_equals_round(spark):
    values = [0.0, -0.0, 0.0000005, -0.0000005, 0.1234565, 1.0000005, -2.5e-7, 149999.1234565, 123456789.1234565, 1e15, 1e300, float("inf"), float("nan"),
              *[i / 7919 for i in range(-3000, 7919)], *[i / 2e6 for i in range(999)], *[i * 0.37 + 2.45 for i in range(999)]]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").coalesce(1).select(F.round("x", 6)).collect()]
    assert list(map(repr, whatif.rounded(np.array(values)).tolist())) == list(map(repr, want))


def test_reruns_are_deterministic(spark, sf):
    row = whatif.rerun_consistency(lines(spark, sf), Scorecard()).first()
    assert row["deterministic"] and row["compared_rows"] == 2 * lines(spark, sf).count()


def test_reference_cases(spark, sf):
    rows = cases.reference_cases(side(scored_lines(spark, sf), "test")).collect()
    assert len(rows) == 8 == len({r["row_id"] for r in rows})
    assert "boundary_case" in {r["case_id"] for r in rows}


def test_case_union_rejects_repeated_ids(spark, sf):
    picked = cases.reference_cases(side(scored_lines(spark, sf), "test"))
    assert cases.case_union({"test": picked, "again": picked}).count() == 16
    with pytest.raises(ContractError):
        cases.case_union({"test": picked.unionByName(picked)})


def test_shapley_adds_up_for_every_row(spark, sf):
    frame = lines(spark, sf)
    test = side(frame, "test")
    every = explain.attributions(explain.explained_rows(test), explain.background_sample(frame.where("split <> 'test'")), Scorecard())
    total = explain.shapley_values(every).groupBy("row_id").agg(F.sum("phi").alias("s"), F.max("base_value").alias("b"), F.count("phi").alias("n"))
    rows = Scorecard().score(test).join(total, "row_id").collect()
    assert len(rows) == test.count() and all(r["n"] == 7 for r in rows)
    assert all(r["p"] == pytest.approx(r["b"] + r["s"], abs=1e-5) for r in rows)
    assert explain.top_contributions(every, 3).count() == 3 * len(rows)
    some = explain.attributions(explain.explained_rows(test, 5), explain.background_sample(frame), Scorecard())
    assert some.count() == 5


def test_a_row_that_cannot_be_scored_has_no_values(spark, sf):
    frame = lines(spark, sf)
    rows = explain.explained_rows(side(frame, "test"), 4).withColumn("Age", F.when(F.col("Age") > 0, F.lit(None).cast("int")))
    assert explain.shapley_values(explain.attributions(rows, explain.background_sample(frame), Scorecard())).where("phi is not null or base_value is not null").isEmpty()


def test_coalitions_stay_in_their_task(spark, sf):
    frame = lines(spark, sf)
    every = explain.attributions(explain.explained_rows(side(frame, "test")), explain.background_sample(frame), Scorecard())
    plan = every._jdf.queryExecution().sparkPlan().toString()
    executed = every._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    above = executed[: executed.index("Generate")]
    assert "Exchange" not in above and "Broadcast" not in executed


class Plain:
    """A scorer without its array form."""

    def __init__(self, scorer):
        self.score = scorer.score


def test_sums_in_arrays_equal_the_scored_coalitions(spark):
    rows = [(f"r{i % 190}", 18 + i % 53, None if i % 29 == 0 else 900.0 * (i % 97), None if i % 31 == 0 else i % 21, None if i % 23 == 0 else float(i % 50),
             None if i % 37 == 0 else i % 2, None if i % 41 == 0 else i % 5, None if i % 43 == 0 else i % 3 % 2, int(i % 7 < 3)) for i in range(400)]
    frame = spark.createDataFrame(rows, "row_id string, Age int, AnnualIncome double, NumberOfPurchases int, TimeSpentOnWebsite double, "
                                        "Gender int, ProductCategory int, LoyaltyProgram int, PurchaseStatus int")
    frame = frame.unionByName(frame.limit(9))
    explained, background = explain.explained_rows(frame), explain.background_sample(frame.na.drop(), 6)
    for scorer in (Scorecard(), RuleScorer(10.0, 25.0), learners.fit_logistic(frame)):
        fast = explain.attributions(explained, background, scorer)
        assert "MapInArrow" in fast._jdf.queryExecution().executedPlan().toString()
        plain = explain.attributions(explained, background, Plain(scorer))
        assert fast.schema == plain.schema and fast.count() == plain.count()
        assert fast.exceptAll(plain).isEmpty() and plain.exceptAll(fast).isEmpty()
    assert explain.attributions(explained, background.limit(0), Scorecard()).isEmpty()
    whole = frame.na.drop().dropDuplicates(["row_id"])
    for scorer in (Scorecard(), RuleScorer(10.0, 25.0), learners.fit_logistic(frame)):
        fast = explain.permutation_importance(whole, scorer, repeats=2)
        assert "MapInArrow" in fast._jdf.queryExecution().executedPlan().toString()
        assert fast.collect() == explain.permutation_importance(whole, Plain(scorer), repeats=2).collect()


def test_rounded_scores_equal_round(spark):
    values = [0.0, -0.0, 1.0, 0.0000005, 0.1234565, 0.9999995, 0.49999949999999997, 2.5e-7, 0.3, 0.015, None, *[i / 7919 for i in range(7919)], *[i / 2e6 for i in range(999)]]
    both = spark.createDataFrame([(v,) for v in values], "p double").select(rounded_score(F.col("p")).alias("a"), F.round("p", 6).alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()


def test_permutation_needs_the_signal(spark, sf):
    test = side(lines(spark, sf), "test")
    rows = {r["feature_name"]: r for r in explain.permutation_importance(test, Scorecard(), repeats=2).collect()}
    assert set(rows) == set(DEFAULT_ROLES.base_inputs)
    assert max(rows.values(), key=lambda r: r["importance_mean"])["feature_name"] == "LoyaltyProgram"


def test_stream_gives_the_batch_result(spark, sf, tmp_path):
    frame = lines(spark, sf).select("row_id", *INPUTS)
    rules = contract.learn_rules(frame)
    frame.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = profile_stream(spark, str(tmp_path / "in"), frame.schema, max_files=2)
    started = score_stream(stream, rules, Scorecard(), str(tmp_path / "out"), passthrough=("row_id",), checkpoint=str(tmp_path / "ck"))
    for q in started:
        q.awaitTermination(120)
    batch, rejects = contract.batch_score(frame, rules, Scorecard(), passthrough=("row_id",))
    streamed = spark.read.parquet(str(tmp_path / "out" / "decisions"))
    assert streamed.count() == batch.count() == frame.count()
    assert streamed.exceptAll(batch).isEmpty()
    assert rejects.count() == spark.read.schema(rejects.schema).parquet(str(tmp_path / "out" / "rejects")).count() == 0


def test_scratch_folder_of_a_cluster_must_be_shared():
    session = lambda master, folder: SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=SimpleNamespace(master=master))
    assert scratch_path(session("spark://host:7077", "/shared/"), "t").startswith("/shared/t-")
    assert scratch_path(session("local[2]", None), "t").startswith("file://")
    with pytest.raises(SinkError):
        scratch_path(session("spark://host:7077", None), "t")
