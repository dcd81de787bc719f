import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError, SourceError
from intentspark.functions.quantiles import exact_quantiles, quantile_edges
from intentspark.operators import audit, profiling
from intentspark.roles import PROFILE_SCHEMA
from intentspark.sources import contracts, readers, sinks


def test_binary_like_values(spark):
    df = spark.createDataFrame([("0",), ("1.0",), (" 1 ",), ("0.0",), (None,)], "label string")
    assert {r["value"] for r in audit.binary_like_values(df, "label").collect()} == {"0", "1"}


def test_dedup_treats_null_as_equal_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 0)], "Age int, PurchaseStatus int")
    once = audit.deduplicate(df, df.columns)
    assert once.count() == 2
    assert audit.deduplicate(once, df.columns).count() == 2


def test_duplicate_counts_extra_rows_and_all_members(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(2, 0)] * 2 + [(3, 0)], "Age int, PurchaseStatus int")
    row = audit.duplicate_summary(df, df.columns).first()
    assert row["duplicate_row_count"] == 3 and row["duplicate_rate"] == 0.5
    assert row["duplicate_members_label_1"] == 3 and row["duplicate_members_label_0"] == 2


def test_bands_of_five_values(spark):
    df = spark.createDataFrame([(float(x), 0) for x in (10, 20, 30, 40, 50)], "x double, PurchaseStatus int")
    banded, edges = profiling.with_bands(df, ["x"])
    assert edges["x"] == [10.0, 20.0, 30.0, 40.0, 50.0]
    assert [r["x_band"] for r in banded.orderBy("x").collect()] == [0, 0, 1, 2, 3]


def test_bands_cap_quantiles_by_distinct_values(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(5.0,)], "x double")
    assert quantile_edges(df, ["x"])[0]["x"] == [1.0, 5.0]
    single = spark.createDataFrame([(1.0,)] * 3, "x double")
    assert quantile_edges(single, ["x"])[0]["x"] is None


@pytest.mark.parametrize("limit,accuracy", [(10_000, 100), (40, 50), (5, 30)])
def test_exact_quantiles_survive_narrowing(spark, limit, accuracy):
    """Tiny limits force the sketch path; a third of the rows share one value."""
    df = spark.sql(
        "select case when id % 3 = 0 then 500.5 else cast(pmod(xxhash64(id), 100000) as double) / 7 end x, "
        "case when id % 50 = 0 then null else cast(id % 4 as double) end y from range(6000)")
    probs = [0.0, 0.05, 0.25, 0.33, 0.5, 0.9, 1.0]
    want = df.selectExpr(f"percentile(x, array({','.join(map(str, probs))})) x",
                         f"percentile(y, array({','.join(map(str, probs))})) y").first()
    got = exact_quantiles(df, {"x": probs, "y": probs}, direct_distinct=limit, accuracy=accuracy)
    assert got["x"] == pytest.approx(list(want["x"]), abs=1e-9)
    assert got["y"] == pytest.approx(list(want["y"]), abs=1e-9)


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"x": [0.5]}) == {"x": [None]}


def test_go_decision_and_schema(spark):
    rows = [Row(**{c: 1 for c in fixed.PROFILE_COLUMNS[:-1]}, PurchaseStatus=y) for y in (0, 1)]
    df = spark.createDataFrame(rows)
    assert audit.go_decision(df, df.columns).first()["decision"] == "Conditional Go"
    assert audit.go_decision(df.drop("Age"), df.drop("Age").columns).first()["decision"] == "No Go"
    assert audit.go_decision(df.withColumn("Note", F.lit(1)), df.columns).first()["decision"] == "No Go"
    with pytest.raises(ContractError):
        contracts.require_columns(df.drop("Age"), fixed.PROFILE_COLUMNS)
    status = {r["column_name"]: r["status"] for r in contracts.schema_diff(df.withColumnRenamed("Age", "Years"), fixed.PROFILE_COLUMNS).collect()}
    assert status["Age"] == "missing" and status["Years"] == "unexpected" and status["Gender"] == "matched"
    with pytest.raises(ContractError):
        audit.require_binary_target(df.where("PurchaseStatus = 1"))


def test_csv_scan_counts_rejects(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(",".join(PROFILE_SCHEMA.names) + "\n30,1,50000.5,3,2,10.5,1,0,1\nabc,1,NaN,3,2,10.5,1,0,1\n")
    good, bad = readers.split_rejects(readers.scan_profile(spark, str(path)))
    assert good.count() == 1 and bad.count() == 1 and good.select("Gender").collect() == [Row(Gender=1)]
    with pytest.raises(SourceError):
        readers.scan_profile(spark, str(tmp_path / "absent.csv")).count()


def test_stage_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "x int, split string")
    sinks.write_splits(df, str(tmp_path / "stage"))
    assert sinks.read_stage(spark, str(tmp_path), "stage").count() == 2
    assert sinks.read_stage(spark, str(tmp_path), "nothing") is None
    with pytest.raises(SourceError):
        sinks.read_stage(spark, str(tmp_path), "nothing", required=True)
    with pytest.raises(SourceError):
        sinks.load_model(str(tmp_path / "no_model"))
    sinks.write_json_summary(df, str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json")).count() == 2
