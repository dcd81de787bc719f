import numpy as np
import pytest
from pyspark.sql import functions as F

from intentspark.errors import ContractError
from intentspark.operators import features, learners, resampling, tuning
from intentspark.operators.metrics import evaluate
from intentspark.plans.frames import lines, side
from intentspark.sources import sinks

BASE = "Age int, AnnualIncome double, NumberOfPurchases int, TimeSpentOnWebsite double, Gender int, ProductCategory int, LoyaltyProgram int"


@pytest.fixture(scope="module")
def split(spark, sf):
    frame = lines(spark, sf)
    return frame.where("split <> 'test'"), side(frame, "test")


def test_engineered_columns(spark):
    df = spark.createDataFrame(
        [(20, 100.0, 1, 5.0, 0, 0, 0), (30, 200.0, 2, 10.0, 1, 1, 1), (40, 300.0, 3, 20.0, 0, 2, 0), (50, 400.0, 4, 40.0, 1, 3, 1)], BASE)
    out = features.FeatureBuilder().fit(df).transform(df)
    rows = out.orderBy("Age").collect()
    assert [r["income_bucket"] for r in rows] == ["income_q1", "income_q2", "income_q3", "income_q4"]
    assert {r["high_time_low_history_flag"] for r in rows} <= {0, 1}
    assert rows[0]["category_income_interaction"] == "0__income_q1" and rows[0]["income_per_purchase_proxy"] == 50.0
    unseen = spark.createDataFrame([(20, None, 1, None, 0, 9, 0)], BASE)
    row = features.FeatureBuilder().fit(df).transform(unseen).first()
    assert row["income_bucket"] == "income_unknown" and row["non_loyal_high_time_flag"] == 0
    with pytest.raises(ContractError):
        features.FeatureBuilder().fit(df.drop("Age"))


def test_matrices(spark, split):
    train, test = split
    engineered = features.FeatureBuilder().fit(train)
    linear = features.MatrixBuilder(branch="linear").fit(engineered.transform(train))
    tree = features.MatrixBuilder(branch="tree").fit(engineered.transform(train))
    checks = {r["frame_name"]: r for r in features.matrix_checks(linear, {"a": engineered.transform(train), "b": engineered.transform(test)}).collect()}
    assert checks["a"]["null_cells"] == checks["b"]["null_cells"] == 0
    assert checks["a"]["feature_count"] == checks["b"]["feature_count"] == len(linear.names())
    odd = engineered.transform(test).withColumn("ProductCategory", F.lit(77))
    assert odd.select(tree.category_codes()["ProductCategory"].alias("c")).first()["c"] == -1
    hot = [c for n, c in linear.columns().items() if n.startswith("ProductCategory_")]
    assert odd.select(sum(hot[1:], hot[0]).alias("s")).first()["s"] == 0


def test_training_rows_reach_all_tasks_in_one_order(split):
    """A table that scans as one split is still fitted and measured by all tasks, and in the same order on every run."""
    train = split[0].coalesce(1)
    order = []
    for rows in (train, train.orderBy("Age")):
        _, vectors = learners.matrix(rows, "tree")
        assert vectors.rdd.getNumPartitions() == int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order.append([r["row_id"] for r in vectors.select("row_id").collect()])
    assert order[0] == order[1] and len(order[0]) == train.count()


def test_logistic_beats_chance_and_persists(spark, split, tmp_path):
    train, test = split
    scorer = learners.fit_logistic(train)
    row = evaluate(scorer.score(test)).first()
    assert row["roc_auc"] > 0.85
    sinks.save_model(scorer.model, str(tmp_path / "m"))
    again = learners.ModelScorer(sinks.load_model(str(tmp_path / "m")))
    assert evaluate(again.score(test)).first() == row


def test_calibration_does_not_hurt(split):
    train, test = split
    estimator = learners.forest({"trees": 5, "depth": 4, "leaf": 6, "features": "sqrt"})
    plain = evaluate(learners.fit(train, "tree", estimator).score(test)).first()
    calibrated = evaluate(learners.fit_calibrated(train, "tree", estimator).score(test)).first()
    assert calibrated["brier_score"] <= plain["brier_score"] + 0.01 and calibrated["roc_auc"] > 0.8


def test_neighbours_match_brute_force(spark):
    """A third of the points are copies of one vector; another part lies on a lattice full of ties."""
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(300, 3)), np.repeat([[0.5, 0.5, 0.5]], 200, axis=0), rng.integers(0, 3, size=(100, 3)).astype(float)])
    ids = [f"r{i:04d}" for i in range(len(x))]
    points = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in zip(ids, x)], "id string, v array<double>")
    got = {}
    for r in resampling.nearest_neighbours(points, points, 5, block_rows=64, seed_rows=50).collect():
        got.setdefault(r["seed_id"], {})[r["position"]] = r["neighbour_id"]
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    for i, name in enumerate(ids):
        want = [n for _, n in sorted((d[i, j], ids[j]) for j in range(len(x)) if j != i)[:5]]
        assert [got[name][k] for k in range(1, 6)] == want


def test_smote_reaches_parity_inside_the_hull(spark):
    rows = [(f"n{i}", [float(i), 0.0], 0) for i in range(30)] + [(f"p{i}", [float(i), 10.0 + i], 1) for i in range(8)]
    df = spark.createDataFrame(rows, "row_id string, v array<double>, PurchaseStatus int")
    out = resampling.smote(df).collect()
    made = [r for r in out if r["synthetic"]]
    assert len(out) == 60 and len(made) == 22 and len({r["id"] for r in made}) == 22
    assert all(0 <= r["v"][0] <= 7 and abs(r["v"][1] - r["v"][0] - 10) < 1e-9 and r["label"] == 1 for r in made)
    with pytest.raises(ContractError):
        resampling.neighbour_count(1)


def test_mixed_smote_keeps_real_categories(spark):
    rows = [(f"n{i}", float(i), 3.0, 0) for i in range(20)] + [(f"p{i}", float(i), float(i % 2), 1) for i in range(6)]
    df = spark.createDataFrame(rows, "row_id string, x double, c double, PurchaseStatus int")
    made = resampling.smote_mixed(df, ["x"], ["c"]).where("synthetic").collect()
    assert len(made) == 14 and {r["c"] for r in made} <= {0.0, 1.0} and all(0 <= r["x"] <= 5 for r in made)


def test_failed_candidate_is_recorded(split, monkeypatch):
    train, test = split
    grid = ({"trees": 3, "depth": 3, "leaf": 5, "features": "sqrt"}, {"trees": 3, "depth": 3, "leaf": 5, "features": "nonsense"})
    monkeypatch.setattr(learners, "family_grid", lambda family: grid)
    outcome = tuning.tune_family("random_forest", train, test)
    assert [bool(h["error"]) for h in outcome.history[:2]] == [False, True] and outcome.best == grid[0]
    assert tuning.history_table(train.sparkSession, [outcome]).count() >= 2


SMALL = {"random_forest": ({"trees": 3, "depth": 3, "leaf": 5, "features": "sqrt"}, {"trees": 4, "depth": 4, "leaf": 5, "features": "sqrt"}),
         "gradient_boosting": ({"rounds": 2, "rate": 0.1, "depth": 2, "leaf": 5},)}


def test_an_ended_run_goes_on_with_what_is_absent(spark, split, tmp_path, monkeypatch):
    """The first run dies after one candidate; the next fits the rest, the one after that nothing."""
    train, test = split
    monkeypatch.setattr(learners, "family_grid", lambda family: SMALL[family])
    store = tuning.FitStore(spark, str(tmp_path), train, test)
    fits, put = [], tuning.FitStore.put

    def dies(self, key, model, facts):
        if fits:
            raise RuntimeError("driver lost")
        fits.append(key)
        put(self, key, model, facts)

    monkeypatch.setattr(tuning, "PARALLEL_FITS", 1)
    monkeypatch.setattr(tuning.FitStore, "put", dies)
    with pytest.raises(RuntimeError):
        tuning.tune_family("random_forest", train, test, store)
    monkeypatch.setattr(tuning.FitStore, "put", lambda self, key, model, facts: (fits.append(key), put(self, key, model, facts)))
    outcome = tuning.tune_family("random_forest", train, test, tuning.FitStore(spark, str(tmp_path), train, test))
    assert len(fits) == len(set(fits)) == 2 + 3  # both candidates and three folds, each once
    again = tuning.tune_family("random_forest", train, test, store)
    assert len(fits) == 5 and again.history == outcome.history and again.variant == outcome.variant
    assert again.scorer.score(test).select("row_id", "p").exceptAll(outcome.scorer.score(test).select("row_id", "p")).isEmpty()
    assert tuning.FitStore(spark, str(tmp_path), test, train).key("random_forest") != store.key("random_forest")


def test_champion_is_fitted_anew_for_the_outer_test(split, monkeypatch):
    train, test = split
    monkeypatch.setattr(learners, "family_grid", lambda family: SMALL[family][:1])
    inner, validation = train.where("abs(hash(row_id)) % 4 > 0"), train.where("abs(hash(row_id)) % 4 = 0")
    scorers, table = tuning.champion_run(("random_forest", "gradient_boosting"), inner, validation, test)
    rows = {r["role"]: r for r in table.collect()}
    assert set(rows) == set(scorers) == {"champion", "challenger"} and {r["model_name"] for r in rows.values()} == set(SMALL)
    assert all(r["row_count"] == test.count() for r in rows.values())
    assert evaluate(scorers["champion"].score(test)).first()["pr_auc"] == rows["champion"]["pr_auc"]


def test_neighbours_of_far_apart_groups_meet_few_points(spark, monkeypatch):
    """Seeds measure exactly little more than their neighbours, and the result is that of brute force also far from the origin."""
    measured, exact = spark.sparkContext.accumulator(0), resampling._exact

    def counted(x, y):
        measured.add(len(x))
        return exact(x, y)

    rng = np.random.default_rng(5)
    x = np.vstack([c + rng.normal(size=(150, 4)) for c in ([0, 0, 0, 0], [1e4, 0, 0, 0], [0, 1e4, 0, 1e4])])
    ids = [f"r{i:04d}" for i in range(len(x))]
    points = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in zip(ids, x)], "id string, v array<double>")
    got = {}
    for r in resampling.nearest_neighbours(points, points, 4, block_rows=40, seed_rows=60).collect():
        got.setdefault(r["seed_id"], {})[r["position"]] = r["neighbour_id"]
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    for i, name in enumerate(ids):
        assert [got[name][p] for p in range(1, 5)] == [n for _, n in sorted((d[i, j], ids[j]) for j in range(len(x)) if j != i)[:4]]
    rows, cols, _ = resampling._near(x, x, np.full(len(x), np.inf), 4)
    assert len(rows) == 5 * len(x)
    monkeypatch.setattr(resampling, "_exact", counted)
    resampling._near(x, x, np.full(len(x), np.inf), 4)
    assert measured.value < 6 * len(x)


def test_logistic_fit_keeps_no_matrix_of_its_own(split, monkeypatch):
    """Only the narrow training columns are kept next to the learner's blocks, and the model is that of the kept matrix."""
    train, test = split
    kept, keep = [], learners.keep
    monkeypatch.setattr(learners, "keep", lambda df: (kept.append(df.columns), keep(df))[1])
    rows = float(train.count())
    scorer = learners.fit(train, "linear", learners.logistic(rows))
    assert kept and not any("features" in columns for columns in kept)
    prepared, vectors = learners.matrix(train, "linear")
    other = learners.logistic(rows).fit(vectors)
    vectors.unpersist()
    assert np.allclose(scorer.model.stages[2].coefficients.toArray(), other.coefficients.toArray(), rtol=0, atol=1e-9)
