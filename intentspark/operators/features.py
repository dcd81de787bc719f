"""Feature engineering and design matrices: fitted on training rows, applied as plain column expressions."""

from __future__ import annotations

import json
from functools import partial

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentspark.errors import ContractError
from intentspark.functions.quantiles import band_index, exact_quantiles, quantile_edges
from intentspark.functions.scalars import lenient_double
from intentspark.operators.audit import unpivot_aggregates
from intentspark.roles import DEFAULT_ROLES, RoleSpec
from intentspark.sources.contracts import require_columns

MAX_LEVELS = 10_000
BUCKETS = (
    ("income_bucket", "AnnualIncome", "income"),
    ("purchase_frequency_bucket", "NumberOfPurchases", "purchase_frequency"),
    ("time_spent_bucket", "TimeSpentOnWebsite", "time_spent"),
)


class _Fitted(Params):
    """Learned state as one JSON parameter, which makes the stage persistable with the pipeline."""

    state = Param(Params._dummy(), "state", "learned values as JSON", TypeConverters.toString)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _keep(self, learned: dict):
        self._set(state=json.dumps(learned))
        return self


class FeatureBuilder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns quantile edges and two cut-offs from training rows only."""

    def _fit(self, df: DataFrame) -> "FeatureModel":
        require_columns(df, DEFAULT_ROLES.base_inputs)
        columns = [c for _, c, _ in BUCKETS]
        numeric = df.select([lenient_double(c).alias(c) for c in columns])
        edges, cuts = quantile_edges(numeric, columns, also={"TimeSpentOnWebsite": [0.75], "NumberOfPurchases": [0.25]})
        return FeatureModel()._keep({
            "edges": edges, "high_time": cuts["TimeSpentOnWebsite"][0], "low_history": cuts["NumberOfPurchases"][0]})


class FeatureModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, DEFAULT_ROLES.base_inputs)
        learned = self.learned()
        purchases = F.coalesce(lenient_double("NumberOfPurchases"), F.lit(0.0))
        loyalty = F.coalesce(lenient_double("LoyaltyProgram"), F.lit(0.0))
        income, time = lenient_double("AnnualIncome"), lenient_double("TimeSpentOnWebsite")
        long_visit = F.coalesce(time >= F.lit(learned["high_time"]), F.lit(False))
        flag = lambda condition: F.when(condition, 1).otherwise(0)
        for name, column, prefix in BUCKETS:
            df = df.withColumn(name, bucket_label(lenient_double(column), learned["edges"][column], prefix))
        return (
            df.withColumn("income_per_purchase_proxy", income / (purchases + 1.0))
            .withColumn("loyalty_time_interaction", loyalty * time)
            .withColumn("high_time_low_history_flag", flag(long_visit & (purchases <= F.lit(learned["low_history"]))))
            .withColumn("non_loyal_high_time_flag", flag((loyalty == 0) & long_visit))
            .withColumn("category_income_interaction", F.concat(
                F.coalesce(F.col("ProductCategory").cast("string"), F.lit("nan")), F.lit("__"), F.col("income_bucket")))
        )

    def edge_table(self, spark: SparkSession) -> DataFrame:
        """Interior edges per bucket column; the outer ones are open."""
        rows = []
        for name, column, _ in BUCKETS:
            for i, edge in enumerate((self.learned()["edges"][column] or [])[1:-1], start=1):
                rows.append((name, i, edge))
        return spark.createDataFrame(rows, "bucket string, edge_index int, edge double").withColumn(
            "edge", F.round("edge", 6))


def bucket_label(value: Column, edges: list[float] | None, prefix: str) -> Column:
    if edges is None:
        return F.lit(f"{prefix}_single_band")
    return F.when(value.isNull(), f"{prefix}_unknown").otherwise(
        F.concat(F.lit(f"{prefix}_q"), (band_index(value, edges) + 1).cast("string")))


def _level_order(levels: list[str]) -> list[str]:
    """Numeric codes in numeric order, text in text order."""
    try:
        return sorted(levels, key=float)
    except ValueError:
        return sorted(levels)


class MatrixBuilder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, means, population deviations, modes and category levels of engineered rows.

    ``branch`` is "linear" (impute, standardise, one-hot) or "tree" (impute, ordinal codes).
    """

    branch = Param(Params._dummy(), "branch", "linear or tree", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, branch: str = "linear"):
        super().__init__()
        self._setDefault(branch="linear")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MatrixModel":
        roles = DEFAULT_ROLES
        numeric = df.select([lenient_double(c).alias(c) for c in roles.matrix_numeric])
        medians = {c: v[0] for c, v in exact_quantiles(numeric, {c: [0.5] for c in roles.matrix_numeric}).items()}
        empty = sorted(c for c, v in medians.items() if v is None)
        if empty:
            raise ContractError(f"no value to impute from in {', '.join(empty)}")
        filled = numeric.select([F.coalesce(F.col(c), F.lit(medians[c])).alias(c) for c in roles.matrix_numeric])
        row = filled.agg(*[f(c).alias(f"{n}_{c}") for c in roles.matrix_numeric
                           for n, f in (("avg", F.avg), ("std", F.stddev_pop))]).first()
        modes, levels = category_levels(df, roles)
        return MatrixModel()._keep({
            "branch": self.getOrDefault(self.branch), "medians": medians,
            "means": {c: row[f"avg_{c}"] for c in medians},
            "stds": {c: row[f"std_{c}"] or 1.0 for c in medians},
            "modes": modes, "levels": levels,
        })


def category_levels(df: DataFrame, roles: RoleSpec = DEFAULT_ROLES) -> tuple[dict, dict]:
    """Most frequent value (smallest on a tie) and sorted levels of each category column.

    Counts are combined map-side; only the level lists reach the driver and their number is checked.
    """
    names = roles.matrix_categorical
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in names]))
    counts = (
        df.select(pairs.alias("e")).select("e.*").where(F.col("v").isNotNull())
        .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        .limit(MAX_LEVELS + 1).collect()
    )
    if len(counts) > MAX_LEVELS:
        raise ContractError("too many category levels for an encoded matrix")
    modes, levels = {}, {}
    for c in names:
        found = {r["v"]: r["n"] for r in counts if r["c"] == c}
        if not found:
            raise ContractError(f"no category level in {c}")
        levels[c] = _level_order(list(found))
        modes[c] = max(levels[c], key=lambda v: (found[v], -levels[c].index(v)))
    return modes, levels


class MatrixModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def numeric_values(self) -> dict[str, Column]:
        """Imputed numerics; standardised on the linear branch."""
        s = self.learned()
        filled = {c: F.coalesce(lenient_double(c), F.lit(s["medians"][c])) for c in DEFAULT_ROLES.matrix_numeric}
        if s["branch"] == "tree":
            return filled
        return {c: (v - F.lit(s["means"][c])) / F.lit(s["stds"][c]) for c, v in filled.items()}

    def category_values(self) -> dict[str, Column]:
        modes = self.learned()["modes"]
        return {c: F.coalesce(F.col(c).cast("string"), F.lit(modes[c])) for c in DEFAULT_ROLES.matrix_categorical}

    def category_codes(self) -> dict[str, Column]:
        """Position among the sorted levels, -1 for a level never seen in training."""
        levels = self.learned()["levels"]
        return {
            c: (F.array_position(F.array(*[F.lit(x) for x in levels[c]]), v) - 1).cast("double")
            for c, v in self.category_values().items()}

    def columns(self) -> dict[str, Column]:
        """Name -> expression of every matrix column, in matrix order."""
        out = dict(self.numeric_values())
        s = self.learned()
        if s["branch"] == "tree":
            return {**out, **self.category_codes()}
        for c, v in self.category_values().items():
            for level in s["levels"][c]:
                out[f"{c}_{level}"] = F.when(v == level, 1.0).otherwise(0.0)
        return out

    def names(self) -> list[str]:
        return list(self.columns())

    def _transform(self, df: DataFrame) -> DataFrame:
        # the plain array carries no nominal metadata, so trees split codes as numbers
        return df.withColumn("features", array_to_vector(F.array(*self.columns().values())))


def additive_parts(built: dict, matrix: MatrixModel, coefficients: np.ndarray) -> tuple:
    """The linear matrix times its coefficients, as parts (columns, function of their arrays); NULL is NaN, whole codes."""
    s = matrix.learned()
    weight = dict(zip(matrix.names(), coefficients.tolist(), strict=True))
    numeric = lambda name, x: (np.where(np.isnan(x), s["medians"][name], x) - s["means"][name]) / s["stds"][name] * weight[name]

    def looked_up(column: str, levels: list[str], index: np.ndarray) -> np.ndarray:
        return np.array([weight.get(f"{column}_{v}", 0.0) for v in levels])[index]

    def code(column: str, x: np.ndarray) -> np.ndarray:
        known = s["levels"][column]
        values = np.array([float(v) for v in known])
        order = np.argsort(values)
        x = np.where(np.isnan(x), float(s["modes"][column]), x)
        at = np.clip(np.searchsorted(values, x, sorter=order), 0, len(known) - 1)
        weights = np.array([weight[f"{column}_{v}"] for v in known])
        return np.where(values[order[at]] == x, weights[order[at]], 0.0)

    def band(column: str, prefix: str, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Labels as `bucket_label` gives them, and each value's place among them."""
        edges = built["edges"][column]
        if edges is None:
            return [f"{prefix}_single_band"], np.zeros(x.shape, np.int64)
        labels = [*[f"{prefix}_q{i + 1}" for i in range(max(1, len(edges) - 1))], f"{prefix}_unknown"]
        return labels, np.where(np.isnan(x), len(labels) - 1, np.searchsorted(edges[1:-1], x, side="left"))

    def crossed(category: np.ndarray, income: np.ndarray) -> np.ndarray:
        labels, at = band("AnnualIncome", "income", income)
        codes, place = np.unique(category, return_inverse=True)
        names = ["nan" if np.isnan(c) else str(int(c)) for c in codes]
        grid = np.array([[weight.get(f"category_income_interaction_{c}__{label}", 0.0) for label in labels] for c in names])
        return grid[place.reshape(category.shape), at]

    long_visit = lambda time: time >= built["high_time"] if built["high_time"] is not None else np.zeros(time.shape, bool)
    flag = lambda name, condition: numeric(name, np.where(condition, 1.0, 0.0))
    few = lambda k: np.nan_to_num(k) <= built["low_history"] if built["low_history"] is not None else np.zeros(k.shape, bool)
    return (
        *[((c,), partial(numeric, c)) for c in DEFAULT_ROLES.numeric],
        *[((c,), partial(code, c)) for c in DEFAULT_ROLES.categorical],
        *[((c,), lambda x, n=name, c=c, p=prefix: looked_up(n, *band(c, p, x))) for name, c, prefix in BUCKETS],
        (("AnnualIncome", "NumberOfPurchases"), lambda i, k: numeric("income_per_purchase_proxy", i / (np.nan_to_num(k) + 1.0))),
        (("LoyaltyProgram", "TimeSpentOnWebsite"), lambda l, t: numeric("loyalty_time_interaction", np.nan_to_num(l) * t)
            + flag("non_loyal_high_time_flag", (np.nan_to_num(l) == 0) & long_visit(t))),
        (("TimeSpentOnWebsite", "NumberOfPurchases"), lambda t, k: flag("high_time_low_history_flag", long_visit(t) & few(k))),
        (("ProductCategory", "AnnualIncome"), crossed),
    )


def matrix_checks(model: MatrixModel, frames: dict[str, DataFrame]) -> DataFrame:
    """Per frame: rows, matrix width and NULL cells (which must be zero)."""
    out = None
    for name, df in frames.items():
        values = F.array(*model.columns().values())
        one = df.select(values.alias("v")).agg(
            F.lit(name).alias("frame_name"), F.count(F.lit(1)).alias("row_count"),
            F.max(F.size("v")).alias("feature_count"),
            F.sum(F.size(F.filter("v", lambda x: x.isNull()))).alias("null_cells"))
        out = one if out is None else out.unionByName(one)
    return out


def imputed(model: MatrixModel, df: DataFrame, key: str = "row_id") -> DataFrame:
    """Imputed base columns next to the key."""
    s = model.learned()
    numeric = [F.coalesce(lenient_double(c), F.lit(s["medians"][c])).alias(c) for c in DEFAULT_ROLES.numeric]
    coded = [model.category_values()[c].alias(c) for c in DEFAULT_ROLES.categorical]
    return df.select(key, *numeric, *coded)


def standardised_summary(model: MatrixModel, df: DataFrame) -> DataFrame:
    """Mean and population deviation of the standardised numerics."""
    values = model.numeric_values()
    frame = df.select([v.alias(c) for c, v in values.items()])
    return unpivot_aggregates(frame, list(values), "column_name", {
        "row_count": F.count,
        "mean_value": lambda c: F.round(F.avg(c) + F.lit(0.0), 6) + F.lit(0.0),
        "std_value": lambda c: F.round(F.stddev_pop(c), 6),
    })


def one_hot_counts(model: MatrixModel, df: DataFrame) -> DataFrame:
    """Rows per one-hot level, unknown levels counted as such."""
    levels = model.learned()["levels"]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.when(
            v.isin(*levels[c]), v).otherwise("(unknown)").alias("level"))
        for c, v in model.category_values().items()]))
    return df.select(pairs.alias("e")).select("e.*").groupBy("column_name", "level").agg(
        F.count(F.lit(1)).alias("row_count"))
