"""Deterministic scorers: prior, random draw, rule baseline, hand-set scorecard.

A scorer turns a frame into the same frame plus ``p`` (probability, 6 decimals) and ``yhat``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentspark import fixed
from intentspark.errors import ContractError
from intentspark.functions.quantiles import exact_quantiles
from intentspark.functions.scalars import clip, lenient_double, min_max, sigmoid, unit_draw
from intentspark.sources.contracts import require_columns


class Scorer(Protocol):
    def score(self, df: DataFrame) -> DataFrame: ...


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
WHOLE_NUMBERS = NUMBERS[:4]


@dataclass(frozen=True)
class Additive:
    """The same score over arrays: a curve over a start plus parts, added in order, each a function of a few columns.

    NULL arrives as NaN. A row with NULL in one of `needs` has no score."""

    start: float
    parts: tuple[tuple[tuple[str, ...], Callable[..., np.ndarray]], ...]
    curve: Callable[[np.ndarray], np.ndarray]
    needs: tuple[str, ...] = ()


def are_numbers(columns: tuple[str, ...], *frames: dict[str, str], kinds: tuple[str, ...] = NUMBERS) -> bool:
    """Whether each frame, a dict of column types, has numbers in all the columns."""
    return all(types.get(c, "").split("(")[0] in kinds for types in frames for c in columns)


def logistic_curve(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


@dataclass(frozen=True)
class PriorScorer:
    """Training prior for everyone; label is the majority class."""

    prior: float

    @classmethod
    def fit(cls, df: DataFrame, target: str = fixed.TARGET) -> "PriorScorer":
        return cls(df.agg(F.avg(target)).first()[0])

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("p", F.round(F.lit(self.prior), 6)).withColumn("yhat", F.lit(int(self.prior > 0.5)))


@dataclass(frozen=True)
class RandomScorer:
    """A label drawn at the training rate; the probability is the draw itself (0 or 1)."""

    prior: float
    key: str = "row_id"
    seed: int = fixed.SEED

    @classmethod
    def fit(cls, df: DataFrame, target: str = fixed.TARGET, key: str = "row_id") -> "RandomScorer":
        return cls(df.agg(F.avg(target)).first()[0], key)

    def score(self, df: DataFrame) -> DataFrame:
        hit = unit_draw(self.key, f"{self.seed}:draw") < F.lit(self.prior)
        return df.withColumn("yhat", F.when(hit, 1).otherwise(0)).withColumn("p", F.col("yhat").cast("double"))


@dataclass(frozen=True)
class RuleScorer:
    """Weighted vote of loyalty, above-median purchases and above-median time."""

    purchase_threshold: float
    time_threshold: float

    @classmethod
    def fit(cls, df: DataFrame) -> "RuleScorer":
        require_columns(df, ("NumberOfPurchases", "TimeSpentOnWebsite", "LoyaltyProgram"))
        q = exact_quantiles(df, {"NumberOfPurchases": [0.5], "TimeSpentOnWebsite": [0.5]})
        if q["NumberOfPurchases"][0] is None or q["TimeSpentOnWebsite"][0] is None:
            raise ContractError("the rule baseline needs values in both signal columns")
        return cls(q["NumberOfPurchases"][0], q["TimeSpentOnWebsite"][0])

    def config(self) -> dict[str, float]:
        return {"purchase_threshold": self.purchase_threshold, "time_threshold": self.time_threshold}

    def score(self, df: DataFrame) -> DataFrame:
        require_columns(df, ("NumberOfPurchases", "TimeSpentOnWebsite", "LoyaltyProgram"))

        def signal(column: str, threshold: float) -> Column:
            x = F.coalesce(lenient_double(column), F.lit(threshold))
            return F.when(x >= threshold, 1.0).otherwise(0.0)

        loyalty = clip(F.coalesce(lenient_double("LoyaltyProgram"), F.lit(0.0)), 0.0, 1.0)
        p = clip(
            F.lit(fixed.RULE_LOYALTY_WEIGHT) * loyalty
            + F.lit(fixed.RULE_PURCHASE_WEIGHT) * signal("NumberOfPurchases", self.purchase_threshold)
            + F.lit(fixed.RULE_TIME_WEIGHT) * signal("TimeSpentOnWebsite", self.time_threshold),
            0.0, 1.0)
        return df.withColumn("p", F.round(p, 6)).withColumn(
            "yhat", F.when(F.col("p") >= fixed.RULE_LABEL_CUT, 1).otherwise(0))

    def additive(self, *frames: dict[str, str]) -> Additive | None:
        if not are_numbers(("NumberOfPurchases", "TimeSpentOnWebsite", "LoyaltyProgram"), *frames):
            return None
        signal = lambda threshold, weight: lambda x: weight * np.where(np.isnan(x) | (x >= threshold), 1.0, 0.0)
        return Additive(0.0, (
            (("LoyaltyProgram",), lambda x: fixed.RULE_LOYALTY_WEIGHT * np.clip(np.nan_to_num(x), 0.0, 1.0)),
            (("NumberOfPurchases",), signal(self.purchase_threshold, fixed.RULE_PURCHASE_WEIGHT)),
            (("TimeSpentOnWebsite",), signal(self.time_threshold, fixed.RULE_TIME_WEIGHT))), partial(np.clip, a_min=0.0, a_max=1.0))


@dataclass(frozen=True)
class Scorecard:
    """Min-max contributions plus three interaction bumps through a logistic curve."""

    ranges: dict = field(default_factory=lambda: dict(fixed.SCORECARD_RANGE))
    binary_cut: float = fixed.DEFAULT_BANDS["binary"]

    def _normal(self, column: str) -> Column:
        low, high = self.ranges[column]
        return min_max(F.col(column).cast("double"), low, high)

    def contributions(self) -> dict[str, Column]:
        category = F.lit(0.0)
        for code, weight in fixed.SCORECARD_CATEGORY.items():
            category = F.when(F.col("ProductCategory") == code, F.lit(weight)).otherwise(category)
        return {
            "LoyaltyProgram": F.when(F.col("LoyaltyProgram") == 1, F.lit(fixed.SCORECARD_LOYALTY)).otherwise(0.0),
            "TimeSpentOnWebsite": self._normal("TimeSpentOnWebsite") * fixed.SCORECARD_TIME,
            "NumberOfPurchases": self._normal("NumberOfPurchases") * fixed.SCORECARD_PURCHASES,
            "AnnualIncome": self._normal("AnnualIncome") * fixed.SCORECARD_INCOME,
            "Age": (F.lit(1.0) - self._normal("Age")) * fixed.SCORECARD_AGE,
            "ProductCategory": category,
            "Gender": F.when(F.col("Gender") == 1, F.lit(fixed.SCORECARD_GENDER)).otherwise(-fixed.SCORECARD_GENDER),
        }

    def probability(self) -> Column:
        time, purchases = self._normal("TimeSpentOnWebsite"), self._normal("NumberOfPurchases")
        young = F.lit(1.0) - self._normal("Age")
        raw = F.lit(fixed.SCORECARD_INTERCEPT)
        for part in self.contributions().values():
            raw = raw + part
        attentive = time > fixed.SCORECARD_HIGH_TIME
        bumps = (
            (attentive & (young > fixed.SCORECARD_YOUNG), fixed.SCORECARD_YOUNG_ATTENTION_BUMP),
            (attentive & (purchases < fixed.SCORECARD_LOW_HISTORY), fixed.SCORECARD_NEW_ATTENTION_BUMP),
            ((F.col("LoyaltyProgram") == 1) & (purchases > fixed.SCORECARD_HIGH_HISTORY),
             fixed.SCORECARD_LOYAL_BUYER_BUMP),
        )
        for condition, bump in bumps:
            raw = raw + F.when(condition, F.lit(bump)).otherwise(0.0)
        return F.round(clip(sigmoid(raw), *fixed.SCORECARD_CLAMP), 6)

    def score(self, df: DataFrame) -> DataFrame:
        require_columns(df, fixed.SAFE_NUMERIC + fixed.CATEGORICAL)
        return df.withColumn("p", self.probability()).withColumn(
            "yhat", F.when(F.col("p") >= self.binary_cut, 1).otherwise(0))

    def additive(self, *frames: dict[str, str]) -> Additive | None:
        if not are_numbers(fixed.SAFE_NUMERIC + fixed.CATEGORICAL, *frames):
            return None

        def normal(column: str, x: np.ndarray) -> np.ndarray:
            low, high = self.ranges[column]
            return (x - low) / (high - low) if high > low else x * 0.0

        time, purchases = partial(normal, "TimeSpentOnWebsite"), partial(normal, "NumberOfPurchases")
        income, young = partial(normal, "AnnualIncome"), lambda x: 1.0 - normal("Age", x)
        either = lambda condition, yes, no=0.0: np.where(condition, yes, no)

        def category(x: np.ndarray) -> np.ndarray:
            out = np.zeros(x.shape)
            for code, weight in fixed.SCORECARD_CATEGORY.items():
                out[x == code] = weight
            return out

        attentive = lambda x: time(x) > fixed.SCORECARD_HIGH_TIME
        return Additive(fixed.SCORECARD_INTERCEPT, (
            (("LoyaltyProgram",), lambda x: either(x == 1, fixed.SCORECARD_LOYALTY)),
            (("TimeSpentOnWebsite",), lambda x: time(x) * fixed.SCORECARD_TIME),
            (("NumberOfPurchases",), lambda x: purchases(x) * fixed.SCORECARD_PURCHASES),
            (("AnnualIncome",), lambda x: income(x) * fixed.SCORECARD_INCOME),
            (("Age",), lambda x: young(x) * fixed.SCORECARD_AGE),
            (("ProductCategory",), category),
            (("Gender",), lambda x: either(x == 1, fixed.SCORECARD_GENDER, -fixed.SCORECARD_GENDER)),
            (("TimeSpentOnWebsite", "Age"), lambda t, a: either(
                attentive(t) & (young(a) > fixed.SCORECARD_YOUNG), fixed.SCORECARD_YOUNG_ATTENTION_BUMP)),
            (("TimeSpentOnWebsite", "NumberOfPurchases"), lambda t, k: either(
                attentive(t) & (purchases(k) < fixed.SCORECARD_LOW_HISTORY), fixed.SCORECARD_NEW_ATTENTION_BUMP)),
            (("LoyaltyProgram", "NumberOfPurchases"), lambda l, k: either(
                (l == 1) & (purchases(k) > fixed.SCORECARD_HIGH_HISTORY), fixed.SCORECARD_LOYAL_BUYER_BUMP)),
        ), lambda raw: np.clip(logistic_curve(raw), *fixed.SCORECARD_CLAMP), fixed.SAFE_NUMERIC)


@dataclass(frozen=True)
class ExpressionScorer:
    """Any SQL expression as a scorer; used for stub models in tests and for scores stored upstream."""

    expression: str
    cut: float = 0.5

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("p", F.round(clip(F.expr(self.expression).cast("double"), 0.0, 1.0), 6)).withColumn(
            "yhat", F.when(F.col("p") >= self.cut, 1).otherwise(0))


def purchase_percent(p: Column) -> Column:
    """Score out of 100, halves up."""
    return clip(F.floor(p * 100 + F.lit(0.5)).cast("double"), 0.0, 100.0).cast("int")


def score_discount(percent: Column) -> Column:
    """Discount rate that closes half the distance to the no-discount score, in whole percents."""
    gap = F.ceil((F.lit(fixed.SCORECARD_FREE_SCORE) - percent) / F.lit(2.0)).cast("double")
    return F.when(percent >= fixed.SCORECARD_FREE_SCORE, F.lit(0.0)).otherwise(F.round(gap / 100.0, 2))


def scorecard_drivers(df: DataFrame, card: Scorecard | None = None, size: int = 3) -> DataFrame:
    """Adds ``drivers``: names of the strongest contributions, largest magnitude first."""
    card = card or Scorecard()
    parts = [
        F.struct((-F.abs(value)).alias("k"), F.lit(i).alias("i"), F.lit(name).alias("name"))
        for i, (name, value) in enumerate(card.contributions().items())
    ]
    ranked = F.slice(F.array_sort(F.array(*parts)), 1, size)
    return df.withColumn("drivers", F.transform(ranked, lambda s: s["name"]))
