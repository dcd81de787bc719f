"""Column roles: what each operator may read, so operators stay table-agnostic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from intentspark import fixed


@dataclass(frozen=True)
class RoleSpec:
    target: str = fixed.TARGET
    numeric: tuple[str, ...] = fixed.SAFE_NUMERIC
    categorical: tuple[str, ...] = fixed.CATEGORICAL
    leaky: tuple[str, ...] = fixed.LEAKY
    integer_like: tuple[str, ...] = fixed.INTEGER_LIKE
    engineered_numeric: tuple[str, ...] = fixed.ENGINEERED_NUMERIC
    engineered_categorical: tuple[str, ...] = fixed.ENGINEERED_CATEGORICAL

    @property
    def base_inputs(self) -> tuple[str, ...]:
        """Model inputs; the leaky column is deliberately absent."""
        return self.numeric + self.categorical

    @property
    def all_numeric(self) -> tuple[str, ...]:
        return self.numeric + self.leaky

    @property
    def contract_inputs(self) -> tuple[str, ...]:
        """Columns of a decision request: everything but the label, in table order."""
        return tuple(c for c in fixed.PROFILE_COLUMNS if c in self.base_inputs + self.leaky)

    @property
    def columns(self) -> tuple[str, ...]:
        return self.contract_inputs + (self.target,)

    @property
    def matrix_numeric(self) -> tuple[str, ...]:
        return self.numeric + self.engineered_numeric

    @property
    def matrix_categorical(self) -> tuple[str, ...]:
        return self.categorical + self.engineered_categorical


DEFAULT_ROLES = RoleSpec()

PROFILE_SCHEMA = T.StructType([
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.IntegerType()),
    T.StructField("AnnualIncome", T.DoubleType()),
    T.StructField("NumberOfPurchases", T.IntegerType()),
    T.StructField("ProductCategory", T.IntegerType()),
    T.StructField("TimeSpentOnWebsite", T.DoubleType()),
    T.StructField("LoyaltyProgram", T.IntegerType()),
    T.StructField("DiscountsAvailed", T.IntegerType()),
    T.StructField("PurchaseStatus", T.IntegerType()),
])
