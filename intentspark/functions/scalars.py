"""Column expressions shared by the operators: coercion, hashing, steps, squashing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(column: str | Column) -> Column:
    """Number or NULL, never an error; NaN is read as missing."""
    number = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when(~F.isnan(number), number)


def binary_like(column: str) -> Column:
    """Spellings of 0 and 1 unified as "0" / "1"; anything else is kept as trimmed text."""
    text = F.trim(F.col(column).cast("string"))
    return (
        F.when(text.isin("0", "0.0"), F.lit("0"))
        .when(text.isin("1", "1.0"), F.lit("1"))
        .otherwise(text)
    )


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """numerator / denominator, or the default when the denominator is zero or NULL."""
    value = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def clip(value: Column, low: float, high: float) -> Column:
    """Within [low, high]. NULL and NaN stay what they are, for which least and greatest alone would give a bound: the
    difference of the value with itself is 0, NULL or NaN, and costs less generated code than a branch."""
    return F.least(F.greatest(value, F.lit(low)), F.lit(high)) + (value - value)


def usable_score(p: Column) -> Column:
    """True for a probability, false for NULL, NaN and anything outside [0, 1]."""
    return F.coalesce(p.between(0.0, 1.0), F.lit(False))  # NaN sorts above every number


def required_score(p: Column) -> Column:
    """The probability; a row without a usable one ends the query."""
    return F.when(usable_score(p), p).otherwise(F.raise_error(F.lit("a row to be evaluated has no score in [0, 1]")).cast("double"))


def rounded_score(p: Column) -> Column:
    """`round(p, 6)` of a probability, exactly: only a value next to a tie needs the decimal arithmetic of `round`."""
    shifted = p * F.lit(1_000_000.0) + F.lit(0.5)
    whole = F.floor(shifted)
    return F.when((shifted - whole).between(0.001, 0.999), whole / F.lit(1_000_000.0)).otherwise(F.round(p, 6))


def sigmoid(value: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-value))


def min_max(value: Column, low: float, high: float) -> Column:
    if high <= low:
        return F.lit(0.0)
    return (value - F.lit(low)) / F.lit(high - low)


def floor_step(value: Column, step: Column | float) -> Column:
    step = step if isinstance(step, Column) else F.lit(step)
    return F.floor(value / step).cast("double") * step


def ceil_step(value: Column, step: Column | float) -> Column:
    step = step if isinstance(step, Column) else F.lit(step)
    return F.ceil(value / step).cast("double") * step


def round_step(value: Column, step: Column | float) -> Column:
    """Nearest step, halves upwards."""
    step = step if isinstance(step, Column) else F.lit(step)
    return F.floor(value / step + F.lit(0.5)).cast("double") * step


def salted_hash(key: str, salt: str | int) -> Column:
    """First eight hex digits of md5(key:salt): a uniform, engine-independent draw."""
    return F.substring(F.md5(F.concat(F.col(key), F.lit(f":{salt}"))), 1, 8)


def hex_threshold(fraction: float) -> str:
    """Upper bound (exclusive) on salted_hash that keeps the given fraction of keys."""
    return format(int(fraction * 2**32), "08x")


def unit_draw(key: str, salt: str | int) -> Column:
    """Uniform draw in [0, 1) from 24 hash bits."""
    digits = F.substring(F.md5(F.concat(F.col(key), F.lit(f":{salt}"))), 1, 6)
    return F.conv(digits, 16, 10).cast("double") / F.lit(16777216.0)


def total(columns: list[Column]) -> Column:
    return reduce(add, columns)


def flag_list(*conditions: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds, in the given order.

    Concatenation stays inside generated code, which a lambda over an array would leave.
    """
    return labels(*[F.when(cond, F.lit(label)) for cond, label in conditions])


def labels(*values: Column) -> Column:
    """Array of the non-NULL strings, in the given order."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(v.isNotNull(), F.array(v)).otherwise(none) for v in values])
