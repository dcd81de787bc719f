"""Exact quantiles and ranks without gathering a column in one task.

Spark's exact ``percentile`` keeps every distinct value of a column in one aggregation buffer, so it
stops working on continuous columns of a very large table. Here a column is first narrowed to a
small bracket around each wanted rank with a mergeable sketch; only the bracket's distinct values
are counted and ordered. The bracket is verified against exact counts, so the answer is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECT_DISTINCT = 1_000_000
SKETCH_ACCURACY = 10_000


def _columns_profile(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    aggregates = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggregates += [
            F.count(x).alias(f"n{i}"),
            F.approx_count_distinct(x).alias(f"d{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: {"n": row[f"n{i}"], "distinct": row[f"d{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"]}
        for i, c in enumerate(columns)
    }


def _narrow(df: DataFrame, brackets: dict[tuple[str, int], dict], accuracy: int) -> None:
    """One sketch pass: tighten every bracket around its two target ranks."""
    aggregates = []
    slots = list(brackets)
    for i, slot in enumerate(slots):
        b = brackets[slot]
        x = F.col(slot[0])
        inside = F.when((x >= b["lo"]) & (x <= b["hi"]), x)
        n = max(b["inside"], 1)
        margin = 2.0 / accuracy
        low = max(0.0, (b["rank_lo"] - b["below"]) / n - margin)
        high = min(1.0, (b["rank_hi"] - b["below"] + 1) / n + margin)
        aggregates.append(F.percentile_approx(inside, [low, high], accuracy).alias(f"s{i}"))
    row = df.agg(*aggregates).first()
    counts = []
    for i, slot in enumerate(slots):
        low, high = row[f"s{i}"]
        x = F.col(slot[0])
        counts += [
            F.count_if(x < low).alias(f"b{i}"),
            F.count_if((x >= low) & (x <= high)).alias(f"k{i}"),
            F.approx_count_distinct(F.when((x >= low) & (x <= high), x)).alias(f"d{i}"),
        ]
    checked = df.agg(*counts).first()
    for i, slot in enumerate(slots):
        low, high = row[f"s{i}"]
        b = brackets[slot]
        below, inside = checked[f"b{i}"], checked[f"k{i}"]
        if below <= b["rank_lo"] and b["rank_hi"] < below + inside:
            b.update(lo=low, hi=high, below=below, inside=inside, distinct=checked[f"d{i}"])


def exact_quantiles(
    df: DataFrame,
    wanted: dict[str, list[float]],
    direct_distinct: int = DIRECT_DISTINCT,
    accuracy: int = SKETCH_ACCURACY,
    distinct: dict[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each column, exactly; NULL and NaN are ignored.

    Returns one number per (column, probability): driver scalars whose count does not grow with data.
    A dict passed as ``distinct`` receives each column's number of distinct values (exact up to
    ``direct_distinct``, an estimate above it).
    """
    columns = list(wanted)
    numeric = df.select([
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns
    ])
    profile = _columns_profile(numeric, columns)

    brackets: dict[tuple[str, int], dict] = {}
    for c in columns:
        p = profile[c]
        if not p["n"]:
            continue
        for i, prob in enumerate(wanted[c]):
            h = (p["n"] - 1) * prob
            brackets[(c, i)] = {
                "rank_lo": math.floor(h), "rank_hi": math.ceil(h), "frac": h - math.floor(h),
                "lo": p["min"], "hi": p["max"], "below": 0, "inside": p["n"], "distinct": p["distinct"],
            }
    if distinct is not None:
        distinct.update({c: profile[c]["distinct"] for c in columns})
    while True:
        wide = {s: b for s, b in brackets.items() if b["distinct"] > direct_distinct and b["lo"] < b["hi"]}
        if not wide:
            break
        before = {s: b["inside"] for s, b in wide.items()}
        _narrow(numeric, wide, accuracy)
        if all(brackets[s]["inside"] >= before[s] for s in wide):
            accuracy *= 10  # a finer sketch ends the search at the latest when it holds every row of the bracket

    # Columns whose slots share one bracket (never narrowed) are counted once.
    groups: dict[tuple[str, float, float], list[tuple[str, int]]] = {}
    for slot, b in brackets.items():
        groups.setdefault((slot[0], b["lo"], b["hi"]), []).append(slot)
    if not groups:
        return {c: [None] * len(wanted[c]) for c in columns}

    keyed = list(groups.items())
    entries = F.explode(F.array(*[
        F.struct(
            F.lit(g).alias("g"),
            F.when((F.col(c) >= lo) & (F.col(c) <= hi), F.col(c)).alias("x"),
        )
        for g, ((c, lo, hi), _) in enumerate(keyed)
    ]))
    histogram = (
        numeric.select(entries.alias("e")).select("e.g", "e.x").where(F.col("x").isNotNull())
        .groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.withColumn("upto", F.sum("n").over(order))
    picks = []
    for g, (_, slots) in enumerate(keyed):
        for slot in slots:
            b = brackets[slot]
            for end in ("rank_lo", "rank_hi"):
                rank = b[end] - b["below"]
                picks.append(
                    F.min(F.when((F.col("g") == g) & (F.col("upto") > rank), F.col("x"))).alias(
                        f"{columns.index(slot[0])}_{slot[1]}_{end}")
                )
    whole = [
        (g, c) for g, ((c, lo, hi), _) in enumerate(keyed) if lo == profile[c]["min"] and hi == profile[c]["max"]]
    picks += [F.count_if(F.col("g") == g).alias(f"distinct_{g}") for g, _ in whole]
    row = ranked.agg(*picks).first()
    if distinct is not None:
        distinct.update({c: row[f"distinct_{g}"] for g, c in whole})
    result: dict[str, list[float | None]] = {c: [None] * len(wanted[c]) for c in columns}
    for (c, i), b in brackets.items():
        low = row[f"{columns.index(c)}_{i}_rank_lo"]
        high = row[f"{columns.index(c)}_{i}_rank_hi"]
        result[c][i] = low + b["frac"] * (high - low) if high != low else low
    return result


def quantile_edges(
    df: DataFrame, columns: list[str], count: int = 4, also: dict[str, list[float]] | None = None,
) -> tuple[dict[str, list[float] | None], dict[str, list[float | None]]]:
    """(distinct quantile edges per column, other quantiles asked for in ``also``) from one search.

    Edges run lowest to highest and are None for fewer than two distinct values. The number of quantiles
    is capped by the number of distinct values, which is known only afterwards, so the few alternatives
    are looked up together; ties collapse edges.
    """
    also = also or {}
    ladders = {k: [i / k for i in range(k + 1)] for k in range(2, count + 1)}
    probs = sorted({p for ladder in ladders.values() for p in ladder})
    wanted = {c: probs + also.get(c, []) for c in columns}
    distinct: dict[str, int] = {}
    values = exact_quantiles(df, wanted, distinct=distinct)
    edges: dict[str, list[float] | None] = {}
    for c in columns:
        at = dict(zip(probs, values[c]))
        k = min(count, distinct.get(c, 0))
        edges[c] = sorted({at[p] for p in ladders[k]}) if k >= 2 else None
    return edges, {c: values[c][len(probs):] for c in also}


def band_index(value: Column, edges: list[float]) -> Column:
    """Number of interior edges strictly below the value (right-closed bands), NULL for NULL."""
    inner = edges[1:-1]
    index = F.lit(0)
    for edge in inner:
        index = index + F.when(value > F.lit(edge), 1).otherwise(0)
    return F.when(value.isNotNull(), index)


BUCKET_ROWS = 50_000


def prefix_digits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Hex digits of a uniform hash that deal so many rows to buckets of at most about ``bucket_rows``."""
    return max(1, math.ceil(math.log(max(1.0, rows / bucket_rows), 16)))


#: Hex digits of a level of running totals: a window orders at most 16 ** LEVEL_DIGITS rows.
LEVEL_DIGITS = 3


def prefix_offsets(sizes: DataFrame, digits: int, by: tuple[str, ...] = ()) -> DataFrame:
    """by, _bucket, _offset: rows in buckets before each bucket, from (by, _bucket, _size).

    The totals are summed in levels like a tree: a bucket's offset is the offset of its parent, the prefix some digits
    shorter, and the sizes of the siblings before it. So every window has a bounded number of rows, at any number of buckets.
    """
    lengths = [*range(LEVEL_DIGITS, digits, LEVEL_DIGITS), digits]
    upper, parent = None, 0
    for length in lengths:
        level = sizes.groupBy(*by, F.substring("_bucket", 1, length).alias("_bucket")).agg(F.sum("_size").alias("_size"))
        level = level.withColumn("_parent", F.substring("_bucket", 1, parent))
        before = Window.partitionBy(*by, "_parent").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        if upper is not None:
            above = upper.select(*by, F.col("_bucket").alias("_parent"), F.col("_offset").alias("_above"))
            level = level.join(above, [*by, "_parent"]).withColumn("_offset", F.col("_offset") + F.col("_above"))
        upper, parent = level.select(*by, "_bucket", "_offset"), length
    return upper


def hash_rank(df: DataFrame, hash_column: str, name: str, rows: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Dense 1-based position in the order of a uniform hex hash, without a global window.

    ``rows`` is about the size of a group. Rows are ordered inside buckets of equal hash prefix, whose length follows
    from ``rows``; bucket offsets come from running totals over the bucket counts, level by level. The prefix is uniform, so buckets
    are even whatever the size.
    """
    digits = prefix_digits(rows)
    bucketed = df.withColumn("_bucket", F.substring(hash_column, 1, digits))
    sizes = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    offsets = prefix_offsets(sizes, digits, by)
    within = Window.partitionBy(*by, "_bucket").orderBy(hash_column)
    return (
        bucketed.join(offsets, [*by, "_bucket"])
        .withColumn(name, F.col("_offset") + F.row_number().over(within))
        .drop("_bucket", "_offset")
    )
