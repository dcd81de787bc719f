"""Mixing sources to target weights: hash-random keys, range-sorted within each source, distributed prefix sums of
word counts, cut at each source's exact budget; whole epochs are repeated where the budget exceeds the source.

Everything here is DataFrame expressions. A source may hold any share of the rows: its rows are dealt to key ranges of
about `RANGE_ROWS` documents (of all sources), prefix sums run inside each range, and the ranges' totals (one small row each) give the offsets.

Defined results: NULL text counts no words; NULL is a source of its own, last in order; a source without words gets
target 0; repeated rows are separate documents that tie, so the taken words among them are the same multiset each run;
an empty table gives an empty result; other columns pass through in
`mix_row`, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentspark.llm.common import WORD, keep, word_count

RANGE_ROWS = 1_000
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)


def source_targets(per_source: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(mix_source, source_size) -> with `target`: the total shared by weight, no target above `max_epochs` times its
    source, the excess reshared by weight among the others until none is above.

    With the sources in order of cap/weight, the resharing ends at one level per unit of weight: the first source whose
    cap lies above the level that is left for it and all later ones. Runs over one row per source.
    """
    by_name = W.orderBy(F.col("mix_source").asc_nulls_last())
    by_ratio = W.orderBy("mix_ratio", F.col("mix_source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (
        per_source.withColumn("mix_weight", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("mix_cap", F.col("source_size") * max_epochs)
        .withColumn("mix_ratio", F.col("mix_cap").cast("double") / F.col("mix_weight"))
    )
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("mix_cap").over(before), F.lit(0))).cast("double") / F.sum("mix_weight").over(onward)
    levels = ranked.withColumns({"mix_level": level, "mix_place": F.row_number().over(by_ratio)})
    first_free = F.min(F.when(F.col("mix_ratio") > F.col("mix_level"), F.struct("mix_place", "mix_level"))).over(everything)
    return levels.withColumn("mix_free", first_free["mix_level"]).select(
        "mix_source", "source_size",
        F.least(F.col("mix_cap").cast("double"), F.coalesce(F.col("mix_free") * F.col("mix_weight"), F.col("mix_cap").cast("double"))).alias("target"),
    )


def random_key(doc_id: Column) -> Column:
    """32 hex digits, the same for a document in every run and on every cluster."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def sized(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Documents with word count, source and random key: what the mix works on; with `carry` also `mix_row`, all columns."""
    return docs.select(
        *([F.struct("*").alias("mix_row")] if carry else []), "doc_id", word_count(F.col("text")).alias("size"), F.col("source").alias("mix_source"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("mix_name"), random_key(F.col("doc_id")).alias("mix_key"),
    )


def mix(measured: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`sized` rows with source_size, target and taken: the words that the mix takes of each document.

    `measured` is read three times; give it a written table. `taken` = epochs x size, plus in the last, partial epoch
    the part of the document that lies before the source's remaining budget in key order.
    """
    ranges = max(1, math.ceil(measured.count() / RANGE_ROWS))
    ranged = measured.withColumn("mix_range", F.floor(F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") / 2.0**32 * ranges).cast("int"))
    totals = ranged.groupBy("mix_name", "mix_range").agg(F.sum("size").alias("mix_sum"), F.first("mix_source").alias("mix_source"))
    targets = source_targets(totals.groupBy("mix_name").agg(F.first("mix_source").alias("mix_source"), F.sum("mix_sum").alias("source_size")), weights, max_epochs)
    targets = targets.withColumn("mix_name", F.coalesce(F.concat(F.lit("="), "mix_source"), F.lit(""))).drop("mix_source")
    earlier = W.partitionBy("mix_name").orderBy("mix_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("mix_offset", F.coalesce(F.sum("mix_sum").over(earlier), F.lit(0))).drop("mix_sum", "mix_source")
    plan = offsets.join(targets, "mix_name")
    within = W.partitionBy("mix_name", "mix_range").orderBy("mix_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("mix_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(plan, ["mix_name", "mix_range"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("mix_budget div source_size")).otherwise(0)
    left = F.col("mix_budget") - F.col("mix_epochs") * F.col("source_size") - F.col("mix_offset") - F.col("mix_before")
    return (
        placed.withColumn("mix_budget", budget).withColumn("mix_epochs", epochs)
        .withColumn("taken", (F.col("mix_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long"))
        .drop("mix_name", "mix_range", "mix_key", "mix_before", "mix_offset", "mix_budget", "mix_epochs")
        .withColumnRenamed("mix_source", "source")
    )


def expand(mixed: DataFrame) -> DataFrame:
    """The mix of carried rows as documents: each once per whole epoch, and once more, its `text` cut after the last taken
    word, at the budget's edge. Documents of no words that the mix passes over are dropped with the rest."""
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    copies = F.sequence(F.lit(1), (F.col("mix_whole") + F.when(F.col("mix_part") > 0, 1).otherwise(0)).cast("int"))
    text = F.col("mix_row.text")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("mix_part").cast("int")), " ")
    copied = mixed.where("taken > 0").withColumns({"mix_whole": whole, "mix_part": part}).withColumn("mix_copy", F.explode(copies))
    fields = [F.col("mix_row")[f].alias(f) for f in mixed.schema["mix_row"].dataType.names if f != "text"]
    ends = F.when(F.col("mix_copy") > F.col("mix_whole"), cut).otherwise(text)
    return copied.select(*fields, ends.alias("text"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    measured = keep(lambda: sized(docs), "mix")
    return mix(measured, weights, max_epochs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with sized as (
  select doc_id, source, case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end::bigint as size,
         md5(coalesce(cast(doc_id as varchar), '')) as k
  from documents),
per as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int as w, source_size * 3 as cap from per),
levels as (
  select *, cap::double / w as ratio,
    ((sum(source_size) over ())::bigint - coalesce(sum(cap) over (order by cap::double / w, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint)::double
      / (sum(w) over (order by cap::double / w, source nulls last rows between current row and unbounded following))::double as level,
    row_number() over (order by cap::double / w, source nulls last) as place
  from ranked),
targets as (
  select source, source_size,
    least(cap::double, coalesce((select arg_min(level, place) from levels where ratio > level) * w, cap::double)) as target
  from levels),
placed as (
  select s.doc_id, s.size, t.source_size, t.target, round(t.target)::bigint as budget,
    coalesce(sum(s.size) over (partition by s.source order by s.k, s.doc_id nulls first, s.size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (case when source_size > 0 then budget // source_size else 0 end * size
   + greatest(0, least(size, budget - case when source_size > 0 then budget // source_size else 0 end * source_size - before)))::bigint as taken
from placed
"""
