"""Source divergence audit over hash-consed segment trees of term counts: how far the sources of a language differ in their
terms, pair by pair, and which terms set a source apart from its language.

1. Terms are counted per task and added up per (lang, source, term); a language keeps the terms in enough of its documents.
2. The kept terms of a language are dealt by hash into blocks of about `BLOCK`; inside a block they are numbered by their
   count in the language, so that rare terms, absent from most sources, lie together. Per block and source a segment tree over
   the numbers is built bottom up: a leaf is a count, a node the pair of its children, and equal pairs are one node, whatever
   source or place they come from (all sources of a block share the nodes).
3. Two trees are walked down together, level by level. Equal node pairs are merged before they are opened and carry how
   often they occur, so that each is priced once: a shared subtree costs the same for one occurrence as for a thousand.
   The block's prices are added up per pair of sources.

A block holds a bounded number of terms for any vocabulary; a source or language of any size is spread over the blocks, and
pairs are walked in batches of bounded size. The result itself has a row per ordered pair of sources of a language.

All arithmetic is in integers. Defined results: NULL text, lang and source are ''; a group without kept terms has only zero counts; a language
without kept terms gives every pair 0 and no term rows; empty and very long texts, repeated rows and ties of doc_id count as they
come (doc_id isn't read); equal values are ranked by item; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep

DOCUMENTS, SCALE, TOP, BLOCK = 10, 1_000_000_000, 10, 1024
#: Leaf pairs walked at once.
WALKED = 1 << 20

LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[128:] = np.arange(128, 256)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term, per piece of the input and group."""
    for batch in A.pieces(batches, size=6_000_000):
        data, offsets = A.as_bytes(A.column(batch, "text"))
        data = LETTERS[data]
        starts, ends, first = A.word_bounds(data, offsets)
        terms, codes = A.distinct_words(data, starts, ends)
        if not terms:
            continue
        lang, source = (A.column(batch, c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        doc = np.repeat(np.arange(len(group)), np.diff(first))
        in_doc, n = np.unique(doc * len(terms) + codes, return_counts=True)
        key = group[in_doc // len(terms)] * len(terms) + in_doc % len(terms)
        keys, back = np.unique(key, return_inverse=True)
        occurrences = np.zeros(len(keys), np.int64)
        np.add.at(occurrences, back, n)
        group = keys // len(terms)
        take = lambda values, at: values.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [take(lang.dictionary, group // len(source.dictionary)), take(source.dictionary, group % len(source.dictionary)), take(pa.array(terms, pa.string()), keys % len(terms)),
             pa.array(occurrences), pa.array(np.bincount(back, minlength=len(keys)), pa.int64())], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs."""
    counted = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]).mapInArrow(
        _count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exact in 64 bits for totals below 9e15."""
    rest = np.asarray(counts, np.int64) + 2
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return 1 + out


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Trees:
    """Segment trees of several sources over the same `terms` places; equal subtrees are one node. Node 0 of a level has
    zero counts only."""

    def __init__(self, source: np.ndarray, place: np.ndarray, count: np.ndarray, sources: int, terms: int):
        order = np.lexsort((place, source))
        source, place = source[order], place[order]
        self.terms, self.height = terms, max(0, int(terms - 1).bit_length())
        self.counts, node = np.unique(np.concatenate([[0], count[order]]), return_inverse=True)
        node = node[1:]
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        nodes = len(self.counts)
        for _ in range(self.height):
            parent = place >> 1
            new = np.ones(len(place), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (source[1:] != source[:-1])
            of = np.cumsum(new) - 1
            children = np.zeros((2, int(new.sum())), np.int64)
            children[place & 1, of] = node
            pairs, node = np.unique(np.concatenate([[0], children[0] * nodes + children[1]]), return_inverse=True)
            node = node[1:]
            self.left.append(pairs // nodes)
            self.right.append(pairs % nodes)
            nodes, place, source = len(pairs), parent[new], source[new]
        self.root = np.zeros(sources, np.int64)
        self.root[source] = node

    def price(self, a: int, others: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Sum over the places of the difference between source `a` and each of `others`."""
        pair, x, y, times = np.arange(len(others)), np.full(len(others), self.root[a]), self.root[others], np.ones(len(others), np.int64)
        for left, right in zip(self.left[::-1], self.right[::-1], strict=True):
            pair, times = np.tile(pair, 2), np.tile(times, 2)
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            order = np.lexsort((y, x, pair))
            pair, x, y = pair[order], x[order], y[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            begin = np.flatnonzero(new)
            times = np.add.reduceat(times[order], begin)
            pair, x, y = pair[begin], x[begin], y[begin]
        times = times - ((1 << self.height) - self.terms) * ((x == 0) & (y == 0))  # places beyond the last term
        value = difference(share(self.counts[x], totals[a]), share(self.counts[y], totals[others][pair])) * times
        return np.add.reduceat(value, np.flatnonzero(np.diff(pair, prepend=-1)))


def _price_block(table: pa.Table) -> pa.Table:
    """(lang, one, two, value): the block's part of the value of every pair of sources."""
    rows = table.to_pandas()
    groups = rows[rows["term"].isna()].sort_values("source").reset_index(drop=True)
    rows = rows[rows["term"].notna()]
    one, two, values = [], [], []
    if len(groups) > 1:
        number = {s: i for i, s in enumerate(groups["source"])}
        totals = groups["total"].to_numpy(np.int64)
        ordered = rows[["in_lang", "term"]].drop_duplicates().sort_values(["in_lang", "term"])
        places = {t: i for i, t in enumerate(ordered["term"])}
        trees = Trees(rows["source"].map(number).to_numpy(np.int64), rows["term"].map(places).to_numpy(np.int64), rows["n"].to_numpy(np.int64), len(groups), len(places)) if places else None
        step = max(1, WALKED // max(1, len(places)))
        for a in range(len(groups) - 1):
            for b in range(a + 1, len(groups), step):
                others = np.arange(b, min(b + step, len(groups)))
                one.append(np.full(len(others), a))
                two.append(others)
                values.append(trees.price(a, others, totals) if trees else np.zeros(len(others), np.int64))
    names = pa.array(groups["source"], pa.string())
    joined = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())
    return pa.table({"lang": pa.array([groups["lang"].iloc[0]] * sum(map(len, one)) if one else [], pa.string()), "one": names.take(joined(one)), "two": names.take(joined(two)), "value": joined(values)})


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` prices each other source of the language, part `term` gives the
    `top` terms that a group has more of than its language."""
    counts = keep(lambda: term_counts(docs), "counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).where(F.col("docs") >= documents).drop("docs")
    kept = keep(lambda: counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"), "kept")
    langs = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    all_groups = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = keep(lambda: all_groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("words"), zero("vocabulary")), "groups")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("vocabulary") / block)).cast("long")
    by_lang = groups.groupBy("lang").agg(F.max("vocabulary").alias("vocabulary"), F.sum("words").alias("lang_words")).withColumn("blocks", blocks)

    leaves = kept.join(by_lang, "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source", F.lit(None).cast("long").alias("total"), "term", "n", "in_lang")
    none = lambda t: F.lit(None).cast(t)
    total = F.col("words") + 2 * F.col("vocabulary")
    headers = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(
        "lang", "block", "source", total.alias("total"), none("string").alias("term"), none("long").alias("n"), none("long").alias("in_lang"))
    priced = headers.unionByName(leaves).groupBy("lang", "block").applyInArrow(_price_block, "lang string, one string, two string, value long")
    summed = priced.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    pairs = summed.select("lang", both.alias("p"), "value").select("lang", "p.source", "p.item", "value")

    p = lambda count, whole: F.expr(f"1 + (cast({count} + 2 as decimal(20, 0)) * {SCALE}) div ({whole} + 2 * vocabulary)")
    own = kept.join(groups, ["lang", "source"]).join(by_lang.select("lang", "lang_words"), "lang")
    shares = own.select("lang", "source", F.col("term").alias("item"), p("n", "words").alias("p"), p("in_lang", "lang_words").alias("q")).where("p > q")
    set_apart = shares.withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)"))
    return _ranked(pairs, "pair").unionByName(_ranked(set_apart, "term").where(F.col("rank") <= top))


SQL = r"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') text, row_number() over () id from documents),
w as (select lang, source, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
k as (select lang, term, count(*)::hugeint n from w group by all having count(distinct id) >= 10),
v as (select lang, count(*)::hugeint v, sum(n)::hugeint words from k group by all),
c as (select w.lang, source, w.term, count(*)::hugeint n from w join k on w.lang = k.lang and w.term = k.term group by all),
g as (select distinct lang, source from d),
gn as (select g.lang, g.source, coalesce(sum(n), 0)::hugeint words from g left join c on g.lang = c.lang and g.source = c.source group by all),
p as (select gn.lang, gn.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (gn.words + 2 * v.v) p, 1 + (1000000000 * (k.n + 2)) // (v.words + 2 * v.v) q
      from gn join k on gn.lang = k.lang join v on v.lang = k.lang left join c on c.lang = gn.lang and c.source = gn.source and c.term = k.term),
pairs as (select a.lang, a.source, b.source item, coalesce(s.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
          left join (select x.lang, x.source one, y.source two, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) as value
                     from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s on s.lang = a.lang and s.one = a.source and s.two = b.source),
terms as (select lang, source, term item, (((p - q) * (p - q)) // (p + q))::bigint as value from p where n > 0 and p > q),
ranked as (select lang, source, 'pair' part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from pairs
           union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item)::int from terms)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
