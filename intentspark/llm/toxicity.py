"""Toxicity by noisy-channel deobfuscation: a Viterbi search over each word's character lattice restores what leetspeak,
separators, spacing and repetition hide; then the restored text is scored.

The character language model is trigram counts over the words of all documents (exact sums of a fixed length). A lattice
gives every character its readings: itself, the letters it may stand for (also for foreign and accented letters), nothing
(separators), a run of one letter shortened. Only a word of other letters without doubles has one reading and needs no
search; few readings are scored one by one, more by the Viterbi search, at any length. Runs of three or more single
characters are searched with a possible word break before every character. Features of a restored word are the word and
its first four to seven letters; a document has each once. The candidate features (at most `FEATURES`, those that tell the labels apart most) and a
logistic model over them with weights >= 0 come from a bounded sample of labelled documents (`TRAIN_ROWS`).

Defined results: NULL text is empty; a text without any candidate feature gets the model's base score; without labels of
both kinds every score is the labels' mean (0 without any); repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentspark.llm import arrays as A
from intentspark.llm.common import keep
from intentspark.llm.labelled import fold, training_rows
from intentspark.llm.totals import corpus_sum

SYMBOLS, BREAK = 64, 0
FOLDS, HELD, THRESHOLD, TRAIN_ROWS, FEATURES, SUPPORT, ODDS = 4, 2, 0.3, 20_000, 4_000, 3, 2.0
STEMS = (4, 5, 6, 7)
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il",
    "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
    "á": "a", "à": "a", "ä": "a", "â": "a", "é": "e", "è": "e", "ê": "e", "ë": "e", "í": "i", "ì": "i", "ï": "i", "î": "i", "ó": "o", "ò": "o", "ö": "o", "ô": "o", "ú": "u", "ù": "u", "ü": "u",
}
EDGES = " .,;:!?\"'()[]{}<>%&*#|~`-_=/\\^​‌‍﻿"
#: Log costs: a sign read as a letter, a sign dropped, a sign kept as a word break, a pair of letters read as one, a letter without its accent
#: or of another script, a new word in a spaced run.
AS_LETTER, DROPPED, KEPT, SINGLED, ACCENT, PARTED = -1.0, -1.5, -6.0, -4.0, -3.0, -2.0
#: What may hide a letter in a word of letters only.
AMBIGUOUS = re.compile(r"(.)\1|[" + "".join(map(re.escape, STANDS_FOR)) + "]", re.S)
#: Signs at a word's edge that can't be a letter.
OUTSIDE = "".join(c for c in EDGES if c not in STANDS_FOR)
#: Signs before a word that are a letter or none of it.
LEADS = re.compile("[" + "".join(re.escape(c) for c in EDGES if c in STANDS_FOR) + "]+")
REMEMBERED, LISTED = 100_000, 16
#: Runs of signs that are a letter or left out.
OPTIONAL = re.compile("([" + "".join(re.escape(c) for c in STANDS_FOR if not c.isalpha() and not c.isdigit()) + r"])\1*")


def symbol_table() -> np.ndarray:
    """Symbol of every code point below 65536: a to z are 1 to 26, other letters share 27 to 63, the rest is a break."""
    out = np.zeros(65536, np.uint8)
    for cp in range(65536):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[0]
            out[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 37
    return out


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(symbol_table())
    return _TABLE[0][np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 65535)]


def count_trigrams(batch: pa.RecordBatch, vector: np.ndarray) -> None:
    """Adds the trigrams of all words; a word is preceded by two breaks and followed by one."""
    s = symbols("\n".join(t or "" for t in A.column(batch, "text").to_pylist()) + "\n").astype(np.int64)
    before = np.concatenate([[BREAK], s[:-1]])
    two = np.where(before == BREAK, BREAK, np.concatenate([[BREAK, BREAK], s[:-2]])[: len(s)])
    use = (s != BREAK) | (before != BREAK)
    vector += np.bincount((two * SYMBOLS + before)[use] * SYMBOLS + s[use], minlength=len(vector))


class Channel:
    """The character model and the search for the likeliest reading."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)
        self.rows: dict[tuple[int, int], list[float]] = {}
        self.known: dict[str, str] = {}

    def row(self, a: int, b: int) -> list[float]:
        found = self.rows.get((a, b))
        if found is None:
            found = self.rows[a, b] = self.log[a, b].tolist()
        return found

    @staticmethod
    def lattice(word: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
        """For every run of one character its readings and their costs; in a spaced word any may start a new word. A leading
        sign that may be a letter is one."""
        out = []
        for run in re.finditer(r"(.)\1*", word, re.S):
            c, n = run[1], len(run[0])
            letters = STANDS_FOR.get(c, "")
            if c.isalpha():
                single = SINGLED if n == 2 and not spaced else 0.0
                options = [(c, single)] + [(c * 2, 0.0)] * (n >= 2)
                for x in letters:
                    options += [(x, ACCENT + single)] + [(x * 2, ACCENT)] * (n >= 2)
            else:
                dropped = 0.0 if c in EDGES and run.end() == len(word) else DROPPED
                options = [(x, AS_LETTER) for x in letters] + [(x * 2, AS_LETTER) for x in letters if n >= 2]
                if spaced or run.start() or not LEADS.match(c):
                    options += [(" ", 2 * KEPT if letters else KEPT)] + [("", dropped)] * (not c.isdigit())
            if spaced:
                options += [(f"{x[0]} {x[0]}", cost) for x, cost in options if len(x) == 2]
                options += [(" " + x, cost + PARTED) for x, cost in options if x.strip()] if run.start() else []
            out.append(options)
        return out

    def restore(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The likeliest reading; breaks in it are blanks."""
        states = {(BREAK, BREAK): (0.0, None)}
        for options in lattice:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            steps = [(reading, cost, symbols(reading).tolist() if reading else ()) for reading, cost in options]
            for (a0, b0), (score, before) in states.items():
                for reading, cost, signs in steps:
                    a, b, total = a0, b0, score + cost
                    for s in signs:
                        if s != BREAK or b != BREAK:
                            total += self.row(a, b)[s]
                        a, b = (b, s) if s != BREAK else (BREAK, BREAK)
                    if (a, b) not in after or total > after[a, b][0]:
                        after[a, b] = (total, (before, reading))
            states = after
        _, last = max(((score + (self.row(a, b)[BREAK] if b != BREAK else 0.0), before) for (a, b), (score, before) in states.items()), key=lambda r: r[0])
        parts = []
        while last is not None:
            last, reading = last
            parts.append(reading)
        return "".join(parts[::-1])

    def restore_listed(self, lattices: list[list[list[tuple[str, float]]]]) -> list[str]:
        """As `restore`, for words of few readings, all of which are scored."""
        readings: list[str] = []
        costs: list[float] = []
        first = [0]
        for lattice in lattices:
            texts, sums = [""], [0.0]
            for options in lattice:
                if len(options) == 1:
                    (c, cost), = options
                    texts, sums = [t + c for t in texts], [x + cost for x in sums]
                else:
                    texts, sums = [t + c for t, (c, _) in product(texts, options)], [x + cost for x, (_, cost) in product(sums, options)]
            readings += texts
            costs += sums
            first.append(len(readings))
        s = symbols("\n".join(readings) + "\n").astype(np.int64)
        before = np.concatenate([[BREAK], s[:-1]])
        two = np.where(before == BREAK, BREAK, np.concatenate([[BREAK, BREAK], s[:-2]])[: len(s)])
        logs = np.where((s != BREAK) | (before != BREAK), self.log[two, before, s], 0.0)
        starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in readings])[:-1]])
        totals = np.add.reduceat(logs, starts) + costs
        word = np.repeat(np.arange(len(lattices)), np.diff(first))
        best = np.lexsort((-totals, word))[first[:-1]]
        return [readings[i] for i in best.tolist()]

    def read_all(self, words: list[str]) -> list[str]:
        """Words as they stand in the text, restored; letters only, parts separated by blanks. A word behind signs that may
        be letters is read without them, with the last and with all."""
        out: list[list[str]] = [[] for _ in words]
        unread = []
        for at, word in enumerate(words):
            core = word.lower().strip(OUTSIDE)
            if not core.isalpha() and not any(map(str.isalpha, core)):
                out[at] = re.findall(r"[^\W\d_]+", core)
                continue
            lead = LEADS.match(core)
            bare = core[lead.end() :].lstrip(EDGES) if lead else core
            for text in {bare: 0, core[lead.end() - 1 :]: 0, core: 0} if lead else (core,):
                if text.isalpha() and not AMBIGUOUS.search(text):
                    out[at].append(text)
                elif text in self.known:
                    out[at].append(self.known[text])
                else:
                    unread.append((at, text))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for a in range(0, len(unread), 5_000):
            part = [(at, text, self.lattice(text)) for at, text in unread[a : a + 5_000]]
            few = [math.prod(map(len, lattice)) <= LISTED for *_, lattice in part]
            listed = iter(self.restore_listed([p[2] for p, f in zip(part, few, strict=True) if f]) if any(few) else [])
            for (at, text, lattice), f in zip(part, few, strict=True):
                found = next(listed) if f else self.restore(lattice)
                out[at].append(found)
                if len(self.known) <= REMEMBERED:
                    self.known[text] = found
        return [" ".join(o) for o in out]

    def read(self, word: str) -> str:
        return self.read_all([word])[0]

    def spaced(self, characters: str) -> str:
        """Single characters in a row, restored and parted into words, then the words with a break one letter off."""
        if sum(map(str.isalpha, characters)) < 2:
            return ""
        words = self.restore(self.lattice(characters.lower(), True)).split()
        moved = [w for a, b in zip(words[:-1], words[1:], strict=True) for w in (a[:-1], a[-1] + b, a + b[0], b[1:]) if w]
        return " ".join(words + moved)


def features(restored: str) -> list[str]:
    out = []
    for word in restored.split():
        if len(word) >= 3:
            out.append(word)
            out.extend(["^" + word[:n] for n in STEMS if n < len(word)])
    return out


def letter_classes() -> dict[str, str]:
    """For every letter or sign of the channel one letter of its class: letters that one sign may stand for are one class."""
    above: dict[str, str] = {}

    def top(c: str) -> str:
        while above.get(c, c) != c:
            c = above[c]
        return c

    for sign, letters in STANDS_FOR.items():
        group = sorted({top(x) for x in letters} | ({top(sign)} if sign.isalpha() else set()))
        for c in group:
            above[c] = group[0]
    return {c: top(c) for c in {*above, *(x for letters in STANDS_FOR.values() for x in letters)}} | {s: top(v[0]) for s, v in STANDS_FOR.items() if not s.isalpha()}


class Sieve:
    """Which words can yield a wanted feature at all. Every reading of a word keeps the classes of its letters, but for
    repeats and signs that are left out; so a feature must stand in the word's classes, in a word of letters only at its
    start. The others need no search."""

    REPEATS = re.compile(r"(.)\1+")

    def __init__(self, wanted: dict[str, int]):
        self.table = str.maketrans(letter_classes())
        folded = lambda f: self.REPEATS.sub(r"\1", f.translate(self.table))
        self.words = {folded(f) for f in wanted if not f.startswith("^")}
        self.stems = {folded(f[1:]) for f in wanted if f.startswith("^")}
        self.lengths = sorted({len(f) for f in self.stems})
        self.anywhere = ahocorasick.Automaton()
        for f in self.words | self.stems:
            self.anywhere.add_word(f, f)
        if self.words or self.stems:
            self.anywhere.make_automaton()

    def _holds(self, text: str) -> bool:
        return next(self.anywhere.iter(self.REPEATS.sub(r"\1", text)), None) is not None

    def _signs_hold(self, core: str) -> bool:
        """A word with signs: those that may be letters are kept, or, if there is one, also left out."""
        letters = "".join(c for c in core if c.isalpha() or c in STANDS_FOR)
        signs = {m[1] for m in OPTIONAL.finditer(core)}
        if len(OPTIONAL.findall(core)) > 1:
            return True
        return any(self._holds(t.translate(self.table)) for t in {letters, "".join(c for c in letters if c not in signs)})

    def passes(self, words: list[str]) -> list[int]:
        """The places of the words to search."""
        if not (self.words or self.stems):
            return []
        cores = [w.lower().strip(OUTSIDE) for w in words]
        plain = [i for i, c in enumerate(cores) if c.isalpha()]
        folded = self.REPEATS.sub(r"\1", "\n".join(cores[i] for i in plain).translate(self.table)).split("\n")
        stems, known, lengths = self.stems, self.words, self.lengths
        out = [i for i, f in zip(plain, folded, strict=True) if f in known or any(f[:n] in stems for n in lengths)] if plain else []
        return sorted(out + [i for i, c in enumerate(cores) if not c.isalpha() and any(map(str.isalpha, c)) and self._signs_hold(c)])


def spaced_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[tuple[int, str]]:
    """(text, characters) of every run of three or more words of one character."""
    lead = data[starts] if len(starts) else np.empty(0, np.uint8)
    width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
    single = ends - starts == width
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    change = np.flatnonzero(np.diff(np.concatenate([[0], np.where(single, text + 1, 0), [0]])))
    out = []
    for a, b in zip(change[:-1], change[1:], strict=True):
        if b - a >= 3 and single[a]:
            out.append((int(text[a]), b"".join(data[starts[i] : ends[i]].tobytes() for i in range(a, b)).decode("utf-8", "replace")))
    return out


def found_features(texts: pa.Array, channel: Channel, wanted: dict[str, int] | None, sieve: Sieve | None = None) -> list[set]:
    """The features of every text (with `wanted`: the numbers of those in it; words that `sieve` stops hold none)."""
    data, offsets = A.as_bytes(texts)
    starts, ends, first = A.word_bounds(data, offsets)
    words, codes = A.distinct_words(data, starts, ends)
    pick = features if wanted is None else (lambda w: [wanted[f] for f in features(w) if f in wanted])
    search = range(len(words)) if sieve is None else sieve.passes(words)
    each: list[list] = [[]] * len(words)
    for i, restored in zip(search, channel.read_all([words[i] for i in search]), strict=True):
        each[i] = pick(restored)
    out: list[set] = [set() for _ in range(len(texts))]
    holds = np.fromiter(map(bool, each), bool, len(each))
    at = np.flatnonzero(holds[codes]) if len(codes) else codes
    text = np.searchsorted(first, at, side="right") - 1
    pairs = np.unique(text * max(1, len(words)) + codes[at]) if len(at) else at
    for pair in pairs.tolist():
        out[pair // len(words)].update(each[pair % len(words)])
    for i, characters in spaced_runs(data, starts, ends, first):
        fs = features(channel.spaced(characters))
        out[i].update(fs if wanted is None else [wanted[f] for f in fs if f in wanted])
    return out


class Model:
    """Logistic model over the presence of features; weights are not negative."""

    def __init__(self, names: list[str], rows: list[list[int]], y: np.ndarray, rounds: int = 400, rate: float = 0.1, decay: float = 1e-2):
        self.names, self.weights, self.constant = names, np.zeros(len(names)), None
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        of = np.array([f for r in rows for f in r], np.int64)
        w, m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1), np.zeros(len(names) + 1)
        w[-1] = math.log(y.mean() / (1 - y.mean()))
        for step in range(1, rounds + 1):
            error = (1 / (1 + np.exp(-np.clip(np.bincount(at, w[of], len(rows)) + w[-1], -40, 40))) - y) / len(y)
            g = np.append(np.bincount(of, error[at], len(names)) + decay * w[:-1] / max(1, len(names)) ** 0.5, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
            w[:-1] = np.maximum(w[:-1], 0)
        self.weights, self.bias = w[:-1], w[-1]

    def score(self, found: list[set]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(found), self.constant)
        z = np.array([self.bias + sum(self.weights[f] for f in sorted(fs)) for fs in found])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def character_counts(docs: DataFrame) -> np.ndarray:
    return corpus_sum(docs.select("text"), SYMBOLS**3, count_trigrams)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held: int = HELD, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Model]:
    counts = character_counts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value)
        for batch in A.pieces(batches):
            found = found_features(A.column(batch, "text"), channel, None)
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), A.column(batch, "y"), pa.array([sorted(f) for f in found], pa.list_(pa.string()))], ["doc_id", "y", "features"])

    sample = keep(lambda: training_rows(docs, labels, label, folds, held, rows).mapInArrow(read, "doc_id long, y int, features array<string>"), "toxicity")
    n = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    each = sample.select("doc_id", "y", F.explode("features").alias("feature"))
    odds = F.log((F.col("t") + 0.5) / (n["t"] + 1.0)) - F.log((F.col("n") - F.col("t") + 0.5) / (n["n"] - n["t"] + 1.0))
    told = each.groupBy("feature").agg(F.sum("y").alias("t"), F.count("*").alias("n")).where(F.col("t") >= SUPPORT).withColumn("odds", odds).where(F.col("odds") >= ODDS)
    names = sorted(r["feature"] for r in told.orderBy(F.desc(F.col("odds") * F.col("t")), "feature").limit(FEATURES).collect())
    number = {f: i for i, f in enumerate(names)}
    chosen = docs.sparkSession.createDataFrame([(f, i) for f, i in number.items()], "feature string, number int")
    held_rows = each.join(F.broadcast(chosen), "feature").groupBy("doc_id").agg(F.collect_list("number").alias("numbers"))
    pairs = sample.select("doc_id", "y").join(held_rows, "doc_id", "left").orderBy("doc_id").collect()
    return counts, Model(names, [sorted(r["numbers"] or []) for r in pairs], np.array([r["y"] for r in pairs], float))


def score(docs: DataFrame, fitted: tuple[np.ndarray, Model]) -> DataFrame:
    shared, model = docs.sparkSession.sparkContext.broadcast(fitted[0]), fitted[1]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, wanted = Channel(shared.value), {f: i for i, f in enumerate(model.names)}
        sieve = Sieve(wanted)
        for batch in A.pieces(batches):
            s = model.score(found_features(A.column(batch, "text"), channel, wanted, sieve))
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), pa.array(s)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
