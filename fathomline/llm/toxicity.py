"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text.

Folding: lower case, compatibility forms and accents of Latin letters kept, look-alike letters of other scripts
and zero-width marks folded, digits and signs inside words read as the letters they imitate. Lexicon entries are
whole words or word stems (prefixes); a hit must start at a word start, a whole word must also end at a word end,
and a hit that lies inside an exception phrase does not count. The score is a logistic function of three features, all over
the square root of the text's words: the weight of the hits, its logarithm, and the logarithm of the number of different entries.

The lexicon's weights come from labelled rows: a seed list of fixed entries, and words and stems whose share of
toxic rows stands out. They are fitted on at most ``TRAIN_ROWS`` labelled rows, taken in the order of a hash of
doc_id. Only rows whose crc32(doc_id as text) mod 5 is not 0 are taken.

Edge cases: a null or empty text has no hits and gets the score of the intercept; rows with a null doc_id are
scored (held_out: null id counts as the text "null" would, false); repeated rows get equal scores; with no usable
labels the seed list and fixed coefficients are used; an empty table gives no rows; of several texts of one labelled
doc_id the one with the least hash teaches; a very long text is matched whole, in one pass; other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import dicts, small_batches, staged, text_or_empty

#: Labelled rows used at most to fit weights and coefficients.
TRAIN_ROWS = 20_000
#: Learned lexicon entries at most.
LEXICON_ENTRIES = 1_000
#: Different tokens a task counts before it hands them on.
HELD_TOKENS = 100_000

# Common English insults that seed the lexicon, with their weights.
SEED = {"clown": 2.0, "disgusting": 2.0, "idiot": 3.0, "loser": 2.5, "moron": 3.0, "pathetic": 2.0, "scum": 3.0, "stupid": 2.5, "trash": 2.0, "worthless": 2.5}
# Phrases in which an entry is harmless.
EXCEPTIONS = ("circus clown", "clown fish", "recycle the trash", "sore loser rule", "take out the trash", "trash bin", "trash can", "trash collection")
# Look-alike letters of other scripts, by the Latin letter they imitate.
HOMOGLYPHS = {"a": "аαɑ", "b": "ЬƄ", "c": "сϲ", "d": "ԁ", "e": "еε℮", "g": "ɡ", "h": "һ", "i": "іιıӏ", "j": "ј", "k": "кκ", "l": "ⅼ", "m": "м", "n": "ոη", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝѡ", "x": "хχ", "y": "уγ", "z": "ᴢ"}
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_FOLD = {ord(c): k for k, v in HOMOGLYPHS.items() for c in v} | {0xFF41 + i: chr(97 + i) for i in range(26)} | dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
_SUBS = str.maketrans(SUBSTITUTES)
_SWAPPED = re.compile(r"(?=[^\W_]*[@$0-9])[^\W\d_]+[@$0134579]+(?:[^\W_]|[@$])*|[@$013457]+[^\W\d_](?:[^\W_]|[@$])*", re.A)
_HAS_SUBS = re.compile(r"[a-z][@$0-9]|[@$0-9][a-z]")
_WORDS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower-cased text with look-alikes and digit substitutions undone."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return _SWAPPED.sub(lambda m: m[0].translate(_SUBS), text) if _HAS_SUBS.search(text) else text


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 5 == 0


class Matcher:
    """The automaton. ``entries``: (pattern, stem?) to weight."""

    def __init__(self, entries: dict[tuple[str, bool], float], exceptions: tuple[str, ...] = EXCEPTIONS) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for (word, stem), weight in entries.items():
            self.automaton.add_word(word, (len(word), stem, weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), False, None))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight), one per word: the longest entry that holds; exception phrases taken out."""
        best: dict[int, tuple[int, float]] = {}
        spared, n = [], len(folded)
        for last, (size, stem, weight) in self.automaton.iter(folded):
            a, b = last - size + 1, last + 1
            if (a and folded[a - 1].isalpha()) or (not stem and b < n and folded[b].isalpha()):
                continue
            if weight is None:
                spared.append((a, b))
            elif a not in best or best[a][0] < b:
                best[a] = (b, weight)
        return [(a, b, w) for a, (b, w) in best.items() if not any(x <= a and b <= y for x, y in spared)]

    def features(self, text: str) -> tuple[float, float, float]:
        folded = fold(text)
        found = self.hits(folded)
        if not found:
            return 0.0, 0.0, 0.0
        total = sum(w for *_, w in found)
        length = math.sqrt(1 + folded.count(" "))
        return math.log1p(total / length), total / length, math.log1p(len({folded[a:b] for a, b, _ in found}) / length)


def tokens_of(text: str) -> set[tuple[str, bool]]:
    """What may become an entry: whole words, and stems of four to six letters of longer words."""
    words = set(_WORDS.findall(fold(text)))
    return {(w, False) for w in words if 3 <= len(w) <= 24} | {(w[:k], True) for w in words for k in (4, 5, 6) if len(w) > k}


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts outside the held-out fold, one for each doc_id."""
    slim = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null").where(~held_out())
    slim = slim.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(slim), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def learn_lexicon(rows: DataFrame, entries: int) -> dict[tuple[str, bool], float]:
    """Seed entries and those that stand out: weight = log of the smoothed ratio of their rates in toxic and other rows."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            keys = [*toxic, *(k for k in other if k not in toxic)]
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.bool_()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([other[k] for k in keys], pa.int64())], ["token", "stem", "toxic", "other"])
            toxic.clear()
            other.clear()
            return out

        for b in dicts(batches):
            for text, y in zip(b["text"], b["toxic"], strict=True):
                (toxic if y else other).update(tokens_of(text))
                if len(toxic) + len(other) > HELD_TOKENS:  # the counts of several batches meet in the aggregation
                    yield flush()
        if toxic or other:
            yield flush()

    totals = {bool(r["toxic"]): r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return {(w, False): x for w, x in SEED.items()}
    table = rows.select("text", "toxic").mapInArrow(counts, "token string, stem boolean, toxic long, other long").groupBy("token", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    ratio = F.log(((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("other") + 0.5) / (good + 1)))
    least = max(4, bad // 400)
    top = table.where(F.col("toxic") >= least).withColumn("weight", ratio).where("weight > 2.5").orderBy(F.desc("weight"), F.desc("toxic"), "token", "stem").limit(entries).collect()
    found = {(r["token"], r["stem"]): r["weight"] for r in top}
    return {(w, False): x for w, x in SEED.items() if (w, False) not in found} | found


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the last value is the intercept."""
    a = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(a.shape[1]), np.array([0.5] * x.shape[1] + [1e-6])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


class Model:
    def __init__(self, entries: dict[tuple[str, bool], float], coefficients, intercept: float) -> None:
        self.entries, self.coefficients, self.intercept = entries, [float(c) for c in coefficients], float(intercept)
        self._matcher: Matcher | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_matcher": None}

    def score(self, text: str) -> float:
        self._matcher = self._matcher or Matcher(self.entries)
        z = self.intercept + sum(c * f for c, f in zip(self.coefficients, self._matcher.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, entries: int = LEXICON_ENTRIES) -> Model:
    small_batches(docs.sparkSession)
    sample = staged(training_rows(docs, labels, rows), "toxicity-sample")  # read three times; ``docs`` only once
    lexicon = learn_lexicon(sample, entries)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for b in dicts(batches):
            cols = zip(*(matcher.features(t) for t in b["text"]), strict=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in cols), pa.array(b["toxic"], pa.float64())], ["a", "b", "c", "y"])

    pdf = sample.select("text", "toxic").mapInArrow(features, "a double, b double, c double, y double").toPandas()  # at most ``rows`` rows
    if not 0 < pdf["y"].sum() < len(pdf):
        return Model(lexicon, (3.0, 0.5, 0.5), -2.0)
    coefficients, intercept = fit(pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy())
    return Model(lexicon, coefficients, intercept)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``toxic_score``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts):  # noqa: ANN001
        return texts.map(model.score)

    return docs.withColumn("toxic_score", score(text_or_empty()))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
