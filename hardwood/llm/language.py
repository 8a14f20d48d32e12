"""Language of a text by known words first, then by ever shorter character n-grams.

A word (letters, lower-cased) that was learned scores its log frequency in each language. An
unseen word backs off to its longest known character n-grams, of five down to one character with
a mark at either end, and scores the mean of their log frequencies. A text's scores are the sums
over its words; the best language wins (ties: the smaller name), and its share of the posterior is
the score.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every text
when nothing was learned. Rows with a NULL language teach nothing. Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import CACHE_WORDS, fold_rows, folds, map_rows, sampled
from hardwood.sinks.scratch import keep

# The model is fitted on at most about this many rows, chosen by a hash of id and text, which
# bounds what is counted and broadcast. Languages share them evenly, and what small ones leave goes
# to the large ones, so a rare language is learned from all its rows however large the table is.
# Predictions read all rows and whole texts.
MAX_TEACHERS = 12_000
LONGEST = 5
# Words and n-grams seen less often are left to backoff.
LEAST_COUNT = 4

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. Number signs such as ½ or Ⅳ part them, as digits do."""
    if not text:
        return []
    words = _WORD.findall(text.lower())
    if text.isascii() or not words or "".join(words).isalpha():
        return words
    return [own for word in words for own in "".join(c if c.isalpha() else " " for c in word).split()]


def grams_of(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    words: dict[str, int] = field(default_factory=dict)
    word_scores: np.ndarray | None = None
    grams: list[dict[str, int]] = field(default_factory=list)  # by length, 1 first
    gram_scores: list[np.ndarray] = field(default_factory=list)

    def backed_off(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            known = [self.grams[n - 1][g] for g in grams_of(word, n) if g in self.grams[n - 1]]
            if known:
                return self.gram_scores[n - 1][known].mean(axis=0)
        return np.zeros(len(self.languages))

    def judge(self, text: str | None, seen: dict[str, np.ndarray]) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.languages:
            return "und", 0.0
        total, known, get = np.zeros(len(self.languages)), [], self.words.get
        for word, count in Counter(words).items():
            at = get(word)
            if at is not None:
                known.append((at, count))
                continue
            scores = seen.get(word)
            if scores is None:
                scores = seen[word] = self.backed_off(word)
            total += count * scores
        if known:
            at, counts = np.array(known).T
            total += counts @ self.word_scores[at]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _count_words(slices):
    counts: Counter = Counter()

    def rows():
        return [k[0] for k in counts], [k[1] for k in counts], list(counts.values())

    for part in slices:
        for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            counts.update((lang, w) for w in words_of(text))
        if len(counts) > 300_000:
            yield rows()
            counts.clear()
    yield rows()


def _count_grams(slices):
    counts: Counter = Counter()

    def rows():
        keys = list(counts)
        return [k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], list(counts.values())

    for part in slices:
        for lang, word, count in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            for n in range(1, LONGEST + 1):
                for gram in grams_of(word, n):
                    counts[lang, n, gram] += count
        if len(counts) > 300_000:
            yield rows()
            counts.clear()
    yield rows()


def _log_frequencies(rows, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequencies of (lang, item, count) rows, one row per item."""
    at = {lang: i for i, lang in enumerate(languages)}
    items = {item: i for i, item in enumerate(sorted({r[1] for r in rows}))}
    counts = np.zeros((len(items), len(languages)))
    for lang, item, count in rows:
        counts[items[item], at[lang]] = count
    return items, np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(1, len(items))))


def _even_share(counts: list[int], total: int) -> float:
    """The most that each may have for all to have ``total`` together; one at least."""
    left = sorted(counts)
    while left and left[0] * len(left) <= total:
        total -= left.pop(0)
    return max(1.0, total / len(left)) if left else float("inf")


def fit(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    teaches: Column | None = None, max_teachers: int = MAX_TEACHERS,
) -> LanguageModel:
    """Learn from rows with a language for which ``teaches`` (on ``doc_id``) holds."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    if teaches is not None:
        rows = rows.filter(teaches)
    # A row per language.
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(counts.values()) > max_teachers:
        most = _even_share(list(counts.values()), max_teachers)
        chosen = F.lit(False)
        for lang, n in counts.items():
            chosen = chosen | ((F.col("lang") == lang) & sampled(most / n, "doc_id", "text"))
        rows = rows.filter(chosen)
    words = fold_rows(rows.select("text", "lang"), _count_words, "lang string, word string, n long")
    words = keep(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    grams = fold_rows(words, _count_grams, "lang string, size int, gram string, n long")
    grams = grams.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    model = LanguageModel(sorted(r.lang for r in words.select("lang").distinct().collect()))
    if not model.languages:
        return model
    often = words.filter(F.col("n") >= LEAST_COUNT).collect()
    model.words, model.word_scores = _log_frequencies(often, model.languages)
    found = grams.filter((F.col("n") >= LEAST_COUNT) | (F.col("size") == 1)).collect()
    for n in range(1, LONGEST + 1):
        items, scores = _log_frequencies([(r[0], r[2], r[3]) for r in found if r[1] == n], model.languages)
        model.grams.append(items)
        model.gram_scores.append(scores)
    return model


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Append lang_pred and score to every row."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def make():
        model, seen = shared.value, {}

        def compute(part):
            if len(seen) > CACHE_WORDS:
                seen.clear()
            judged = [model.judge(t, seen) for t in part.column(at).to_pylist()]
            return [j[0] for j in judged], [j[1] for j in judged]

        return compute

    return map_rows(docs, make, "lang_pred string, score double")


def taught(doc_id: str = "doc_id") -> Column:
    """The ids that languages may be learned from: crc32 modulo 4 is not 2."""
    return folds(doc_id, 4) != 2
