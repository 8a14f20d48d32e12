"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are runs of letters, lower-cased. A token's score is its log-odds of standing in a toxic
rather than another document, under Dirichlet priors in proportion to the corpus (Monroe et al.,
"Fightin' Words"), less a drift that makes ordinary text score below zero; tokens whose log-odds
are not significant score the drift alone. A linear scan (Ruzzo and Tompa) finds all maximal
scoring segments of a document. Segment scores become normalised by the extreme-value law of
Karlin and Altschul, its lambda solved from the scores and its K fitted to the documents that are
not toxic; a document's evidence is the best sum statistic over its r best segments, and a
logistic curve fitted to the labelled documents turns ln(1 + evidence) into a score from 0 to 1.

Defined results: a document without tokens (NULL, empty, digits only) has no segment and gets the
score of zero evidence. With no labelled document of either class the model has no token, and
every document scores 0. An id labelled more than once counts as toxic if any label says so;
rows with a NULL id or label teach nothing. Repeated documents are scored each on their own.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import (
    WordHashes,
    fold_rows,
    folds,
    free_name,
    map_rows,
    row_count,
    sampled,
    shingle_set,
)
from hardwood.sinks.scratch import keep

# The classifier is fitted on at most about this many labelled documents (chosen by a hash of
# their ids); it bounds the counts, the token table and what is broadcast. Scoring reads all.
MAX_LABELLED = 30_000
# Prior weight: pseudo-counts are this share of all counted tokens, split as the corpus is.
PRIOR_SHARE = 0.1
# A token's log-odds count when so many standard deviations from zero.
SIGNIFICANT = 2.5
DRIFT = 0.25
_BINS_PER_UNIT = 4

_WORD = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, last position), in one pass.

    ``scores`` has the positions that score anything but ``-drift``, in order.
    """
    # (sum before, sum after, first, last, index of the nearest earlier one that starts lower)
    segments: list[tuple[float, float, int, int, int]] = []
    total, previous = 0.0, -1
    for position, score in scores:
        total -= drift * (position - previous - 1)
        previous = position
        before, total = total, total + score
        if score <= 0:
            continue
        first, j = position, len(segments) - 1
        # Join with the nearest earlier segment that starts lower, while that gains.
        while True:
            while j >= 0 and segments[j][0] >= before:
                j = segments[j][4]
            if j < 0 or segments[j][1] >= total:
                break
            before, _, first, _, lower = segments[j]
            del segments[j:]
            j = lower
        segments.append((before, total, first, position, j))
    return [(after - before, first, last) for before, after, first, last, _ in segments]


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    drift: float = DRIFT
    scale: float = 1.0  # lambda
    space: float = 0.01  # K
    slope: float = 0.0
    middle: float = 0.0

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        words = tokens_of(text)
        get, drift = self.weights.get, self.drift
        hits = [(i, w - drift) for i, w in enumerate(map(get, words)) if w is not None]
        return len(words), maximal_segments(hits, drift)

    def evidence(self, n: int, segments: list[tuple[float, int, int]]) -> float:
        """-ln of the smallest sum-statistic p-value over the r best segments, r = 1, 2, ..."""
        if not segments:
            return 0.0
        best, total = 0.0, 0.0
        ceiling = math.log(max(self.space * n, 1e-9))
        for r, (score, _, _) in enumerate(sorted(segments, reverse=True), 1):
            total += self.scale * score - ceiling
            if total <= 0:
                break
            # ln of total^(r-1) e^-total / (r! (r-1)!), the tail of the sum of r scores
            log_p = (r - 1) * math.log(total) - total - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -log_p)
        return best

    def score(self, evidence: float) -> float:
        if not self.weights:
            return 0.0
        return 1 / (1 + math.exp(min(500.0, self.slope * (self.middle - math.log1p(evidence)))))


def _labelled_texts(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, teaches: Column | None,
    max_labelled: int,
) -> DataFrame:
    """Columns text and toxic of at most about ``max_labelled`` labelled documents."""
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    rows = rows.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if teaches is not None:
        rows = rows.filter(teaches)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = max_labelled / max(1, row_count(rows))
    if share < 1:
        rows = rows.filter(sampled(share, "doc_id"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = texts.join(F.broadcast(rows), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))

    # Copies would make every word of a copied text look telling: one text stays of those that
    # agree in either of two min-wise hashes of their runs of three tokens.
    def sketch():
        hasher = WordHashes()

        def compute(part):
            sets = [shingle_set(hasher.of([w.encode() for w in tokens_of(t)]), 3) for t in part.column(0).to_pylist()]
            return [
                [int((s * multiplier).min()) >> 1 if len(s) else -1 for s in sets]
                for multiplier in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
            ]

        return compute

    known = map_rows(known, sketch, "low long, least long")
    # The text that stays is the same in every run.
    for sketch_of in ("low", "least"):
        row = F.struct(F.xxhash64("text").alias("order"), "text", "toxic", "least")
        known = known.groupBy(sketch_of).agg(F.min(row).alias("row")).select("row.*").withColumn("low", F.lit(0))
    return keep(known.select("text", "toxic"), "labelled")


def _count_tokens(slices):
    """Documents with a token, by class, and tokens by class ('' is the total); one row per token."""
    counts: dict[str, list[int]] = {}
    for part in slices:
        for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            words = set(tokens_of(text))
            total = counts.setdefault("", [0, 0])
            total[toxic] += len(words)
            for word in words:
                counts.setdefault(word, [0, 0])[toxic] += 1
            if len(counts) > 500_000:
                yield list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]
                counts = {}
    yield list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]


def _solve_scale(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive lambda with sum of share * exp(lambda * score) = 1."""
    low, high = 0.0, 1.0
    grown = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while grown(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grown(middle) < 0 else (low, middle)
    return max(high, 0.05)


def _fit_logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve through binned counts of both classes."""
    a, b = 1.0, float(np.average(x, weights=toxic + clean))
    n, prior = toxic + clean, 1e-3
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * (x - b), -50, 50)))
        g = np.array([((toxic - n * p) * (x - b)).sum() - prior * a, ((toxic - n * p) * -a).sum()])
        v = n * p * (1 - p) + 1e-9
        h = np.array([[(v * (x - b) ** 2).sum() + prior, (v * (x - b) * -a).sum()],
                      [(v * (x - b) * -a).sum(), (v * a * a).sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h + 1e-6 * np.eye(2), g), -1, 1)
        a, b = min(8.0, max(0.05, a + step[0])), b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a, b


def fit(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", teaches: Column | None = None, max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """Learn from the labelled documents for which ``teaches`` (on ``doc_id``) holds."""
    known = _labelled_texts(docs, labels, doc_id, text, label, teaches, max_labelled)
    counts = fold_rows(known, _count_tokens, "token string, toxic long, clean long")
    counts = counts.groupBy("token").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    # A token in fewer than four documents is never significant, so it need not leave Spark.
    found = {r.token: (r.t, r.c) for r in counts.filter("t >= 4 OR c >= 4 OR token = ''").collect()}
    n_t, n_c = found.pop("", (0, 0))
    model = ToxicityModel()
    if not n_t or not n_c or not found:
        return model
    words = sorted(found)
    t, c = np.array([found[w] for w in words], float).T
    prior = PRIOR_SHARE * (n_t + n_c)
    alpha = prior * (t + c) / (n_t + n_c)
    odds = np.log((t + alpha) / (n_t + prior - t - alpha)) - np.log((c + alpha) / (n_c + prior - c - alpha))
    told = np.abs(odds) >= SIGNIFICANT * np.sqrt(1 / (t + alpha) + 1 / (c + alpha))
    model.weights = {w: float(o) for w, o, k in zip(words, odds, told, strict=True) if k}
    if not any(w > DRIFT for w in model.weights.values()):
        model.weights = {}
        return model
    share = ((c + alpha) / (n_c + prior))[told]
    scores = np.append(odds[told] - DRIFT, -DRIFT)
    model.scale = _solve_scale(scores, np.append(share, max(0.0, 1 - share.sum())))

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(slices):
        """K's sums over clean documents, then a histogram of evidence by class."""
        bins: dict[tuple[int, bool], list[float]] = {}
        for part in slices:
            for text_, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                n, segments = shared.value.segments(text_)
                if not toxic:
                    top = max((s for s, _, _ in segments), default=0.0)
                    seen = bins.setdefault((-1, False), [0.0, 0.0])
                    seen[0] += 1
                    seen[1] += n * math.exp(-shared.value.scale * top)
                key = (int(shared.value.evidence(n, segments) * _BINS_PER_UNIT), toxic)
                bins.setdefault(key, [0.0, 0.0])[0] += 1
        yield [k[0] for k in bins], [k[1] for k in bins], [v[0] for v in bins.values()], [v[1] for v in bins.values()]

    def histogram():
        out = fold_rows(known, evidence, "bin int, toxic boolean, docs double, space double")
        return out.groupBy("bin", "toxic").agg(F.sum("docs").alias("docs"), F.sum("space").alias("space")).collect()

    clean = next((r for r in histogram() if r.bin == -1), None)
    model.space = clean.docs / clean.space if clean and clean.space else model.space
    shared.unpersist()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bins = [r for r in histogram() if r.bin >= 0]
    x = np.array(sorted({r.bin for r in bins}), float)
    by = {(r.bin, r.toxic): r.docs for r in bins}
    model.slope, model.middle = _fit_logistic(
        np.log1p(x / _BINS_PER_UNIT),
        np.array([by.get((int(b), True), 0.0) for b in x]),
        np.array([by.get((int(b), False), 0.0) for b in x]),
    )
    shared.unpersist()
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Append score, predicted and passages (token positions and scores) to every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def make():
        model = shared.value

        def compute(part):
            scores, found = [], []
            for value in part.column(at).to_pylist():
                n, segments = model.segments(value)
                scores.append(model.score(model.evidence(n, segments)))
                found.append([{"first_token": a, "last_token": b, "passage_score": s} for s, a, b in segments])
            return scores, [int(s >= 0.5) for s in scores], found

        return compute

    passages = "array<struct<first_token:int,last_token:int,passage_score:double>>"
    return map_rows(docs, make, f"score double, predicted int, passages {passages}")


def without_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, with their own columns only."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def make():
        model = shared.value

        def compute(part):
            scores = (model.score(model.evidence(*model.segments(t))) for t in part.column(at).to_pylist())
            return [[s >= 0.5 for s in scores]]

        return compute

    toxic = free_name(docs, "toxic")
    return map_rows(docs, make, f"`{toxic}` boolean").filter(~F.col(toxic)).drop(toxic)


def taught(doc_id: str = "doc_id") -> Column:
    """The ids that labels may be learned from: crc32 modulo 5 is not 0."""
    return folds(doc_id, 5) != 0
