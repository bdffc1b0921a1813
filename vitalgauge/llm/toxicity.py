"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

A document's grade is 0 (none) to ``len(GRADE_WORDS) + 1``. The chance that it is at most k is logistic(cut_k - w * x): one
weight vector for all grades, and ordered cuts. The expected severity is the sum of the chances to be above each k.

Features: words, and word beginnings of 4 to 6 letters (so that unseen endings of a known stem count), in A-Z lower
case; x is log(1 + occurrences). Used are those that tell toxic texts by their log-likelihood ratio, in however few
texts beyond ``LEAST_TEXTS``; so most words of a text have no feature at all. If there are more than ``FEATURES``, each toxic text's best ones
come first, so that the texts of a rare language keep theirs.

Copies would make all their words look telling. So each text of the sample is fitted on, but counts 1/n if n texts of its label,
itself included, are like it in their words as a whole; words that many texts share, such as a header, hardly count there.

Labels tell only whether a text is toxic. Their grades: a toxic text's evidence is the number of its words that have a used
feature; the grades from 1 on are cut at ``GRADE_WORDS``.

Fitting reads a bounded sample of labelled rows (``FIT_ROWS`` of each label); scoring reads each text whole, in one pass
without a shuffle. Defined cases: a null or empty text has no feature; without labels of both kinds every severity is 0;
repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import text_bytes
from vitalgauge.llm.samples import labelled_sample

FIT_ROWS = 3000
FEATURES = 1000
STEMS = (4, 5, 6)
#: A feature is used from this many toxic texts of the sample on, copies counting as one.
LEAST_TEXTS = 3
#: Texts are copies of each other from this cosine of their words' weights on.
ALIKE = 0.5
#: Numbers a text's words are hashed into for that.
SKETCH = 2048
#: Evident words from which a toxic text has grade 2, and grade 3.
GRADE_WORDS = (4, 16)
#: A feature's share of the toxic texts is at least this part of its shares of toxic and of clean texts.
EVIDENT = 0.9
#: Least log-likelihood ratio of a feature.
LEAST_RATIO = 5.0
TOXIC_FROM = 0.2
PULL = 0.5
#: Words a worker remembers the features of.
KEPT = 300_000
_EDGE = b" \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>|*#$%&-_/\\"


def tokens(text: bytes) -> list[bytes]:
    """Words in A-Z lower case without signs around them."""
    return [w for w in (x.strip(_EDGE) for x in text.lower().split()) if w]


def word_features(word: bytes) -> list[str]:
    letters = word.decode(errors="replace")
    return [letters, *(f"{letters[:n]}*" for n in STEMS if len(letters) >= n)]


@dataclass(frozen=True)
class ToxicityModel:
    """``numbers``: the used features; ``cuts`` ascend."""

    numbers: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray

    @functools.cached_property
    def _known(self) -> dict[bytes, tuple[int, ...]]:
        return {}

    def counts(self, text: bytes) -> Counter:
        """Occurrences of each used feature."""
        known, numbers, found = self._known, self.numbers, Counter()
        if len(known) > KEPT:
            known.clear()
        for word in tokens(text):
            ids = known.get(word)
            if ids is None:
                ids = known[word] = tuple(numbers[f] for f in word_features(word) if f in numbers)
            if ids:
                found.update(ids)
        return found

    def above(self, text: bytes) -> np.ndarray:
        """The chances that the grade is above 0, above 1 and so on."""
        found = self.counts(text)
        x = sum(self.weights[i] * math.log1p(n) for i, n in found.items())
        return 1 - _logistic(self.cuts - x)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _ratio(a: float, b: float, toxic: float, clean: float) -> float:
    """Log-likelihood ratio of a feature in ``a`` of the toxic and ``b`` of the clean texts; below 0 if it speaks for clean."""
    total, found = 0.0, a + b
    for n, expected in (
        (a, toxic * found / (toxic + clean)),
        (b, clean * found / (toxic + clean)),
        (toxic - a, toxic * (toxic + clean - found) / (toxic + clean)),
        (clean - b, clean * (toxic + clean - found) / (toxic + clean)),
    ):
        total += n * math.log(n / expected) if n > 1e-9 else 0.0
    return total if a * clean > b * toxic else -total


def select_features(texts: list[bytes], toxic: list[int], counted: np.ndarray) -> list[str]:
    """The features to use, the most telling first; text i counts ``counted[i]`` times."""
    found, n = {0: Counter(), 1: Counter()}, [0.0, 0.0]
    for text, y, k in zip(texts, toxic, counted.tolist(), strict=True):
        n[y] += k
        for f in {f for w in set(tokens(text)) for f in word_features(w)}:
            found[y][f] += k
    told = {}
    for f, a in found[1].items():
        share, other = a / n[1], found[0][f] / n[0]
        if a > LEAST_TEXTS - 1e-6 and share / (share + other) >= EVIDENT:
            told[f] = _ratio(a, found[0][f], n[1], n[0])
    used = sorted((f for f in told if told[f] >= LEAST_RATIO), key=lambda f: (-told[f], f))
    if len(used) > FEATURES:
        order, place = {f: i for i, f in enumerate(used)}, {}
        for text, y in zip(texts, toxic, strict=True):
            own = {order[f] for w in set(tokens(text)) for f in word_features(w) if f in order} if y else ()
            for k, i in enumerate(sorted(own)):
                place[i] = min(k, place.get(i, k))
        used = [used[i] for i in sorted(sorted(place, key=lambda i: (place[i], i))[:FEATURES])]
    return used


def severity_grades(texts: list[bytes], toxic: list[int], used: set[str]) -> np.ndarray:
    grades = np.zeros(len(texts), int)
    for i, (text, y) in enumerate(zip(texts, toxic, strict=True)):
        if y:
            evident = sum(any(f in used for f in word_features(w)) for w in tokens(text))
            grades[i] = 1 + sum(evident >= n for n in GRADE_WORDS)
    return grades


def ordinal_fit(x: np.ndarray, grades: np.ndarray, share: np.ndarray, levels: int, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending cuts that maximise the likelihood of the grades, with a pull of the weights to 0.

    Fisher scoring: each step solves with the expected curvature, and is halved until it makes the fit better and leaves the
    cuts in order. A row's chance of grade c is F(c) - F(c - 1), where
    F(k) = logistic(cut_k - w * x) and F is 0 before the first and 1 after the last cut. Rows count ``share`` times.
    """
    n, features = x.shape
    weights, rows = np.zeros(features), np.arange(n)
    present = np.cumsum([(share * (grades == k)).sum() + 0.5 for k in range(levels)])
    cuts = np.log(present[:-1] / (present[-1] - present[:-1]))

    def fit(weights: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, float]:
        edges = np.c_[np.zeros(n), _logistic(cuts[None, :] - (x @ weights)[:, None]), np.ones(n)]
        chance = np.maximum(edges[rows, grades + 1] - edges[rows, grades], 1e-300)
        return edges, float(share @ np.log(chance) - PULL / 2 * weights @ weights)

    edges, best = fit(weights, cuts)
    for _ in range(steps):
        slopes = edges * (1 - edges)
        chances, bends = np.maximum(np.diff(edges), 1e-12), np.diff(slopes)
        # how log-likelihood and its curvature change with w * x and with each cut
        by_score = -bends[rows, grades] / chances[rows, grades]
        by_cut = np.zeros((n, levels + 1))
        by_cut[rows, grades + 1] += slopes[rows, grades + 1] / chances[rows, grades]
        by_cut[rows, grades] -= slopes[rows, grades] / chances[rows, grades]
        gradient = np.r_[x.T @ (share * by_score) - PULL * weights, (share[:, None] * by_cut).sum(0)[1:-1]]
        curve = np.zeros((features + levels - 1,) * 2)
        curve[:features, :features] = x.T @ ((share * (bends**2 / chances).sum(1))[:, None] * x) + PULL * np.eye(features)
        for k in range(1, levels):
            s = slopes[:, k]
            mixed = -s * (bends[:, k - 1] / chances[:, k - 1] - bends[:, k] / chances[:, k])
            curve[:features, features + k - 1] = curve[features + k - 1, :features] = x.T @ (share * mixed)
            curve[features + k - 1, features + k - 1] = (share * s * s * (1 / chances[:, k - 1] + 1 / chances[:, k])).sum() + 1e-6
            if k + 1 < levels:
                both = -(share * s * slopes[:, k + 1] / chances[:, k]).sum()
                curve[features + k - 1, features + k] = curve[features + k, features + k - 1] = both
        step = np.linalg.solve(curve, gradient)
        before = best
        for _ in range(40):
            tried = weights + step[:features], cuts + step[features:]
            if (np.diff(tried[1]) > 1e-3).all() and (found := fit(*tried))[1] > best:
                (weights, cuts), (edges, best) = tried, found
                break
            step = step / 2
        if best - before < 1e-7 * abs(before):
            break
    return weights, cuts


def copy_weights(texts: list[bytes], labels: list[int]) -> np.ndarray:
    """For each text, 1 / the number of texts of its label that are like it, itself included.

    Likeness is the cosine of the sets of words, rare ones weighing more, in signed hashes.
    """
    counted = np.ones(len(texts))
    for y in set(labels):
        rows = [i for i, label in enumerate(labels) if label == y]
        holding = Counter(w for i in rows for w in set(tokens(texts[i])))
        sketches = np.zeros((len(rows), SKETCH), np.float32)
        for sketch, i in zip(sketches, rows, strict=True):
            own = set(tokens(texts[i])) or {b""}
            codes = np.array([zlib.crc32(w) for w in own])
            weights = np.array([math.log1p(len(rows) / holding.get(w, len(rows))) for w in own])
            sketch[:] = np.bincount(codes % SKETCH, np.where(codes >> 16 & 1, weights, -weights), SKETCH)
            sketch /= max(np.linalg.norm(sketch), 1e-9)
        for low in range(0, len(rows), 500):
            like = (sketches[low : low + 500] @ sketches.T >= ALIKE).sum(1)
            counted[rows[low : low + 500]] = 1 / np.maximum(like, 1)
    return counted


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    """A model from the documents that ``labels`` (``doc_id`` and the label) marks 0 or 1."""
    sample, levels = labelled_sample(docs, labels, label, FIT_ROWS), len(GRADE_WORDS) + 2
    if len(set(sample.labels)) < 2:
        return ToxicityModel({}, np.zeros(0), np.full(levels - 1, 500.0))
    texts, labels = sample.texts, sample.labels
    counted = copy_weights(texts, labels)
    used = select_features(texts, labels, counted)
    grades = severity_grades(texts, labels, set(used))
    blank = ToxicityModel({f: i for i, f in enumerate(used)}, np.zeros(len(used)), np.zeros(levels - 1))
    x = np.zeros((len(grades), len(used)))
    for row, text in zip(x, texts, strict=True):
        for i, n in blank.counts(text).items():
            row[i] = math.log1p(n)
    toxic = np.array(labels)
    common = counted * np.where(toxic == 1, sample.known[1] / counted[toxic == 1].sum(), sample.known[0] / counted[toxic == 0].sum())
    weights, cuts = ordinal_fit(x, grades, common / common.mean(), levels)
    return ToxicityModel(blank.numbers, weights, cuts)


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per document: ``doc_id``, ``severity`` (the expected grade), ``p_toxic``, ``grade`` (the likeliest) and ``toxic`` (0 or 1)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = np.array([model.above(t) for t in text_bytes(batch, "text")]).reshape(batch.num_rows, -1)
            chances = -np.diff(above, axis=1, prepend=1.0, append=0.0)
            columns = [above.sum(1), above[:, 0], chances.argmax(1).astype(np.int32), (above[:, 0] >= TOXIC_FROM).astype(np.int32)]
            names = ["doc_id", "severity", "p_toxic", "grade", "toxic"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scored, "doc_id long, severity double, p_toxic double, grade int, toxic int")
