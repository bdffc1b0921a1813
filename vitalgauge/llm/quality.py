"""Quality by compression: which of two dictionaries shortens a text more.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts labelled bad. A
text is compressed with each; the difference of the two sizes, divided by the text's size, tells which it
resembles. A logistic calibration fitted on further labelled texts turns that into the chance that the label is 1. What a
difference means depends on the text's length (in short ones it is mostly noise, which falls with the root of the length) and
on how far the text can be compressed at all, so the calibration sees these next to it.

Fitting reads a bounded sample of the labelled rows, taken by a hash of the id: ``DICTIONARY_ROWS`` texts of
each label for the dictionaries and ``CALIBRATION_ROWS`` more of each for the calibration, of at most
``FIT_BYTES`` bytes each. Scoring compresses every text whole, one at a time, in a single pass without a shuffle.

Defined cases: a null text is an empty one, whose difference is 0 and that is scored by the calibration; labels other than 0 and 1 and labels
of unknown documents are not learned from; if no bad text is known every score is 1, else if no good one is
known every score is 0; repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import text_bytes
from vitalgauge.llm.samples import labelled_sample

DICTIONARY_ROWS = 1200
CALIBRATION_ROWS = 2500
DICTIONARY_BYTES = 112_640
LEVEL = 3
KEEP_FROM = 0.7


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries, and the calibration: ``weights`` of the features less ``center`` and over ``scale``, and last the intercept."""

    good: bytes
    bad: bytes
    center: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    constant: float | None = None

    def features(self, texts: Iterable[bytes]) -> np.ndarray:
        """Per text: bytes the good dictionary saves over the bad one per byte and per root of bytes, log of length, rate."""
        good, bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(d)) for d in (self.good, self.bad))
        sizes = np.array([(len(good.compress(t)), len(bad.compress(t)), max(len(t), 1)) for t in texts], float).reshape(-1, 3)
        saved, length = sizes[:, 1] - sizes[:, 0], sizes[:, 2]
        return np.c_[saved / length, saved / np.sqrt(length), np.log(length), sizes[:, 0] / length]

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.array([self.constant for _ in texts], float)
        found = (self.features(texts) - np.array(self.center)) / np.array(self.scale)
        return _logistic(found @ np.array(self.weights[:-1]) + self.weights[-1])


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    found = zstandard.ZstdCompressionDict(data)
    found.precompute_compress(level=LEVEL)
    return found


def _trained(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY_BYTES].ljust(8)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic_fit(features: np.ndarray, labels: np.ndarray, share: np.ndarray, pull: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression of rows that count ``share`` times, by Newton steps
    with a slight pull to 0."""
    design = np.c_[features, np.ones(len(features))]
    weights = np.zeros(design.shape[1])
    for _ in range(steps):
        p = _logistic(design @ weights)
        hessian = (design * (share * p * (1 - p))[:, None]).T @ design + pull * np.eye(len(weights))
        step = np.linalg.solve(hessian, design.T @ (share * (p - labels)) + pull * weights)
        weights -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """A model of ``label`` from the documents that ``labels`` (``doc_id`` and the label) marks 0 or 1."""
    sample = labelled_sample(docs, labels, label, DICTIONARY_ROWS + CALIBRATION_ROWS)
    both = list(zip(sample.texts, sample.labels, strict=True))
    good, bad = ([t for t, y in both if y == v] for v in (1, 0))
    if not bad or not good:
        return QualityModel(b"", b"", constant=0.0 if bad else 1.0)
    in_good, in_bad = (min(DICTIONARY_ROWS, (len(x) + 1) // 2) for x in (good, bad))
    model = QualityModel(_trained(good[:in_good]), _trained(bad[:in_bad]))
    rest = [(t, 1.0) for t in good[in_good:]] + [(t, 0.0) for t in bad[in_bad:]]
    if len({y for _, y in rest}) < 2:
        rest = [(t, float(y)) for t, y in both]
    features, marks = model.features(t for t, _ in rest), np.array([y for _, y in rest])
    center, scale = features.mean(0), features.std(0) + 1e-9
    # the sample has as many rows of each label as it can; the scores are to hold for the labels as common as they are
    common = np.where(marks == 1, sample.known[1] / max(marks.sum(), 1), sample.known[0] / max((1 - marks).sum(), 1))
    weights = logistic_fit((features - center) / scale, marks, common / common.mean())
    return replace(model, center=tuple(center), scale=tuple(scale), weights=tuple(weights))


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and ``score`` of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(text_bytes(batch, "text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def predicted(score: Column, keep_from: float = KEEP_FROM) -> Column:
    return (score >= keep_from).cast("int")


def good_documents(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``keep_from``."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(text_bytes(batch, "text")) >= keep_from))

    return docs.mapInArrow(kept, docs.schema)
