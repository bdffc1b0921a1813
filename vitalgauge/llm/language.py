"""Language identification with string kernels.

Two texts are as alike as the n-grams of one to three characters that both contain: the blended-spectrum presence
kernel, normalised by the numbers of n-grams. Nyström: the kernel is taken against a few landmark texts only,
whose own kernel matrix whitens it; in that space one ridge regression per language separates it from the rest.

A decision is linear in the kernel values, and those are a product of presence vectors; so the landmarks' n-grams and
the regressions multiply into one weight per n-gram and language. Where that table would have more than ``TABLE`` numbers,
as with very many languages, the kernel values are counted from lists of the landmarks that hold an n-gram. The values are the same.

Characters are lower-cased, and no two count as one: three of 21 bits fit in a 64-bit number, so that is an n-gram's
number in any script. What is kept are the landmarks' n-grams, sorted.

Fitting reads a bounded sample taken by a hash of the id: about ``FIT_ROWS`` texts of at most ``FIT_BYTES`` bytes,
the same number, two at least, for each value of ``lang``, of which ``LANDMARKS`` in all, one at least for each, serve as landmarks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be
learned; an only language gets score 1; ties go to the first language in alphabetical order; repeated rows are predicted
alike; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitalgauge.llm.common import text_bytes

FIT_ROWS = 2400
FIT_BYTES = 20_000
LANDMARKS = 240
ORDERS = 3
RIDGE = 1e-3
UNKNOWN = "und"
#: Texts decided at a time.
BATCH = 64
#: Most numbers of a table of weights.
TABLE = 1 << 24
#: A character's bits in an n-gram's number.
_BITS = 21
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Alphabet:
    """The sample's ``characters``. N-grams of all others have numbers too: the digits are a character's Unicode number + 1."""

    characters: str

    def present(self, text: str) -> np.ndarray:
        """The n-grams of a text, each once, ascending."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        found, gram = [codes], codes
        for n in range(1, ORDERS):
            gram = (gram[:-1] << _BITS) + codes[n:]
            found.append(gram)
        return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Landmarks:
    """The landmarks' ``grams``, sorted; those that hold gram i are ``holders[starts[i] : starts[i + 1]]``."""

    grams: np.ndarray
    starts: np.ndarray
    holders: np.ndarray
    #: Roots of the landmarks' numbers of n-grams.
    norms: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Landmarks:
        every = np.concatenate([np.zeros(0, np.int64), *texts])
        holders = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
        order = np.argsort(every, kind="stable")
        grams, starts = np.unique(every[order], return_index=True)
        return cls(grams, np.r_[starts, len(every)], holders[order], np.sqrt([len(t) for t in texts]))

    def rows(self, found: np.ndarray) -> np.ndarray:
        """Where those of the n-grams are that a landmark holds."""
        if not len(self.grams):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.grams, found).clip(max=len(self.grams) - 1)
        return at[self.grams[at] == found]

    def kernel(self, found: np.ndarray) -> np.ndarray:
        """A text's kernel values."""
        rows = self.rows(found)
        low, n = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        every = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.holders[every], minlength=len(self.norms)) / (self.norms * max(len(found), 1) ** 0.5)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    alphabet: Alphabet
    landmarks: Landmarks
    #: By landmark and language.
    ridge: np.ndarray
    offsets: np.ndarray
    sharpness: float

    @property
    def grams(self) -> np.ndarray:
        return self.landmarks.grams

    @functools.cached_property
    def weights(self) -> np.ndarray:
        """By n-gram of the landmarks and language."""
        table = np.zeros((len(self.grams), len(self.languages)))
        for k, column in enumerate((self.ridge / self.landmarks.norms[:, None]).T if len(self.grams) else ()):
            table[:, k] = np.add.reduceat(column[self.landmarks.holders], self.landmarks.starts[:-1])
        return table

    def decisions(self, texts: Sequence[str]) -> np.ndarray:
        """Per text and language, the ridge regression's value."""
        found = [self.alphabet.present(text) for text in texts]
        scale = np.maximum([len(f) for f in found], 1) ** -0.5
        if len(self.grams) * len(self.languages) <= TABLE:
            values = _product([self.landmarks.rows(f) for f in found], self.weights) * scale[:, None]
        else:
            values = np.array([self.landmarks.kernel(f) for f in found]).reshape(len(texts), -1) @ self.ridge
        return values + self.offsets

    def predict(self, texts: Sequence[str]) -> tuple[list[str], list[float]]:
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if self.languages and _LETTER.search(t)]
        for low in range(0, len(told), BATCH):
            some = told[low : low + BATCH]
            chances = _softmax(self.decisions([texts[i] for i in some]) * self.sharpness)
            for i, best, row in zip(some, chances.argmax(1), chances, strict=True):
                languages[i], scores[i] = self.languages[best], float(row[best])
        return languages, scores


def _product(present: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The sparse matrix that has ones in each row's ``present`` columns, times ``weights``."""
    out, low = np.zeros((len(present), weights.shape[1])), 0
    sizes = np.array([len(p) for p in present], np.int64)
    while low < len(present):  # some rows at a time, so that their columns stay few
        high = max(low + 1, int(np.searchsorted(np.cumsum(sizes[low:]), _COLUMNS, "right")) + low)
        columns, of_row = np.concatenate(present[low:high]), np.repeat(np.arange(high - low), sizes[low:high])
        for k in range(weights.shape[1]):
            out[low:high, k] = np.bincount(of_row, weights[columns, k], minlength=high - low)
        low = high
    return out


#: Ones of a sparse matrix multiplied at a time.
_COLUMNS = 1 << 20


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def language_sample(docs: DataFrame, rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> list[tuple[str, str]]:
    """Language and text of a bounded sample, the same number for each language, in the order of a hash of the id."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counts = [(r["lang"], r["count"]) for r in known.groupBy("lang").count().collect()]
    if not counts:
        return []
    each = max(2, rows // len(counts))
    # a first cut by the hash alone, of about twice what is wanted, so that few rows meet by language
    mixed = F.xxhash64(F.col("doc_id"), F.lit("language"))
    cuts = [(lang, int(2**62 * min(1.0, (2 * each + 20) / n))) for lang, n in counts]
    cut = F.broadcast(docs.sparkSession.createDataFrame(cuts, "lang string, cut long"))  # a row per language
    thinned = known.join(cut, "lang").filter(F.shiftrightunsigned(mixed, 2) < F.col("cut")).filter(F.octet_length("text") <= fit_bytes)
    order = Window.partitionBy("lang").orderBy("mixed", "doc_id", "text")
    chosen = thinned.withColumn("mixed", mixed).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    return [(r["lang"], r["text"]) for r in chosen.orderBy("place", "lang").select("lang", "text").collect()]


def fit_language(docs: DataFrame, rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> LanguageModel:
    """A model from ``text`` and ``lang`` of ``docs``."""
    sample = [(lang, text) for lang, text in language_sample(docs, rows) if _LETTER.search(text)]
    languages = tuple(sorted({lang for lang, _ in sample}))
    alphabet = Alphabet("".join(sorted({c for _, text in sample for c in text.lower()})))
    if len(languages) < 2:
        none = np.zeros((0, len(languages)))
        return LanguageModel(languages, alphabet, Landmarks.of([]), none, np.zeros(len(languages)), 1.0)

    # the sample comes language by language in turn, so its first texts are landmarks of all languages alike
    first = {lang: i for i, (lang, _) in reversed(list(enumerate(sample)))}
    sample.sort(key=lambda row: first.pop(row[0], len(sample)))  # one of each language before all others
    marks = Landmarks.of([alphabet.present(text) for _, text in sample[: max(landmarks, len(languages))]])
    kernel = np.array([marks.kernel(alphabet.present(text)) for _, text in sample])
    values, vectors = np.linalg.eigh(kernel[: len(marks.norms)])
    sound = values > 1e-6 * values.max()
    whitening = vectors[:, sound] / np.sqrt(values[sound])
    mapped = kernel @ whitening
    wanted = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in sample])
    center, offsets = mapped.mean(0), wanted.mean(0)
    shifted = mapped - center
    gram = shifted.T @ shifted + RIDGE * len(sample) * np.eye(shifted.shape[1])
    ridge = np.linalg.solve(gram, shifted.T @ (wanted - offsets))
    offsets = offsets - center @ ridge
    decided, truth = mapped @ ridge + offsets, wanted.argmax(1)
    loss = {s: -np.log(_softmax(decided * s)[np.arange(len(truth)), truth] + 1e-12).mean() for s in (1, 2, 3, 4, 6, 8, 12)}
    return LanguageModel(languages, alphabet, marks, whitening @ ridge, offsets, float(min(loss, key=loss.get)))


def predicted_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document, from its text alone."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch, "text")
            for low in range(0, batch.num_rows, 1024):
                ids = batch.column(0).slice(low, 1024)
                languages, scores = model.predict([next(texts).decode() for _ in range(len(ids))])
                yield pa.RecordBatch.from_arrays([ids, pa.array(languages), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(predicted, "doc_id long, lang_pred string, score double")
