"""Main text of web pages by a linear-chain conditional random field over their leaf blocks.

A page is a row of leaf blocks (``html_blocks``); each is the article's or not. Features of a block are the elements it stands
in and their names, and its text: length, links, punctuation, and the words of short ones. The field scores a row
of labels by its blocks' features and by neighbouring labels, is fitted by maximum likelihood (forward-backward, L2 penalty)
and decoded by Viterbi.

It is fitted on labelled pages of two kinds, made from a bounded sample of the pages at hand: pages of the sample that say
themselves where their article is (one ``article`` or ``main`` element), and texts of the sample laid out anew in varied page
layouts, where each block's label is known (``html_layouts``). So pages without such elements can be told, too.

The sample is ``FIT_PAGES`` pages of at most ``FIT_BYTES`` bytes, first by a hash of their id. Every page is extracted, whole.

Defined cases: null or empty html, and pages without an article, have an empty text; repeated rows have a row each; an empty table
gives no rows (the model is then fitted on layouts of common words); columns other than id, url and html are not read; long pages are
decoded whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import text_bytes
from vitalgauge.llm.html_blocks import Block, leaf_blocks
from vitalgauge.llm.html_layouts import Layouts

FIT_PAGES, FIT_BYTES = 300, 20_000
#: Pages laid out for fitting.
LAYOUTS = 1000
#: Most blocks of a page that is fitted on; longer ones are only extracted.
_FIT_BLOCKS = 150
#: Words of blocks of at most this many words are features.
_SHORT = 10
#: Pages that must have a feature for it to get a weight.
_LEAST_PAGES = 4
_ENDING = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")
_SIZES = (2, 3, 5, 9, 17, 33, 65)


def features(block: Block) -> list[str]:
    """The features of a block; each is there or not."""
    text, words = block.text, block.text.split(" ")
    size = sum(len(words) >= s for s in _SIZES)
    characters = len(text) - len(words) + 1
    share = block.link_characters / max(characters, 1)
    linked = 0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3
    ended = bool(_ENDING.search(text))
    out = ["bias", f"size={size}", f"links={linked}", f"tag={block.tag}", f"of={block.tag},{size},{linked}", f"ended={ended},{size}", *block.place]
    if "©" in text or "(c)" in text:
        out.append("copyright")
    if text[0].islower():
        out.append("lower")
    if sum(c.isdigit() for c in text[:80]) * 4 > min(len(text), 80):
        out.append("digits")
    if len(words) <= _SHORT:
        out += {f"word={w}" for w in (w.strip(".,:;!?()[]\"'").lower() for w in words) if w}
    return out


@dataclass(frozen=True)
class Crf:
    """A field of two labels: 0, and 1 for the article. Scores of features, of first and last labels and of neighbours."""

    weights: dict[str, tuple[float, float]]
    first: np.ndarray
    last: np.ndarray
    follow: np.ndarray

    def scores(self, row: list[list[str]]) -> list[tuple[float, float]]:
        get, none, out = self.weights.get, (0.0, 0.0), []
        for own in row:
            a = b = 0.0
            for f in own:
                x, y = get(f, none)
                a += x
                b += y
            out.append((a, b))
        return out

    def labels(self, row: list[list[str]]) -> list[int]:
        """The most probable row of labels (Viterbi); ties go to 0."""
        if not row:
            return []
        (aa, ab), (ba, bb) = self.follow.tolist()
        scores = self.scores(row)
        a, b = scores[0][0] + self.first[0], scores[0][1] + self.first[1]
        back = []
        for x, y in scores[1:]:
            from_a, from_b = b + ba > a + aa, b + bb > a + ab
            back.append((from_a, from_b))
            a, b = (b + ba if from_a else a + aa) + x, (b + bb if from_b else a + ab) + y
        label = int(b + self.last[1] > a + self.last[0])
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def _sums(x: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the sum of exponentials."""
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_crf(rows: list[list[list[str]]], labels: list[list[int]], penalty: float = 1.0, steps: int = 100, rate: float = 0.15) -> Crf:
    """The field of greatest likelihood, less ``penalty`` / 2 times the sum of squares, by Adam over all rows in each step.

    ``rows``: by page and block the features; ``labels``: by page and block 0 or 1.
    """
    pages = Counter(f for row in rows for f in {f for own in row for f in own})
    known = {f: i for i, f in enumerate(sorted(f for f, n in pages.items() if n >= _LEAST_PAGES))}
    order = sorted(range(len(rows)), key=lambda k: -len(rows[k]))
    rows, labels = [rows[k] for k in order if rows[k]], [labels[k] for k in order if rows[k]]
    sizes = np.array([len(r) for r in rows], np.int64)
    width, n = int(sizes.max(initial=1)), len(rows)
    at = [(k * width + t, known[f]) for k, row in enumerate(rows) for t, own in enumerate(row) for f in own if f in known]
    cell, feature = (np.array(x, np.int64) for x in zip(*at, strict=True)) if at else (np.zeros(0, np.int64),) * 2
    inside = np.arange(width) < sizes[:, None]
    truth = np.zeros((n, width, 2))
    for k, own in enumerate(labels):
        truth[k, np.arange(len(own)), own] = 1
    ends = (np.arange(n), sizes - 1)
    true_follow = np.einsum("kti,ktj->ij", truth[:, :-1], truth[:, 1:])
    theta = np.zeros(2 * len(known) + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return x[8:].reshape(-1, 2), x[:2], x[2:4], x[4:8].reshape(2, 2)

    for step in range(1, steps + 1):
        weights, first, last, follow = split(theta)
        emit = np.stack([np.bincount(cell, weights[feature, j], minlength=n * width) for j in (0, 1)], axis=1).reshape(n, width, 2)
        forward, backward = np.empty_like(emit), np.empty_like(emit)
        forward[:, 0] = emit[:, 0] + first
        for t in range(1, width):
            forward[:, t] = emit[:, t] + _sums(forward[:, t - 1, :, None] + follow, 1)
        for t in range(width - 1, -1, -1):
            after = _sums(follow + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2) if t + 1 < width else last
            backward[:, t] = np.where((sizes - 1 > t)[:, None], after, last)
        total = _sums(forward[ends] + last, 1)
        single = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
        pair = np.exp(
            forward[:, :-1, :, None] + follow + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
        ) * inside[:, 1:, None, None]
        wrong = (truth - single).reshape(-1, 2)
        gradient = np.empty_like(theta)
        of_weights, of_first, of_last, of_follow = split(gradient)
        for j in (0, 1):
            of_weights[:, j] = np.bincount(feature, wrong[cell, j], minlength=len(known))
        of_first[:], of_last[:] = (truth - single)[:, 0].sum(axis=0), (truth - single)[ends].sum(axis=0)
        of_follow[:] = true_follow - pair.sum(axis=(0, 1))
        gradient -= penalty * theta
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        slow = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        theta += slow * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights, first, last, follow = split(theta)
    return Crf({f: tuple(weights[i].tolist()) for f, i in known.items()}, first.copy(), last.copy(), follow.copy())


#: Elements whose text in an article is not the article's.
_NOT_ARTICLE = {f"in={tag}" for tag in ("nav", "aside", "footer", "form", "button", "select")} | {"hidden", "name=comments", "name=comment", "name=ad"}


def own_labels(page: str, blocks: list[Block]) -> list[int] | None:
    """Labels of a page that has one ``article``, or else one ``main`` element; None for others."""
    for tag in ("article", "main"):
        if len(re.findall(rf"<{tag}[\s>]", page, re.I)) == 1:
            return [int(f"in={tag}" in b.place and not b.place & _NOT_ARTICLE) for b in blocks]
    return None


def labelled_pages(pages: Iterable[str], layouts: int = LAYOUTS, seed: int = 0) -> tuple[list[list[Block]], list[list[int]]]:
    """Blocks and labels of the pages that label themselves, and of ``layouts`` pages laid out from all pages' texts."""
    rows, labels, texts, bits = [], [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        own = own_labels(page, blocks)
        if own and len(blocks) <= _FIT_BLOCKS:
            rows.append(blocks)
            labels.append(own)
        for block in blocks:
            (texts if len(block.text) >= 80 else bits).append(block.text)
    made = Layouts(texts, bits, seed)
    for _ in range(layouts):
        page, found = made.page()
        blocks = leaf_blocks(page)
        if len(blocks) == len(found):  # one that lost a block in another would shift the labels
            rows.append(blocks)
            labels.append([int(main) for _, main in found])
    return rows, labels


def fit_extraction(pages: DataFrame, fit_pages: int = FIT_PAGES, fit_bytes: int = FIT_BYTES, layouts: int = LAYOUTS) -> Crf:
    """The field fitted on labelled pages from a sample of ``pages``; at most ``fit_pages`` x ``fit_bytes`` reach the driver."""
    eligible = pages.select(F.col("page_id").cast("long").alias("id"), F.col("html").cast("string").alias("html"))
    eligible = eligible.filter(F.col("id").isNotNull() & (F.octet_length("html") <= fit_bytes))
    mixed = F.xxhash64("id")
    ids = eligible.select("id").distinct().orderBy(mixed, "id").limit(fit_pages)  # bounded, hence the broadcast
    # of rows that share an id the one with the least html
    one = eligible.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("html").alias("html"))
    sample = [r["html"] for r in one.orderBy(mixed, "id").limit(fit_pages).collect()]
    rows, labels = labelled_pages(sample, layouts)
    return fit_crf([[features(b) for b in row] for row in rows], labels)


def main_text(page: str, model: Crf) -> str:
    """The article's blocks of a page, a line each."""
    blocks = leaf_blocks(page)
    chosen = model.labels([features(b) for b in blocks])
    return "\n".join(b.text for b, label in zip(blocks, chosen, strict=True) if label)


def extracted(pages: DataFrame, model: Crf) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url`` and the article's ``text``."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = text_bytes(batch, "html")
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                texts = [main_text(next(pages).decode(), model) for _ in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string")
