"""Periodic runs of words in whole texts, by uniting suffix classes in the order of falling LCP.

A run is a stretch of words with smallest period ``p`` (words ``p`` apart are the same), at least
``exponent`` periods and ``shortest`` words long, that no neighbouring word extends.

Suffixes of a text that begin with the same ``l`` words form a class. Kruskal's algorithm over the neighbours in
suffix order, greatest LCP first, makes these classes grow from single suffixes: the edge of LCP ``l`` unites two
classes of which any two members agree in exactly ``l`` words. A class is an ordered set of positions, and the smaller
set goes into the larger one. If positions ``i`` and ``i + p`` become neighbours at LCP ``l``, then ``p`` is the
smallest period of the ``p + l`` words from ``i`` on (a smaller one would have put a position of the class between them), and these
words are a run unless the word before them extends it. Every run is found so, once: at its start and its start
plus its period.

A run needs an LCP of at least ``min over p of max(shortest - p, (exponent - 1) * p)``; suffixes that agree in fewer words with
all others of their text are never united. So text without repeated phrases costs little more than the sorting of its words.
Suffixes are sorted by prefix doubling with numpy, many texts at a time; texts are never compared with each other, and each is
handled whole by one task (its words, in memory, at about 100 bytes each).

Defined cases: a null text is an empty one; an empty text has no runs and collapses to an empty text; repeated rows
have a row each; an empty table gives no rows; columns other than id and text are not read; a null id stays null.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import text_bytes

#: Words a task looks through at a time (more if one text has more).
CHUNK_WORDS = 400_000
#: Positions of a set kept in one list.
_BLOCK = 1024
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


class Positions:
    """An ordered set of numbers, in sorted blocks of bounded size, so that adding to a large set stays cheap."""

    def __init__(self, values: list[int]):
        half = _BLOCK // 2
        self.blocks = [values[i : i + half] for i in range(0, len(values), half)]
        self.least = [b[0] for b in self.blocks]
        self.size = len(values)

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, x: int) -> tuple[int, int]:
        """The members before and after ``x``, which is none itself; -1 where there is none."""
        at = max(bisect_left(self.least, x) - 1, 0)
        block = self.blocks[at]
        i = bisect_left(block, x)
        after = block[i] if i < len(block) else self.least[at + 1] if at + 1 < len(self.blocks) else -1
        return block[i - 1] if i else -1, after

    def add(self, x: int) -> None:
        at = max(bisect_left(self.least, x) - 1, 0)
        block = self.blocks[at]
        insort(block, x)
        self.least[at] = block[0]
        self.size += 1
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks[at : at + 1] = [block[:half], block[half:]]
            self.least.insert(at + 1, block[half])


def _united(large, small, lcp: int, shortest: int, exponent: int, seeds: list[tuple[int, int, int]]):
    """The union of two sets; pairs of their members that become neighbours, close enough for a run, go to ``seeds``."""
    if len(small) > len(large):
        large, small = small, large
    members = list(small)
    farthest, last = lcp // (exponent - 1), len(members) - 1
    blocks = isinstance(large, Positions)
    for k, x in enumerate(members):
        if blocks:
            before, after = large.around(x)
        else:
            i = bisect_left(large, x)
            before, after = large[i - 1] if i else -1, large[i] if i < len(large) else -1
        if 0 <= before and x - before <= farthest and x - before + lcp >= shortest and not (k and members[k - 1] > before):
            seeds.append((before, x, lcp))
        if 0 <= after and after - x <= farthest and after - x + lcp >= shortest and not (k < last and members[k + 1] < after):
            seeds.append((x, after, lcp))
    if blocks:
        for x in members:
            large.add(x)
    elif len(members) == 1:
        insort(large, members[0])
    else:
        large += members
        large.sort()  # two ascending stretches, which are merged
    return Positions(large) if not blocks and len(large) > 2 * _BLOCK else large


def least_lcp(shortest: int, exponent: int) -> int:
    """The least LCP of a run's first two periods."""
    return min(max(shortest - p, (exponent - 1) * p) for p in range(1, max(shortest, 1) + 1))


def repeated_suffixes(words: np.ndarray, text: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order within one text that agree in ``least`` words or more: two arrays of positions and their LCPs.

    By position, ``words`` has the word's number, ``text`` the text's and ``ends`` where that text ends.
    """
    n = len(words)
    keys, rank, places = text * (int(words.max(initial=0)) + 1) + words, np.zeros(n, np.int64), np.arange(n)
    levels, length, wanted = [], 0, places
    while True:
        # places hold whole groups of equal beginnings; each group's rank is the number of suffixes before it
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        sizes = np.diff(first, append=len(keys))
        if length:
            group = np.flatnonzero(np.diff(rank[places], prepend=-1))
            offset = first - np.repeat(group, np.diff(group, append=len(places)))[first]
            rank[places] += np.repeat(offset, sizes)
        else:
            rank[places] = np.repeat(first, sizes)
        length = 2 * length or 1
        places = places[np.repeat(sizes > 1, sizes)]
        if length <= least:
            wanted = places
        if not len(places):
            break
        levels.append((length, rank.astype(np.int32 if n < 1 << 31 else np.int64)))
        follow = places + length
        second = np.where(follow < ends[places], rank[np.minimum(follow, n - 1)] + 1, 0)
        keys = rank[places] * (n + 1) + second
    wanted = wanted[np.argsort(rank[wanted], kind="stable")]
    a, b = wanted[:-1], wanted[1:]
    same = text[a] == text[b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for size, ranks in reversed(levels):
        inside = (a + lcp < ends[a]) & (b + lcp < ends[b])
        lcp += size * (inside & (ranks[np.minimum(a + lcp, n - 1)] == ranks[np.minimum(b + lcp, n - 1)]))
    enough = lcp >= least
    return a[enough], b[enough], lcp[enough]


def find_runs(words: np.ndarray, sizes: np.ndarray, shortest: int = 6, exponent: int = 4) -> np.ndarray:
    """The runs of consecutive texts, a row each: text, start in it, length and period; in this order but for the length.

    ``words`` has the word numbers of all texts, ``sizes`` the texts' numbers of words.
    """
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    a, b, lcp = repeated_suffixes(words, text, (starts + sizes)[text], least_lcp(shortest, exponent))
    if not len(a):
        return np.zeros((0, 4), np.int64)
    # Kruskal: the neighbours' edges are a path, so a set's edges so far lie side by side
    order = np.argsort(-lcp, kind="stable")
    positions, numbers = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(positions)))
    sets: dict[int, list[int] | Positions] = {}
    seeds: list[tuple[int, int, int]] = []
    place = positions.tolist()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y, agree in zip(numbers[: len(a)][order].tolist(), numbers[len(a) :][order].tolist(), lcp[order].tolist(), strict=True):
        x, y = root(x), root(y)
        left, right = sets.pop(x, None) or [place[x]], sets.pop(y, None) or [place[y]]
        if len(left) < len(right):
            x, y = y, x
        parent[y] = x
        sets[x] = _united(left, right, agree, shortest, exponent, seeds)
    if not seeds:
        return np.zeros((0, 4), np.int64)
    i, j, agree = np.array(seeds, np.int64).T
    begins = (i == starts[text[i]]) | (words[np.maximum(i, 1) - 1] != words[j - 1])
    i, j, agree = i[begins], j[begins], agree[begins]
    found = np.stack([text[i], i - starts[text[i]], j - i + agree, j - i], axis=1)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def periodic_runs(docs: DataFrame, shortest: int = 6, exponent: int = 4, prepare: Prepare | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (by start, then period; starts are word numbers) and
    ``collapsed``: the words that no run repeats, joined by spaces; of each run its first period stays.

    ``prepare`` may change the words of a text, given its id, before the search. Words are longest runs
    of characters other than ASCII white space.
    """

    def searched(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        sizes = np.array([len(t) for t in texts], np.int64)
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
        found = find_runs(words, sizes, shortest, exponent)
        bounds = np.searchsorted(found[:, 0], np.arange(len(texts) + 1)).tolist()
        runs, collapsed = [], []
        for k, own in enumerate(texts):
            rows = found[bounds[k] : bounds[k + 1], 1:].tolist()
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in rows])
            if rows:
                change = np.zeros(len(own) + 1, np.int64)
                at = np.array(rows, np.int64)
                np.add.at(change, at[:, 0] + at[:, 2], 1)
                np.add.at(change, at[:, 0] + at[:, 1], -1)
                own = [own[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            collapsed.append(b" ".join(own))
        columns = [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(runs, _RUNS), pa.array(collapsed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch, "text"), strict=True):
                words = text.split()
                words = prepare(doc, words) if prepare else words
                ids.append(doc)
                texts.append(words)
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield searched(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield searched(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, _SCHEMA)
