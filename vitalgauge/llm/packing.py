"""Packing documents into token sequences, each window with the target mixture of sources.

Sources are queues of tokens, and the output is a row of windows. In deficit round-robin each queue earns
its share of a window in every round, spends what it has earned in whole tokens, and carries the rest (its
deficit, always below one token) into the next window. Share by share that fixes where each token goes: with T
tokens in a queue and W windows, the queue has given floor(T * w / W) tokens before window w, and the deficit
is the fraction cut off. So any task can tell the deficits at any window without having seen the ones
before it, and deficits carry over from partition to partition exactly. Within a window the queues follow each
other in a fixed order, and the whole row is cut every ``SEQUENCE`` tokens; all sequences are full but for
the rest at the very end, which is cut into powers of two, so that nothing is padded.

Targets are the sources' shares of all tokens, as every document is packed whole and once.

If there are more sources than queues, the rest (the tail) share the last queue, which deals their documents out in a second
round: a document stands where its start is among its source's tokens, as a fraction of them, turned by a hash of the source so that small
sources do not all begin at once. So each stretch of that queue has every source's share, up to the documents at its ends.

Steps: (1) texts are encoded once, and the ids are stored in the shared folder with each task's running count per queue;
(2) the counts per task and queue are summed along each queue, and the tail is sorted in ``TAIL_PARTS`` parts of its round, ids and counts only; (3) each stored document gets its place and
is cut into pieces. Only the second step's small rows meet by queue, so a hot source is nobody's load.

Defined cases: a null text is an empty one, and an empty document has just the end id; a null source is a queue
like others; repeated rows are packed as often as they occur; an empty table gives no rows; columns other than id, source
and text are not read.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitalgauge.llm.byte_bpe import encoder, forget
from vitalgauge.llm.common import give_back, text_bytes
from vitalgauge.sources.shared import share

SEQUENCE = 2048
#: Tokens of a window; the mixture is right in each.
WINDOW = 32 * SEQUENCE
END_ID = 1
#: Queues. The sources of most documents have one each; if there are more, the rest share the last one.
QUEUES = 256
#: Most parts of the tail's round, each sorted on its own, and the tokens from which on there is one more.
TAIL_PARTS = 65_536
_PART_TOKENS = 1 << 20
#: Rows a task puts out at a time.
_ROWS = 2048
_TOKENS = "part int, at long, doc_id long, queue int, start long, n long, ids binary, tail string"
_PIECES = "doc_id long, queue int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Places:
    """Where the tokens of each queue go. ``totals``: tokens by queue."""

    totals: tuple[int, ...]
    window: int = WINDOW
    sequence: int = SEQUENCE

    @functools.cached_property
    def tokens(self) -> int:
        return sum(self.totals)

    @functools.cached_property
    def windows(self) -> int:
        return max(1, -(-self.tokens // self.window))

    @functools.cached_property
    def _parts(self) -> tuple[np.ndarray, np.ndarray]:
        kind = np.int64 if self.windows < 1 << 31 else object  # products of two such numbers must fit
        totals = np.array(self.totals, kind)
        return totals // self.windows, totals % self.windows

    def given(self, w: int) -> np.ndarray:
        """Tokens each queue has given before window ``w``."""
        whole, rest = self._parts
        return whole * w + rest * w // self.windows

    @functools.lru_cache(maxsize=4096)  # noqa: B019  lives as long as a task
    def _shifts(self, w: int) -> tuple[list[int], list[int]]:
        """By queue: place less queue position of its tokens in window ``w``; and the queue position where they end."""
        given, until = self.given(w), self.given(w + 1)
        before = np.cumsum(until - given) - (until - given)
        return (int(given.sum()) + before - given).tolist(), until.tolist()

    def runs(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
        """Queue position, place and length of the runs that tokens ``start`` to ``start + n`` of a queue are split into."""
        end, total = start + n, self.totals[queue]
        while start < end:
            shifts, until = self._shifts(((start + 1) * self.windows - 1) // total)
            stop = min(end, until[queue])
            yield start, start + shifts[queue], stop - start
            start = stop

    @functools.cached_property
    def _tail(self) -> list[int]:
        """Where the sequences of the rest begin, and the end of all."""
        rest, starts = self.tokens % self.sequence, [self.tokens - self.tokens % self.sequence]
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                starts.append(starts[-1] + (1 << bit))
        return starts

    def sequence_at(self, place: int) -> tuple[int, int, int]:
        """Number, start and end of the sequence that holds a place."""
        tail = self._tail
        if place < tail[0]:
            k = place // self.sequence
            return k, k * self.sequence, (k + 1) * self.sequence
        i = bisect_right(tail, place) - 1
        return tail[0] // self.sequence + i, tail[i], tail[i + 1]

    def pieces(self, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Document position, length, sequence and offset there of each piece of a document."""
        for at, place, length in self.runs(queue, start, n):
            while length:
                number, begin, end = self.sequence_at(place)
                taken = min(length, end - place)
                yield at - start, taken, number, place - begin
                at, place, length = at + taken, place + taken, length - taken


def queue_numbers(docs: DataFrame, queues: int = QUEUES) -> dict[str | None, int]:
    """The queue of each of the ``queues - 1`` sources with most documents; all others have the last."""
    counts = docs.groupBy(F.col("source").cast("string").alias("source")).count()
    first = counts.orderBy(F.desc("count"), F.col("source").asc_nulls_last()).limit(queues - 1).collect()
    return {r["source"]: i for i, r in enumerate(first)}


def token_table(docs: DataFrame, tokenizer_path: str, queues: int = QUEUES, end_id: int = END_ID) -> DataFrame:
    """Each document's packed ids, and where it starts among its task's tokens of the same queue, or in the last queue of
    the same source, its ``tail``; stored."""
    numbers = queue_numbers(docs, queues)
    others = queues - 1

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, given, at, part = encoder(tokenizer_path), Counter(), 0, TaskContext.get().partitionId()
        end = np.array([end_id], bpe.dtype).tobytes()
        for batch in batches:
            texts = text_bytes(batch, "text")
            for low in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(low, _ROWS)
                sources = rows.column(1).to_pylist()
                queue = [numbers.get(s, others) for s in sources]
                tail = [s if q == others else None for s, q in zip(sources, queue, strict=True)]
                ids = [bpe.encode(next(texts).decode()) + end for _ in queue]
                n = [len(x) // bpe.dtype.itemsize for x in ids]
                start = []
                for q, s, k in zip(queue, tail, n, strict=True):
                    start.append(given[q, s])
                    given[q, s] += k
                columns = [[part] * len(n), range(at, at + len(n)), rows.column(0), queue, start, n, ids, tail]
                at += len(n)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, kinds, strict=True)],
                    names=["part", "at", "doc_id", "queue", "start", "n", "ids", "tail"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return share(rows.mapInArrow(encoded, _TOKENS), "tokens", compression="zstd")


def tail_starts(tokens: DataFrame, queue: int, total: int) -> DataFrame:
    """``part``, ``at`` and ``place`` of the documents of the last queue: where each starts there, the sources taking turns."""
    docs = tokens.filter(F.col("queue") == queue).select("part", "at", "tail", "start", "n")
    own = Window.partitionBy("tail")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = docs.groupBy("tail", "part").agg(F.sum("n").alias("given"))
    sums = sums.select("tail", "part", F.coalesce(F.sum("given").over(before), F.lit(0)).alias("before"), F.sum("given").over(own).alias("total"))
    joined = docs.alias("d").join(sums.alias("s"), F.col("d.tail").eqNullSafe(F.col("s.tail")) & (F.col("d.part") == F.col("s.part")))
    phase = F.shiftrightunsigned(F.xxhash64(F.col("d.tail"), F.lit("phase")), 11) / F.lit(float(1 << 53))
    turn = ((F.col("before") + F.col("start")) / F.col("total") + phase) % F.lit(1.0)
    parts = min(TAIL_PARTS, 1 + total // _PART_TOKENS)
    placed = joined.select("d.part", "d.at", "n", turn.alias("turn")).withColumn("stretch", F.floor(F.col("turn") * parts))
    placed = share(placed, "tail-turns")
    # at most TAIL_PARTS rows meet in one task
    ahead = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = placed.groupBy("stretch").agg(F.sum("n").alias("given"))
    stretches = stretches.select("stretch", F.coalesce(F.sum("given").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("stretch").orderBy("turn", "part", "at").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return ordered.join(stretches, "stretch").select("part", "at", (F.col("ahead") + F.col("within")).alias("place"))


def packed_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    sequence: int = SEQUENCE,
    queues: int = QUEUES,
    end_id: int = END_ID,
    keep_words: bool = True,
) -> DataFrame:
    """All pieces: ``doc_id``, ``queue``, ``start``, ``length``, ``ids`` (little-endian 32 bits each), ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    ``keep_words``: workers keep the ids of words for a later call. Without it they drop these, for other work that needs the memory.
    """
    tokens = token_table(docs, tokenizer_path, queues, end_id)
    itemsize = encoder(tokenizer_path).dtype.itemsize
    sums = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = share(sums.select("queue", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "queue-offsets")
    totals = {r["queue"]: r["n"] for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    places = Places(tuple(totals.get(q, 0) for q in range(queues)), window, sequence)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep_words:  # all texts are encoded by now
            forget()
            give_back()
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                rows, out = batch.slice(low, _ROWS), []
                for doc, queue, start, n, ids in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    own = np.frombuffer(ids, f"<u{itemsize}").astype("<u4")
                    for at, length, number, offset in places.pieces(queue, start, n):
                        out.append((doc, queue, at, length, own[at : at + length].tobytes(), n, number, offset))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "queue", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                columns = zip(*out, strict=True) if out else [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    columns = ["doc_id", "queue", "start", "n", "ids"]
    last = places.totals[-1]
    first = tokens.filter(F.col("queue") < queues - 1) if last else tokens
    placed = first.join(offsets, ["queue", "part"]).withColumn("start", F.col("start") + F.col("before")).select(columns)
    if last:
        tail = tokens.filter(F.col("queue") == queues - 1).join(tail_starts(tokens, queues - 1, last), ["part", "at"])
        placed = placed.union(tail.withColumn("start", F.col("place")).select(columns))
    return placed.mapInArrow(cut, _PIECES)
