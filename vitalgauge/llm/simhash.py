"""Near-duplicates by SimHash fingerprints and an inverted index of their bytes.

A document's fingerprint has 64 bits: bit by bit the majority among the XXH64 hashes of its word shingles. Two
fingerprints link when they differ in at most ``max_bits`` bits, and documents group by reachability.

Search: fingerprints that differ in at most d bits differ in at most d of their eight bytes, so they share at
least 8 - d bytes at the same positions. That is the guaranteed minimum of the tally. A posting list for each
single byte and position would hold 1/256 of all fingerprints, and tallying its pairs would grow with the
square of the corpus; so the index is keyed by what a pair that reaches the minimum must share: each choice
of 8 - d positions with the bytes there (28 keys a fingerprint for d = 2). Two fingerprints meet in a list
exactly if they share that many positional bytes; pairs below the count never meet. Lists hold distinct
fingerprints that differ in d bytes only, so none is longer than 256 ** d (65,536 for d = 2), however many
documents are alike. Within a list links are verified by bit distance, and only as many are put out as tie its
fingerprints together.

Defined cases: a null text is an empty one; texts without words have fingerprint zero and link like any
other; a null id is the largest when a group's smallest id is sought; repeated rows are rows of their own; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import give_back, numbered, text_bytes, words
from vitalgauge.llm.components import component_roots
from vitalgauge.sources.shared import share

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Lists up to this length are verified pair by pair, longer ones by common neighbours.
PAIRWISE = 64
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits as an unsigned number."""
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(itertools.accumulate([len(w) + 1 for w in found]))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    last = ends[shingle_words - 1 :] or ends[-1:]
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, last, strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(np.array(hashes[at : at + _BLOCK], ">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``row`` and ``fp`` (the fingerprint as a signed long) from ``doc_id``, ``row`` and ``text``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in text_bytes(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "row", "fp"]
            )
        batch = None
        give_back()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("row").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(made, "doc_id long, row long, fp long")


def _flips(free: np.ndarray, most: int) -> np.ndarray:
    """All numbers with at most ``most`` bits set, of the bits ``free``."""
    sets = [c for n in range(most + 1) for c in itertools.combinations(free.tolist(), n)]
    return np.array([sum(1 << b for b in c) for c in sets], np.uint64)


def linked(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of distinct unsigned values, the position of the one that stands for its group.

    Few values are compared pair by pair. Of many, two within d bits have a value between them that is within
    d // 2 bits of the one and the rest of d from the other; so values are tied by such neighbours in common.
    """
    n = len(values)
    label = np.arange(n)
    if n <= PAIRWISE:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        while True:
            least = np.where(near, label[None, :], n).min(1)
            if (least == label).all():
                return label
            label = least
    differing = np.bitwise_or.reduce(values ^ values[0])
    free = np.array([b for b in range(64) if int(differing) >> b & 1])
    near, far = _flips(free, max_bits // 2), _flips(free, max_bits - max_bits // 2)
    keys = np.unique((values[:, None] ^ near[None, :]).ravel())
    meets = values[:, None] ^ far[None, :]
    place = np.searchsorted(keys, meets).clip(max=len(keys) - 1)
    member, column = np.nonzero(keys[place] == meets)
    key = place[member, column]
    while True:
        at_key = np.full(len(keys), n)
        np.minimum.at(at_key, key, label[member])
        least = label.copy()
        np.minimum.at(least, member, at_key[key])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` that tie together all of the distinct ``fp`` within ``max_bits`` of each other."""
    choices = list(itertools.combinations(range(8), 8 - max_bits))
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in choices]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(signed)])
    postings = distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.choice", "key.bytes")
    lists = postings.groupBy("choice", "bytes").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fps in batch.column(0):
                signed = np.sort(fps.values.to_numpy())
                label = linked(signed.view(np.uint64), max_bits)
                tied = label != np.arange(len(label))
                if tied.any():
                    yield pa.RecordBatch.from_arrays([pa.array(signed[tied]), pa.array(signed[label[tied]])], names=["a", "b"])
        batch = fps = None
        give_back()

    return lists.select("fps").mapInArrow(verified, "a long, b long")


def near_duplicate_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, row_column: str | None = None
) -> DataFrame:
    """Per document: ``doc_id``, ``row``, ``fp``, ``root`` (the group's smallest fingerprint) and ``component_id``.

    ``row`` is the document's value of ``row_column``, which must be unique and stable, or a number given here.
    """
    if row_column:
        rows = share(fingerprints(docs.select("doc_id", F.col(row_column).alias("row"), "text"), shingle_words), "fingerprints")
    else:
        bare = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
        rows = share(fingerprints(bare, shingle_words), "fingerprints")
    distinct = share(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = component_roots(share(links(distinct, max_bits), "links")).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    members = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = members.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = share(members.select("fp", "root").join(groups, "root"), "groups")
    return rows.join(known, "fp").select("doc_id", "row", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each group: that of the smallest id."""
    rows, row = numbered(docs, "near-dedup")
    groups = near_duplicate_groups(rows, shingle_words, max_bits, row_column=row)
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("rank"), "row"))
    stays = groups.groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias(row))
    return rows.join(stays, row, "left_semi").select(*docs.columns)
