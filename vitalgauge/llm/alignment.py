"""Alignment of two tokenizers' tokens over the same bytes, with counts of linked ids over the whole corpus.

A byte-level BPE (A) and a SentencePiece model (B) cut the same bytes, a space and the text, into tokens. Where tokens of
both end at one byte, these two are linked, and the tokens since the last such place form a group.

Each task works through its texts in chunks, as Arrow columns: the lists of ids are flattened next to the index of their
parent, the sizes of the tokens are summed up within each parent, and an Acero hash join on (document, end) finds the
links. ``Table.group_by`` counts the pairs of a chunk; the stored table has them once per chunk, and each document's links
as numbers in that list. Spark then adds up the chunks' counts by pair, finds the highest of each B id, and brings the
totals of a chunk's pairs back to the chunk, where each document's links are looked up. So what is shuffled by pair is a
row per chunk and pair, never one per link: a frequent pair has as many rows as there are chunks, no more than any other
pair found everywhere. Nothing is broadcast, and a group holds one chunk (``CHUNK_BYTES`` of text, or one longer text).
Workers give back Arrow's unused memory after each chunk, and drop known words when links are looked up: all texts are encoded by then.

Defined cases: null or empty texts, and texts whose bytes a tokenizer does not keep (B composes or drops some characters),
have no tokens and no groups; repeated rows have a row each and count each; an empty table gives no rows; columns other
than id and text are not read; special strings inside texts are ordinary text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm import byte_bpe
from vitalgauge.llm.byte_bpe import byte_letters, encoder, plain
from vitalgauge.llm.common import give_back, text_bytes
from vitalgauge.llm.kept import Kept

#: Text a task aligns at a time.
CHUNK_BYTES = 2 << 20
#: Bytes of words and their ids that a worker keeps at most.
WORD_BYTES = 256 << 20
#: An id pair as one number: A's id times this, plus B's.
_PAIR = 1 << 32
#: A document and an end in it as one number.
_DOCUMENT = 1 << 40
_ROWS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, groups string, links binary, pairs array<long>, pair_links array<long>"
)
_FIELDS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups")), ("groups", pa.string()),
     ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("pair_links", pa.list_(pa.int64()))]
)


class Tokens:
    """One side's vocabulary: the bytes and the size of each id. No token of either kind is without bytes."""

    def __init__(self, texts: list[bytes]):
        self.bytes = pa.array(texts, pa.large_binary())
        self.sizes = pc.binary_length(self.bytes).cast(pa.int64())

    def __len__(self) -> int:
        return len(self.bytes)


def _lists(packed: list[bytes], dtype: np.dtype) -> pa.LargeListArray:
    """Lists of ids from each list's bytes."""
    sizes = np.array([len(p) for p in packed], np.int64) // dtype.itemsize
    ids = np.frombuffer(b"".join(packed), dtype).astype(np.int64)
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), pa.array(ids))


class PieceIds:
    """Packed ids of whole texts by a SentencePiece BPE model, with known words kept.

    Where no piece has a space after another character, merging never crosses the start of a run of spaces, and a text's
    ids are those of its words one after the other, each with the spaces before it. Texts with characters
    beyond a plain range, whose normal form might join such words, or models of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        plain = self.ids("a  b ") == self.ids("a") + self.ids(" b") + self.ids("")
        self.by_words = plain and not any("▁" in p.lstrip("▁") for p in pieces)
        self.words = Kept(self._word, WORD_BYTES)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1) if text else [self.model.piece_to_id("▁")]

    def _word(self, word: str) -> bytes:
        return np.array(self.ids(word), np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_words or not plain(text):
            return np.array(self.model.encode(text, num_threads=1), np.int32).tobytes()
        if "  " in text or text[0] == " " or text[-1] == " ":
            found = [x[1:] for x in _SPACED.findall(" " + text)]
        else:
            found = text.split(" ")
        return b"".join(map(self.words.__getitem__, found))


_SPACED = re.compile(" +[^ ]*")


class Aligner:
    """Aligns texts by a byte-level BPE of the tokenizers library and a SentencePiece model."""

    def __init__(self, a_path: str, b_path: str):
        self.a_ids = encoder(a_path, special_as_text=True)
        self.b_ids = PieceIds(b_path)
        config, letters = json.loads(Path(a_path).read_text()), {c: b for b, c in byte_letters().items()}
        names = {i: t for t, i in config["model"]["vocab"].items()} | {t["id"]: t["content"] for t in config["added_tokens"]}
        self.a = Tokens([bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)])
        model = self.b_ids.model
        pieces = [(i, model.id_to_piece(i)) for i in range(model.vocab_size())]
        self.b = Tokens([bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces])
        #: Ids in decimal, A's and then B's, each followed by what stands inside a group and then by what ends its side of it.
        self.decimals = pa.array(
            [f"{i}{end}" for n, last in ((len(self.a), "|"), (len(self.b), ";")) for i in range(n) for end in (",", last)], pa.large_string()
        )

    def lists(self, texts: list[bytes]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """The ids of both sides; no tokens for empty texts."""
        decoded = [t.decode() for t in texts]
        a = _lists([self.a_ids.encode(" " + t) if t else b"" for t in decoded], self.a_ids.dtype)
        return a, _lists([self.b_ids.encode(t) if t else b"" for t in decoded], np.dtype(np.int32))

    def keeps(self, tokens: Tokens, ids: pa.ListArray, texts: list[bytes]) -> np.ndarray:
        """By text, whether its tokens' bytes joined are a space and the text."""
        joined = pc.take(tokens.bytes, pc.list_flatten(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
        places = ends[ids.offsets.to_numpy()] - ends[0] if len(joined) else np.zeros(len(texts) + 1, np.int64)
        data = memoryview(joined.buffers()[2] or b"")[int(ends[0]) if len(joined) else 0 :]
        return np.array([bytes(data[i:j]) == (b" " + t if t else b"") for i, j, t in zip(places, places[1:], texts, strict=False)], bool)

    def ends(self, tokens: Tokens, ids: pa.ListArray) -> pa.Table:
        """A row per token: its id and its document-end key. The size of tokens is summed up within each list."""
        flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
        total = pc.cumulative_sum(pc.take(tokens.sizes, flat))
        before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(ids.offsets[:-1])
        end = pc.subtract(total, pc.take(before, parent))
        key = pc.add(pc.multiply(parent, pa.scalar(_DOCUMENT, pa.int64())), end)
        return pa.table({"id": flat, "key": key, "at": np.arange(len(flat))})

    def texts_of_groups(self, ids: list[np.ndarray], last: list[np.ndarray], tokens: np.ndarray) -> list[str]:
        """By document its groups, as ``a1,a2|b1;a3|b2,b3``.

        ``ids``: of both sides; ``last``: whether an id is the last of its side of a group; ``tokens``: of both sides together,
        those before each document, and all.
        """
        (a_group, a_until), (b_group, b_until) = ((np.cumsum(x) - x, np.append(0, np.flatnonzero(x) + 1)) for x in last)
        # within each group A's ids stand before B's
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        codes[np.arange(len(ids[0])) + b_until[a_group]] = 2 * ids[0] + last[0]
        codes[np.arange(len(ids[1])) + a_until[b_group + 1]] = 2 * (len(self.a) + ids[1]) + last[1]
        joined = self.decimals.take(pa.array(codes))
        if not len(codes):
            return [""] * (len(tokens) - 1)
        ends, data = np.frombuffer(joined.buffers()[1], np.int64), joined.buffers()[2].to_pybytes().decode("ascii")
        places = ends[tokens].tolist()
        return [data[i : max(i, j - 1)] for i, j in zip(places, places[1:], strict=False)]

    def align(self, chunk: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        lists = self.lists(texts)
        whole = self.keeps(self.a, lists[0], texts) & self.keeps(self.b, lists[1], texts)
        lists = [x.filter(pa.array(whole)) for x in lists]
        a, b = self.ends(self.a, lists[0]), self.ends(self.b, lists[1])
        links = a.join(b, "key", join_type="inner", right_suffix="_b", use_threads=False)
        keys, pair = links["key"].to_numpy(), links["id"].to_numpy() * _PAIR + links["id_b"].to_numpy()
        order = np.argsort(keys, kind="stable")
        coded = pa.array(pair[order]).dictionary_encode()
        counted = pa.table({"pair": coded.indices}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        last = [np.zeros(len(side), bool) for side in (a, b)]
        for flags, at in zip(last, ("at", "at_b"), strict=True):
            flags[links[at].to_numpy()] = True
        # of each document, and the end of the last: the first token of each side, the first group, the first link
        first = [x.offsets.to_numpy().astype(np.int64) for x in lists]
        groups = np.append(0, np.cumsum(last[0]))[first[0]]
        of_links = np.append(0, np.cumsum(np.bincount(keys // _DOCUMENT, minlength=len(first[0]) - 1)))
        group_texts = self.texts_of_groups([a["id"].to_numpy(), b["id"].to_numpy()], last, first[0] + first[1])
        numbers = coded.indices.to_numpy().astype("<i4")
        link_bytes = [numbers[i:j].tobytes() for i, j in zip(of_links, of_links[1:], strict=False)]

        def for_all(values, empty) -> list:
            found = iter(values)
            return [next(found) if w else empty for w in whole.tolist()]

        on_first = lambda value: [value] + [None] * (len(ids) - 1)
        columns = [
            [chunk] * len(ids), ids, *(for_all(np.diff(x).tolist(), 0) for x in (first[0], first[1], groups)), for_all(group_texts, ""),
            for_all(link_bytes, b""), on_first(coded.dictionary.to_pylist()), on_first(counted["count_all"].to_pylist()),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker and pair of vocabularies."""
    key = (a_path, b_path)
    if key not in _aligners:
        _aligners[key] = Aligner(a_path, b_path)
    return _aligners[key]


def forget() -> None:
    """Drop the words of both sides that this worker keeps."""
    byte_bpe.forget()
    for own in _aligners.values():
        own.b_ids.words.forget()


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, ``chunk_bytes`` or one longer text at a time, none of two batches."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch, "text"), strict=True):
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if size >= chunk_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def alignments(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``groups``, its ``links`` as numbers of the chunk's pairs
    (32 bits each), the ``chunk``, and on the chunk's first row its ``pairs`` and how many links hold each."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for chunk, (ids, texts) in enumerate(_chunks(batches, chunk_bytes), first):
            yield own.align(chunk, ids, texts)
            give_back()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(aligned, _ROWS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, how many links of the corpus hold it (``count``), and whether no pair of its B id has more (``best``)."""
    pairs = aligned.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_links").alias("count"))
    counts = counts.withColumn("b", F.col("pair") % _PAIR)
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _looked_up(rows: pa.Table, counts: pa.Table, kept: list[str]) -> pa.Table:
    """A chunk's rows, their columns ``kept`` and the sums over links of ``counts``, which has a row for each pair of the chunk."""
    forget()
    give_back()
    order = pc.sort_indices(counts["number"])
    links = rows["links"].combine_chunks().cast(pa.large_binary()).to_pylist()
    numbers = pa.array(np.frombuffer(b"".join(links), "<i4"))
    ends = np.cumsum([0, *(len(x) // 4 for x in links)])

    def summed(column: pa.ChunkedArray) -> pa.Array:
        values = pc.take(column.take(order).cast(pa.int64()).combine_chunks(), numbers)
        sums = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(values)])
        return pc.subtract(sums.take(pa.array(ends[1:])), sums.take(pa.array(ends[:-1])))

    out = rows.select(kept).append_column("n_links", pa.array(np.diff(ends)))
    return out.append_column("n_best", summed(counts["best"])).append_column("count_sum", summed(counts["count"]))


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (stored, as it is read three times) with ``n_links``, ``n_best`` (links whose pair is among the most frequent
    of its B id) and ``count_sum`` (of the links' pairs) in the place of links, pairs and chunks."""
    listed = aligned.filter("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("number", "pair"))
    totals = listed.join(pair_counts(aligned), "pair").select(F.col("chunk").alias("of_chunk"), "number", "count", "best")
    documents = aligned.drop("pairs", "pair_links")
    kept = [f for f in documents.schema.fields if f.name not in ("chunk", "links")]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "n_links long", "n_best long", "count_sum long"])

    def looked_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
        return _looked_up(rows, counts, [f.name for f in kept])

    return documents.groupBy("chunk").cogroup(totals.groupBy("of_chunk")).applyInArrow(looked_up, schema)
