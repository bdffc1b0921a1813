"""Word bigram model with interpolated modified Kneser-Ney smoothing, counted in Spark and read by memory map.

Survey: tokens and contexts of all training texts are counted, by task before the shuffle. From that follow the number of
shards, of about ``SHARD_TOKENS`` tokens each, and the contexts so common that they would outweigh one.

Counting: each task reduces its texts to distinct pairs (context, word) of 64-bit hashes with counts, and deals them to
shards as sorted, compressed blocks. A shard belongs to contexts, so it holds all there is to know about their
followers; a context so common that it would outweigh a shard is dealt over several by its followers. A shard merges its
blocks and stores the pairs as a sorted array of hashes next to their counts. What it learns about
single words (count, distinct contexts, followers seen once, twice and more often) goes on as blocks to word
shards, which store the same kind of arrays. The driver sees one row of totals per shard.

Scoring: workers map the arrays into memory, so that all workers of a machine share its pages and none needs to hold the
model; a batch's distinct pairs are looked up by binary search in sorted order. No text is shuffled.

The model: P(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) P(w), with P(w) of the same form over the numbers of
distinct contexts and an even share 1 / (V + 1) for each word of the vocabulary and one for all unknown; D are the usual three
discounts from counts of counts, and g makes sums 1. Texts begin in a context of their own and end in an end token.

Order 2: the model of order 3 keeps nearly as many trigrams as there are words (they hardly repeat), which at
eight bytes a hash, shuffled and stored, is beyond the disk that the task allows (see README).

What a shard's task holds is bounded by the tokens of a shard, whatever the size and order of the corpus and the session's
settings. The driver gets the common contexts, fewer than four per shard. Arrays are written under a temporary name and renamed, with
equal content whenever a task is repeated, to the shared folder. On a file system that can't be mapped, a worker
copies an array to an unnamed local file and maps that.

Defined cases: a null or empty text is just the end token; without training texts all words are unknown;
repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.llm.common import text_bytes
from vitalgauge.llm.kept import Kept
from vitalgauge.sources.shared import share, shared_path

#: Hashes of single words; those of texts are made for all distinct words of a block.
_hashes = Kept(xxhash.xxh64_intdigest, 1 << 16)
#: A word never holds a space, so these are no word's hash but by chance.
_START, _END = (np.uint64(_hashes[s]) for s in (b" start", b" end"))
#: Tokens a task counts at a time, and scores at a time.
_BLOCK = 1_000_000
#: Tokens that a shard should have.
SHARD_TOKENS = 1 << 21


# --- hashes and arrays ----------------------------------------------------------------------------


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash of two."""
    with np.errstate(over="ignore"):
        x = context * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(33))


def _pieces(values: pa.LargeStringArray) -> Iterator[bytes]:
    """The bytes of each value, cut from one copy of all."""
    if len(values):
        _, ends, data = values.buffers()
        places, data = np.frombuffer(ends, np.int64)[values.offset :][: len(values) + 1].tolist(), data.to_pybytes()
        yield from map(data.__getitem__, map(slice, places, places[1:]))


def token_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order; of every token the places of its context's and its own hash there, and its text's number.

    Arrow splits the texts, at the same characters as ``words``, and finds distinct words, so that each is hashed once.
    """
    lowered = pc.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string()))
    found = pc.ascii_split_whitespace(lowered)
    word, text = found.flatten(), pc.list_parent_indices(found).to_numpy()
    filled = pc.greater(pc.binary_length(word), 0)  # white space at the ends of a text makes empty words
    coded, text = word.filter(filled).dictionary_encode(), text[filled.to_numpy(zero_copy_only=False)]
    distinct = coded.dictionary
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, _pieces(distinct)), np.uint64, len(distinct))
    hashes, place = np.unique(np.append(hashed, [_START, _END]), return_inverse=True)
    sizes = np.bincount(text, minlength=len(texts)) + 1
    ends = np.cumsum(sizes) - 1
    token = np.empty(int(sizes.sum()), np.int64)
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word] = place[coded.indices.to_numpy()]
    token[ends] = place[-1]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[ends - sizes + 1] = place[-2]
    return hashes, context, token, np.repeat(np.arange(len(texts)), sizes)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, the place of one row of each, and the sums of values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], order[first], [np.add.reduceat(v[order], first) if len(first) else v for v in values]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, each in as few bytes a value as it needs, compressed."""
    parts = [len(arrays[0]).to_bytes(8, "little")]
    for a in arrays:
        small = a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)
        parts += [bytes([small.dtype.itemsize]), small.tobytes()]
    return zstandard.compress(b"".join(parts), 1)


def unpacked(data: bytes, n: int) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(data), 8, []
    rows = int.from_bytes(raw[:8], "little")
    for _ in range(n):
        size = raw[at]
        out.append(np.frombuffer(raw, f"<u{size}", rows, at + 1).astype(np.uint64))
        at += 1 + size * rows
    return out


def _store(folder: str, name: str, array: np.ndarray) -> None:
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    partial = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(partial) as out:
        np.save(out, array)
    files.move(partial, f"{path}/{name}.npy")


@functools.lru_cache(maxsize=100_000)
def _mapped(folder: str, name: str) -> np.ndarray:
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    path = f"{path}/{name}.npy"
    if files.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
        return np.zeros(0, np.uint64)
    if isinstance(files, pyarrow.fs.LocalFileSystem):
        return np.load(path, mmap_mode="r")
    with tempfile.NamedTemporaryFile() as copy, files.open_input_stream(path) as source:
        while block := source.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")


def _uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def _smallest(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def look_up(folder: str, prefix: str, shard: np.ndarray, key: np.ndarray, columns: list[str]) -> list[np.ndarray]:
    """Per key the stored values of its shard; 0 where it isn't there."""
    out = [np.zeros(len(key), np.uint64) for _ in columns]
    order = np.argsort(key)
    order = order[np.argsort(_smallest(shard[order]), kind="stable")]
    edges = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(key) else []
    for low, high in zip(edges, edges[1:], strict=False):
        rows = order[low:high]
        name = f"{prefix}-{shard[rows[0]]}"
        stored = _mapped(folder, f"{name}-key")
        if not len(stored):
            continue
        place = np.searchsorted(stored, key[rows])
        place[place == len(stored)] = 0
        hit = stored[place] == key[rows]
        for values, column in zip(out, columns, strict=True):
            values[rows[hit]] = _mapped(folder, f"{name}-{column}")[place[hit]]
    return out


# --- counting -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Shards:
    """How pairs are dealt. ``spread``: over how many shards the pairs of a very common context go."""

    number: int
    spread: dict[int, int]

    def of_pairs(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        shard = context % np.uint64(self.number)
        if self.spread:
            common = np.array(sorted(self.spread), np.uint64)
            over = np.array([self.spread[int(h)] for h in common], np.uint64)
            place = np.searchsorted(common, context).clip(max=len(common) - 1)
            hit = common[place] == context
            shard[hit] = (shard[hit] + (word[hit] >> np.uint64(20)) % over[place[hit]]) % np.uint64(self.number)
        return shard.astype(np.int64)

    def of_words(self, word: np.ndarray) -> np.ndarray:
        return ((word >> np.uint64(8)) % np.uint64(self.number)).astype(np.int64)


def shards_for(docs: DataFrame) -> Shards:
    """Enough shards for all tokens of ``docs``, with each context of over a quarter of a shard dealt over several."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _blocks(batches):
            hashes, context, _, _ = token_places(texts)
            n = np.bincount(context, minlength=len(hashes))
            columns = [pa.array(hashes[n > 0].view(np.int64)), pa.array(n[n > 0])]
            yield pa.RecordBatch.from_arrays(columns, names=["context", "n"])

    tokens = docs.select(F.col("text").cast("string")).mapInArrow(counted, "context long, n long")
    contexts = share(tokens.groupBy("context").agg(F.sum("n").alias("n")), "contexts")
    number = max(1, -(-(contexts.agg(F.sum("n")).first()[0] or 0) // SHARD_TOKENS))
    common = contexts.where(F.col("n") > SHARD_TOKENS // 4).collect() if number > 1 else []
    return Shards(number, {r["context"] % (1 << 64): min(-(-4 * r["n"] // SHARD_TOKENS), number) for r in common})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The texts of a task, about ``_BLOCK`` tokens at a time."""
    some, size = [], 0
    for batch in batches:
        for text in text_bytes(batch, "text"):
            some.append(text)
            size += len(text) // 5 + 1
            if size >= _BLOCK:
                yield some
                some, size = [], 0
    if some:
        yield some


def _by_shard(shard: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """A packed block of rows for each shard."""
    order = np.argsort(_smallest(shard), kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(shard) else []
    blocks = [(int(shard[order[a]]), packed(*(x[order[a:b]] for x in arrays))) for a, b in zip(edges, edges[1:], strict=False)]
    ids, data = zip(*blocks, strict=True) if blocks else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["shard", "block"])


@dataclass(frozen=True)
class KneserNey:
    """Where the arrays are, how they are dealt, and totals: tokens, vocabulary, pairs, and both sets of discounts."""

    folder: str
    shards: Shards
    tokens: int
    vocabulary: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: What the discounts take from all words together.
    spared: float

    def word_chance(self, contexts: np.ndarray) -> np.ndarray:
        """P(w), by the number of distinct contexts of w."""
        even = (self.spared if self.pairs else 1.0) / (self.vocabulary + 1)
        return np.maximum(contexts - _discount(contexts, self.word_discounts), 0) / max(self.pairs, 1) + even

    def score(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score and score, both as log10."""
        hashes, context, token, text = token_places(texts)
        columns = ["count", "contexts", "once", "twice", "more"]
        by_word = look_up(self.folder, "words", self.shards.of_words(hashes), hashes, columns)
        count, contexts, once, twice, more = (a.astype(float) for a in by_word)
        ends = count[np.searchsorted(hashes, _END)]
        total = np.where(hashes == _START, ends, np.where(hashes == _END, 0, count))

        pairs, of_pair = np.unique(context * len(hashes) + token, return_inverse=True)
        v, w = np.divmod(pairs, len(hashes))
        key, shard = pair_key(hashes[v], hashes[w]), self.shards.of_pairs(hashes[v], hashes[w])
        (low,) = look_up(self.folder, "pairs", shard, key, ["count"])
        pair = self._whole_counts(shard, key, low)

        d = self.pair_discounts
        spared = d[0] * once + d[1] * twice + d[2] * more
        followed, by_single = total[v], self.word_chance(contexts)[w]
        known = followed > 0
        chance = np.where(
            known,
            (np.maximum(pair - _discount(pair, d), 0) + spared[v] * by_single) / np.where(known, followed, 1),
            by_single,
        )
        base = np.log10((count + 1) / (self.tokens + (self.vocabulary + 1)))
        n = len(texts)
        return [
            np.bincount(text, minlength=n),
            np.bincount(text, (count > 0)[token], minlength=n).astype(np.int64),
            np.bincount(text, base[token], minlength=n),
            np.bincount(text, np.log10(chance)[of_pair], minlength=n),
        ]

    def _whole_counts(self, shard: np.ndarray, key: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Counts are stored up to 255, those from there on a second time and whole."""
        large = np.flatnonzero(low == 255)
        whole = low.astype(float)
        if len(large):
            (whole[large],) = look_up(self.folder, "large", shard[large], key[large], ["count"])
        return whole


def _discount(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(n >= 3, d[2], np.where(n >= 2, d[1], np.where(n >= 1, d[0], 0.0)))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts from how many things were seen once to four times; 0.75 of what is at stake where that tells nothing."""
    if not (n1 and n2 and n3):
        return 0.75, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k) for d, k in zip(raw, (0.95, 1.95, 2.95), strict=True))


def fit_kneser_ney(docs: DataFrame) -> KneserNey:
    """A model of the ``text`` of all ``docs``."""
    spark = docs.sparkSession
    folder, shards = _uri(shared_path(spark, "kneser-ney")), shards_for(docs)

    def pairs_of(texts: list[bytes]) -> pa.RecordBatch:
        hashes, context, token, _ = token_places(texts)
        pairs, n = np.unique(context * len(hashes) + token, return_counts=True)  # in order, so contexts lie together and compress
        v, w = np.divmod(pairs, len(hashes))
        context, token = hashes[v], hashes[w]
        return _by_shard(shards.of_pairs(context, token), context, token, n)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _blocks(batches):
            yield pairs_of(texts)

    def merged_pairs(blocks: pa.Table) -> Iterator[pa.RecordBatch]:
        shard = blocks.column("shard")[0].as_py()
        context, token, n = map(np.concatenate, zip(*(unpacked(b, 3) for b in blocks.column("block").to_pylist()), strict=True))
        key, first, (n,) = summed(pair_key(context, token), n)
        context, token = context[first], token[first]
        _store(folder, f"pairs-{shard}-key", key)
        _store(folder, f"pairs-{shard}-count", np.minimum(n, 255).astype(np.uint8))
        large = n >= 255
        if large.any():
            _store(folder, f"large-{shard}-key", key[large])
            _store(folder, f"large-{shard}-count", n[large])
        one, zero = np.ones(len(key), np.uint64), np.zeros(len(key), np.uint64)
        as_context = [zero, zero, *((x).astype(np.uint64) for x in (n == 1, n == 2, n >= 3)), *((n == k).astype(np.uint64) for k in (3, 4))]
        as_word = [n, one, zero, zero, zero, zero, zero]
        word, _, sums = summed(
            np.concatenate([context, token]), *(np.concatenate(x) for x in zip(as_context, as_word, strict=True))
        )
        return _by_shard(shards.of_words(word), word, *sums)

    def merged_words(blocks: pa.Table) -> pa.Table:
        shard = blocks.column("shard")[0].as_py()
        word, *values = map(np.concatenate, zip(*(unpacked(b, 8) for b in blocks.column("block").to_pylist()), strict=True))
        word, _, (count, contexts, once, twice, more, three, four) = summed(word, *values)
        _store(folder, f"words-{shard}-key", word)
        for name, column in (("count", count), ("contexts", contexts), ("once", once), ("twice", twice), ("more", more)):
            _store(folder, f"words-{shard}-{name}", _smallest(column))
        totals = [count.sum(), (count > 0).sum(), contexts.sum(), once.sum(), twice.sum(), three.sum(), four.sum()]
        totals += [(contexts == k).sum() for k in (1, 2, 3, 4)] + [(contexts >= 3).sum()]
        return pa.table({f"t{i}": [int(t)] for i, t in enumerate(totals)})

    blocks = "shard long, block binary"
    pairs = docs.select(F.col("text").cast("string")).mapInArrow(counted, blocks)
    by_word = pairs.groupBy("shard").applyInArrow(lambda t: pa.Table.from_batches([merged_pairs(t)]), blocks)
    totals = by_word.groupBy("shard").applyInArrow(merged_words, ", ".join(f"t{i} long" for i in range(12)))
    sums = totals.agg(*[F.sum(f"t{i}").alias(f"t{i}") for i in range(12)]).first()
    tokens, vocabulary, distinct, *rest = (int(x or 0) for x in sums)
    of_pairs, (w1, w2, w3, w4, w3more) = rest[:4], rest[4:]
    word_discounts = discounts(w1, w2, w3, w4)
    spared = (word_discounts[0] * w1 + word_discounts[1] * w2 + word_discounts[2] * w3more) / max(distinct, 1)
    return KneserNey(folder, shards, tokens, vocabulary, distinct, discounts(*of_pairs), word_discounts, spared)


def model_scores(docs: DataFrame, model: KneserNey) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``perplexity``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, size, low = [], 0, 0
            for at, text in enumerate(text_bytes(batch, "text"), 1):
                some.append(text)
                size += len(text) // 5 + 1
                if size >= _BLOCK or at == batch.num_rows:
                    n, known, base, score = model.score(some)
                    columns = [pa.array(x) for x in (n, known, base, score, 10 ** (-score / n))]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(low, len(some)), *columns],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                    )
                    some, size, low = [], 0, at

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        scored, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )
