"""Token ids, prefix counts and packing against the tokenizers library."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitalgauge.llm import queries
from vitalgauge.llm.byte_bpe import ByteBpe
from vitalgauge.llm.kept import Kept
from vitalgauge.llm.packing import Places, packed_pieces
from vitalgauge.llm.token_prefixes import PrefixBpe, longest_within, prefix_tables, tokens_at

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", "  ", " \n ", "a  b   c \n\n d\t\te ", "x \n y", "a\x1cb\x00c\x7fe \x0b\x0c f", "trail  ", "it's we'LL 'S ''s !!'re 'v 'lll",
    "<|endoftext|> a<|endoftext|>b!!<|startoftext|> c<|endoftex", "日本語のテキスト ½ x² 12345 ٣٤", "é ß ẞ İstanbul ΑΣ ΟΔΟΣ. ǅ ﬁ",
    "a\x85b\xa0c d　e​f", "😀👨‍👩‍👧 ḁ̷̛̦", "ᄀ각 각 Å", "=" * 80 + "!?" * 60, "ab" * 200,
]


@pytest.fixture(scope="module")
def texts(table):
    return ODD + [r.text for r in table("documents").select("text").limit(80).collect()]


def test_byte_ids(texts):
    ours, library = ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    rng = random.Random(1)
    made = ["".join(rng.choice("ab 1.'\n\té ſ\x00\x1b½!") for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    for text in texts + made:
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_what_is_kept_is_bounded(monkeypatch, texts):
    monkeypatch.setattr("vitalgauge.llm.byte_bpe.WORD_BYTES", 8000)
    monkeypatch.setattr("vitalgauge.llm.byte_bpe.PIECE_BYTES", 8000)
    ours, library = ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    for text in texts:
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_counts_at_every_prefix(texts):
    ours, library = PrefixBpe(WORDS), Tokenizer.from_file(WORDS)
    for text in [t[:300] for t in texts]:
        normal, counts = ours._normal(text), np.cumsum(np.frombuffer(ours.steps(text), np.int8))
        assert len(counts) == len(normal)
        cased = text if len(normal) == len(text) and normal == text.lower() else normal
        for n in range(1, len(normal) + 1):
            assert counts[n - 1] == len(library.encode(cased[:n], add_special_tokens=False).ids), (text, n)


CONTEXTS = ("{}", "-${}", "a{}b", "'{}", "1{} x")


def test_counts_of_every_character():
    ours, library = PrefixBpe(WORDS), Tokenizer.from_file(WORDS)

    def agree(texts):
        counted = [int(np.frombuffer(ours.steps(t), np.int8).sum(dtype=np.int64)) for t in texts]
        return counted == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]

    for block in range(0x32400 >> 8):
        characters = [chr(c) for c in range(block << 8, (block + 1) << 8) if not 0xD800 <= c <= 0xDFFF]
        ours._has_unsure("".join(characters))
        known = [c for c in characters if c not in ours.unsure]
        # characters both take alike go together, as one that they don't would send the whole text to the library
        texts = [" ".join(context.format(c) for c in known) for context in CONTEXTS]
        assert agree(texts), hex(block << 8)
        assert agree([x.format(c) for c in characters if c in ours.unsure for x in CONTEXTS]), hex(block << 8)
    assert {"\ua7cb", "\u058b"} <= ours.unsure and len(ours.unsure) < 20_000
    assert agree(["'-$\u058b", "'\u200d\u0cdc", "a \ua7cb. b\ua7dc <|endoftext|> \u208f's"])


def test_long_texts_are_not_kept():
    ours = PrefixBpe(WORDS)
    rng = random.Random(2)
    for _ in range(300):
        ours.steps("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(1500)))
    assert sum(map(len, [*ours.parts, *ours.words])) < 100_000
    ids = ByteBpe(BYTES)
    for k in range(300):
        ids.encode("ab" * 3000 + str(k))
    assert sum(map(len, [*ids.words, *ids.pieces])) < 100_000


def test_kept_results_are_bounded():
    made = []
    kept = Kept(lambda key: made.append(key) or len(key), most_bytes=80_000)
    for k in [*range(500), *range(450, 500), 0, *["x" * 60] * 3]:
        assert kept[str(k)] == len(str(k))
    assert len(kept) + len(kept.before) <= 200
    assert len(made) == 500 + 1 + 3  # those of the last span are known, the first is not, long ones never are


def test_counts_query(spark, sf_dir, table):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: r for r in queries.op3_token_counts(spark, sf_dir).collect()}
    for r in table("documents").select("doc_id", "text").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        found = got.pop(r.doc_id)
        assert (found.n_bytes, found.n_tokens, found.over_limit) == (len((r.text or "").encode()), n, n > 2048)
    assert not got


def test_budget_questions(spark, documents):
    long = "supercalifragilistic " * 20_000
    tables = prefix_tables(documents([(1, "one two three"), (2, None), (3, long), (3, long)]), WORDS)
    asked = tables.select("doc_id", tokens_at(F.col("steps"), F.lit(7)).alias("at"), longest_within(F.col("steps"), F.lit(2)).alias("n"))
    got = {r.doc_id: (r["at"], r.n) for r in asked.collect()}
    assert got[1] == (2, len("one two ")) and got[2] == (0, 0)
    assert tables.count() == 4 and prefix_tables(documents([]), WORDS).count() == 0
    library = Tokenizer.from_file(WORDS)
    n = got[3][1]
    assert len(library.encode(long[:n]).ids) <= 2 and all(len(library.encode(long[:m]).ids) > 2 for m in range(n + 1, n + 40))


def assert_packed(pieces, wanted: dict, sequence: int = 2048):
    """All ids of all documents once, sequences gapless and full but for powers of two."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(wanted)
    for doc, (ids, copies) in wanted.items():
        found = sorted(by_doc[doc], key=lambda p: p.start)
        covered = collections.Counter(i for p in found for i in range(p.start, p.start + p.length))
        assert set(covered) == set(range(len(ids))) and set(covered.values()) == {copies}
        for p in found:
            assert p.doc_tokens == len(ids) and p.length > 0
            assert bytes(p.ids) == np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
    lengths = {}
    for number, found in by_sequence.items():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        lengths[number] = at
    assert sorted(lengths) == list(range(len(lengths)))
    assert all(n == sequence or n & (n - 1) == 0 and n < sequence for n in lengths.values())
    total = sum(len(ids) * copies for ids, copies in wanted.values())
    assert sum(lengths.values()) == total and len(lengths) <= total // sequence + sequence.bit_length()


def test_pack_query(spark, sf_dir, table):
    library = Tokenizer.from_file(BYTES)
    wanted = {r.doc_id: (library.encode(r.text or "", add_special_tokens=False).ids + [1], 1) for r in table("documents").collect()}
    pieces = packed_pieces(table("documents"), BYTES).collect()
    assert_packed(pieces, wanted)
    got = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op10_pack_sequences(spark, sf_dir).collect()}
    assert all(got[p.doc_id, p.start] == zlib.crc32(bytes(p.ids)) for p in pieces)


def test_pack_odd_rows(spark, documents):
    library = Tokenizer.from_file(BYTES)
    long = "many words " * 30_000
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, long, "en", "a"), (4, "b", "en", "b"), (5, "twice", "en", "b"), (5, "twice", "en", "b")]
    wanted = {r[0]: (library.encode(r[1] or "").ids + [1], 2 if r[0] == 5 else 1) for r in rows}
    assert_packed(packed_pieces(documents(rows), BYTES).collect(), wanted)
    assert_packed(packed_pieces(documents(rows), BYTES, window=64, sequence=64, queues=2).collect(), wanted, 64)
    assert packed_pieces(documents([]), BYTES).count() == 0


def test_workers_keep_no_words_after_packing(spark, documents):
    def kept(batches):
        from vitalgauge.llm import byte_bpe

        for _ in batches:
            held = [k for bpe in byte_bpe._encoders.values() for k in (bpe.pieces, bpe.words)]
            yield pa.RecordBatch.from_pydict({"n": [sum(len(k) + len(k.before) for k in held)]})

    def kept_in_workers():
        rows = spark.range(0, 64, 1, 64).mapInArrow(kept, "n long").collect()
        return sum(r.n for r in rows)

    docs = documents([(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(64)], partitions=64)
    settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4k"}  # so that each worker has a part to cut
    pieces = packed_pieces(docs, BYTES, keep_words=False)
    assert kept_in_workers() > 0
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert {p.doc_id for p in pieces.collect()} == set(range(64))
        assert kept_in_workers() == 0
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_windows_have_the_target_mixture():
    totals = (100_003, 51_001, 7, 0, 2)
    places = Places(totals, window=4096, sequence=512)
    windows = places.windows
    before = [0] * len(totals)
    for w in range(1, windows + 1):
        given = places.given(w).tolist()
        for q, t in enumerate(totals):
            assert 0 <= t * w / windows - given[q] < 1  # the deficit carried on is below one token
            assert given[q] >= before[q]
        before = given
    assert before == list(totals)
    taken = set()
    for q, t in enumerate(totals):
        for start in range(0, t, 777):
            for _, place, length in places.runs(q, start, min(777, t - start)):
                taken.update(range(place, place + length))
    assert taken == set(range(sum(totals)))


def test_sources_beyond_the_queues_take_turns(spark, documents, monkeypatch):
    monkeypatch.setattr("vitalgauge.llm.packing._PART_TOKENS", 1000)
    names = [None, *(f"s{k:02}" for k in range(39))]
    rows = [(100 * k + i, "one two three four five six seven eight nine ten", "en", name) for k, name in enumerate(names) for i in range(30)]
    docs = documents(rows).coalesce(1).sortWithinPartitions("doc_id")
    pieces = packed_pieces(docs, BYTES, window=1024, sequence=64, queues=4).collect()
    ids = Tokenizer.from_file(BYTES).encode(rows[0][1]).ids + [1]
    assert_packed(pieces, {r[0]: (ids, 1) for r in rows}, 64)
    total = len(ids) * len(rows)
    given = collections.Counter()
    windows = collections.defaultdict(collections.Counter)
    for p in pieces:
        windows[p.sequence_id // 16][p.doc_id // 100] += p.length
    for w in range(total // 1024):
        given.update(windows[w])
        due = 30 * len(ids) * (w + 1) * 1024 / total
        assert all(abs(given[k] - due) <= 4 * len(ids) for k in range(40))


def test_deficits_do_not_overflow():
    places = Places((7 * 10**14, 3 * 10**13, 11))
    run = list(places.runs(0, 7 * 10**14 - 10, 10))
    assert sum(n for _, _, n in run) == 10 and all(0 <= p < places.tokens for _, p, _ in run)
