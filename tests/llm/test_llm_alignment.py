"""Token alignment against brute force with the tokenizers' own libraries."""

from __future__ import annotations

import collections
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vitalgauge.llm import alignment, queries
from vitalgauge.llm.alignment import alignments
from vitalgauge.llm.byte_bpe import byte_letters

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    "", None, " ", "  two  spaces ", "a\tb\n\nc\r\n", "it's we'LL <|endoftext|> <s> </s> <0x41> <unk>", "▁ already a mark", "é é ﬁ ½ x²",
    "日本語のテキスト 한국어 😀👨‍👩‍👧 ก็", "\x00\x01\x7f", "a\x0b\x0c\x1cb\x85c\xa0d e　f", "﻿mark", "=" * 90, "ab" * 3000, "n", "word " * 400,
]


def brute(texts):
    """Per text: ids and ends of both sides, or None where a side doesn't keep the bytes."""
    library, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    letters = {c: b for b, c in byte_letters().items()}
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        a_bytes = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
        names = [pieces.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names, strict=True)]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            out.append(None)
            continue
        ends = lambda xs: [sum(map(len, xs[: k + 1])) for k in range(len(xs))]
        out.append((list(zip(a, ends(a_bytes), strict=True)), list(zip(b, ends(b_bytes), strict=True))))
    return out


def expected_rows(rows):
    found = brute([t for _, t in rows])
    links = [[(i, j) for i, x in d[0] for j, y in d[1] if x == y] if d else [] for d in found]
    count = collections.Counter(p for own in links for p in own)
    best = collections.Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for (doc, _), d, own in zip(rows, found, links, strict=True):
        if not d:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        common, groups, low = sorted({x for _, x in d[0]} & {y for _, y in d[1]}), [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, x in side if low < x <= end) for side in d))
            low = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        sums = sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own)
        out.append((doc, len(d[0]), len(d[1]), len(common), len(own), *sums, digest))
    return out


@pytest.mark.parametrize("chunk", [1, 700, 1 << 22])
def test_query(spark, documents, tmp_path, monkeypatch, table, chunk):
    monkeypatch.setattr(alignments, "__defaults__", (chunk,))
    given = [r.text[:400] for r in table("documents").limit(40).collect() if r.text]
    rows = [(i % 37 or None, t) for i, t in enumerate(TEXTS + given + TEXTS[5:9])]
    documents(rows, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_token_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = expected_rows(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert sum(r[1] == 0 for r in expected) >= 4


def test_groups_and_empty_tables(spark, documents):
    docs = documents([(1, "tokenization"), (2, None), (3, "")])
    rows = {r.doc_id: r for r in alignments(docs, A, B).collect()}
    (a, b), = brute(["tokenization"])
    assert rows[1].groups.count(";") == rows[1].n_groups - 1
    assert sorted(rows[1].groups.replace("|", ",").replace(";", ",").split(",")) == sorted(str(i) for i, _ in a + b)
    assert (rows[2].groups, rows[3].groups, rows[2].n_a) == ("", "", 0)
    assert alignments(docs.limit(0), A, B).collect() == []
    stored = docs.limit(0)
    assert alignment.with_link_counts(alignments(stored, A, B)).collect() == []


def test_words_are_dropped_when_links_are_looked_up():
    own = alignment.aligner(A, B)
    batch = own.align(5, [1, 2], [b"some plain words", b"more words"])
    a_words, b_words = own.a_ids.words, own.b_ids.words
    assert a_words and b_words
    pairs = len(batch.column("pairs")[0])
    counts = pa.table({"number": list(range(pairs)), "count": [3] * pairs, "best": [True] * pairs})
    out = alignment._looked_up(pa.Table.from_batches([batch]), counts, ["doc_id"])
    assert out["n_links"].to_pylist() == out["n_best"].to_pylist() == [n // 3 for n in out["count_sum"].to_pylist()]
    assert not (a_words or a_words.before or b_words or b_words.before)
