"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from vitalgauge.llm import periodic, queries
from vitalgauge.llm.periodic import Positions, find_runs, periodic_runs


def brute_runs(words, shortest=6, exponent=4):
    found, n = [], len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            smaller = (all(words[k] == words[k + q] for k in range(start, start + length - q)) for q in range(1, p))
            if i > start and length >= max(shortest, exponent * p) and not any(smaller):
                found.append((start, length, p))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    repeated = {i for s, n, p in runs for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in repeated)


def test_runs_of_random_texts():
    rng = random.Random(3)
    seen = 0
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            letters, n = rng.randint(1, 3), rng.randint(0, 40)
            words = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randint(1, 5)
                words = (words[:a] + words[a : a + p] * n)[:n]
            texts.append(words)
        shortest, exponent = rng.choice([(6, 4), (2, 2), (4, 2), (9, 3)])
        found = find_runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]), shortest, exponent)
        for k, words in enumerate(texts):
            expected = brute_runs(words, shortest, exponent)
            assert [tuple(r[1:]) for r in found.tolist() if r[0] == k] == expected, words
            seen += len(expected)
    assert seen > 3000


def test_large_sets_keep_their_order(monkeypatch):
    monkeypatch.setattr(periodic, "_BLOCK", 8)
    rng, kept = random.Random(1), list(range(0, 40, 2))
    ordered = Positions(list(kept))
    for x in rng.sample(range(100, 3000), 900):
        before, after = ordered.around(x)
        assert (before, after) == (max((k for k in kept if k < x), default=-1), min((k for k in kept if k > x), default=-1))
        ordered.add(x)
        kept.append(x)
    assert list(ordered) == sorted(kept) and len(ordered) == len(kept)
    # one word, and a word of golden ratio, with blocks
    assert find_runs(np.zeros(500, np.int64), np.array([500])).tolist() == [[0, 0, 500, 1]]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert [tuple(r[1:]) for r in find_runs(np.array(b), np.array([len(b)]), 2, 2).tolist()] == brute_runs(b, 2, 2)


def test_one_long_text():
    assert find_runs(np.tile(np.arange(7), 40_000), np.array([280_000])).tolist() == [[0, 0, 280_000, 7]]


ROWS = [
    (1, "a a a a a a"), (2, None), (3, ""), (4, " \t\n"), (5, "a a a a a"), (5, "x y x y x y x y z"), (5, "x y x y x y x y z"),
    (6, "b a\x0bA a a a a a c　c é é é é é é"), (7, "w " * 5000), (8, "p q r " * 4 + "p q s s s s s s p"), (None, "n n n n n n n"),
    *((100 + i, " ".join(f"t{(j * j + i) % 17}" for j in range(90))) for i in range(60)),
]


def planted(doc, words):
    h = zlib.crc32(str(doc).encode() if doc is not None else b"")
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 50)
    documents(ROWS, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    expected, periodic_texts = [], 0
    for doc, text in ROWS:
        words = planted(doc, (text or "").encode().split())
        runs = brute_runs(words)
        periodic_texts += bool(runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        hashes = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), collapse(words, runs)))
        expected.append((doc, len(runs), *row, *hashes))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert periodic_texts > 8


def test_odd_rows(spark, documents):
    docs = documents([(1, "a b a b a b a b"), (1, None), (2, "")])
    rows = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), bytes(r.collapsed)) for r in periodic_runs(docs).collect()}
    assert rows == {(1, 8, ((0, 8, 2),), b"a b"), (1, 0, (), b""), (2, 0, (), b"")}
    assert periodic_runs(docs.limit(0)).collect() == []
    assert [tuple(r.runs[0]) for r in periodic_runs(docs, shortest=2, exponent=2).collect() if r.runs] == [(0, 8, 2)]
