"""SimHash near-dedup against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from vitalgauge.llm import queries, simhash
from vitalgauge.llm.components import component_roots
from vitalgauge.llm.simhash import fingerprint, linked, links, near_duplicate_groups, one_of_each_group


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], bits: int = 2) -> list[int]:
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "one", "One TWO", "a b c", "É é\xa0x y\x85z", "a\x1cb c d e", "w " * 70_000, "x y z x y z x y z"]
)
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_query_against_brute_force(spark, sf_dir, table):
    got = {r.doc_id: r for r in queries.op4_simhash_near_dedup(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in table("documents").select("doc_id", "text").collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[d]) for d in ids]
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == dict(zip(ids, prints, strict=True))
    assert {d: r.component_id for d, r in got.items()} == {d: ids[k] for d, k in zip(ids, groups(prints), strict=True)}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("n", [5, 80, 700])
def test_linked_by_neighbours_equals_pairs(monkeypatch, n, bits):
    values = np.unique(np.random.default_rng(n).integers(0, 2**16, n, dtype=np.uint64)) << np.uint64(24)
    some = linked(values, bits)
    monkeypatch.setattr(simhash, "PAIRWISE", 10**9)
    assert (some == linked(values, bits)).all()


def test_index_finds_every_link_and_nothing_else(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for far in (1, 2, 3):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), far)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4))
    roots = {r.a: r.b for r in component_roots(edges).collect()}
    of = groups(prints)
    same = {(i, j) for i in range(len(of)) for j in range(i) if of[i] == of[j]}
    name = [roots.get(s, s) for s in signed]
    assert {(i, j) for i in range(len(of)) for j in range(i) if name[i] == name[j]} == same


def test_large_group_of_near_copies_makes_few_edges(spark):
    base = 0x0123456789ABCDEF
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)} | {base}
    edges = links(spark.createDataFrame([(p,) for p in prints], "fp long")).count()
    assert edges <= 28 * len(prints)


def test_long_chains_meet(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    assert {(r.a, r.b) for r in component_roots(edges).collect()} == {(i, 0) for i in range(1, 201)} | {(501, 500)}


def test_odd_rows(spark, documents):
    rows = [(5, None), (6, ""), (None, " "), (7, "some words here"), (7, "some words here"), (None, "other words there now")]
    got = near_duplicate_groups(documents(rows)).collect()
    assert len(got) == 6
    assert {r.component_id for r in got if r.fp == 0} == {5}
    stays = one_of_each_group(documents(rows))
    assert sorted(stays.select("doc_id").collect(), key=str) == [(5,), (7,), (None,)]
    assert one_of_each_group(documents([])).count() == 0
