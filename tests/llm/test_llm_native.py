"""Exact dedup and mixing: DataFrame operations only."""

from __future__ import annotations

import collections
import hashlib
import re

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from vitalgauge.llm import queries
from vitalgauge.llm.exact_dedup import DigestIndex, first_of_equal_texts
from vitalgauge.llm.mixing import mixed_copies, mixed_documents, source_targets

LONG = "word " * 50_000


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_agrees_with_sql(spark, sf_dir, key):
    assert differences(queries.QUERIES[key](spark, sf_dir), duck(sf_dir), queries.ORACLE_SQL[key]) is None


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_runs_no_python(spark, sf_dir, key):
    plan = queries.QUERIES[key](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def decided(df):
    return {(r.doc_id, r.row): r for r in df.collect()}


def test_groups_of_equal_texts(spark, documents):
    rows = [(1, "Same Text"), (2, "same text"), (7, "SAME TEXT"), (3, "É"), (4, "é"), (5, None), (6, ""), (8, LONG), (9, LONG.upper())]
    found = {r.doc_id: r for r in DigestIndex.open(spark).add(documents(rows)).collect()}
    assert {d: r.keep_id for d, r in found.items()} == {1: 7, 2: 7, 7: 7, 3: 3, 4: 4, 5: 6, 6: 6, 8: 9, 9: 9}
    assert {d for d, r in found.items() if r.kept} == {7, 3, 4, 6, 9}
    assert found[1].group_size == 3 and found[3].group_size == 1
    assert bytes(found[2].digest) == hashlib.sha256(b"same text").digest()


def test_one_of_repeated_rows_and_null_ids(spark, documents):
    rows = [(1, "a")] * 5 + [(None, "a"), (None, "b"), (None, "b")]
    got = DigestIndex.open(spark).add(documents(rows)).collect()
    assert len(got) == 8
    kept = [(r.doc_id, r.keep_id, r.group_size) for r in got if r.kept]
    assert sorted(kept, key=str) == [(1, 1, 6), (None, None, 2)]


def test_later_batches_meet_the_stored_index(spark, documents):
    index = DigestIndex.open(spark, buckets=3)
    index.add(documents([(1, "a"), (2, "b")])).count()
    again = DigestIndex.open(spark, index.path, buckets=3)
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(documents([(10, "A"), (11, "c"), (12, "c")])).collect()}
    assert got == {10: (1, False), 11: (12, False), 12: (12, True)}
    assert again.entries.count() == 3


def test_index_is_read_without_a_shuffle(spark, documents):
    index = DigestIndex.open(spark)
    index.add(documents([(i, str(i % 7)) for i in range(50)])).count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        some = index.entries.groupBy("digest").count()
        plan = some.join(index.entries.hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_empty_and_hot(spark, documents):
    assert DigestIndex.open(spark).add(documents([])).collect() == []
    hot = documents([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)], partitions=8)
    stays = first_of_equal_texts(hot, DigestIndex.open(spark))
    assert stays.columns == hot.columns
    assert stays.count() == 1001 and stays.agg(F.max("doc_id")).first()[0] == 2999


def test_targets_stop_at_three_times_and_are_reshared(spark):
    sizes = {"a": 10, "b": 1, "c": 1000, None: 5}
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weights, total, capped = {"a": 1, "b": 2, "c": 3, None: 1}, sum(sizes.values()), set()
    while True:  # share, stop those above, share again
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        above = {s for s in sizes if s not in capped and level * weights[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert got == pytest.approx({s: 3 * sizes[s] if s in capped else level * weights[s] for s in sizes})


def test_mix_of_odd_rows(spark, documents):
    rows = [(i, "w " * (i % 40), "en", f"s{i % 3}") for i in range(600)]
    rows += [(1000, None, "en", "s0"), (1001, "", "en", "empty"), (1002, LONG, "en", None), (None, "a b", "en", "s1")]
    rows += [(2000, "x y z", "en", "s2")] * 4
    got = mixed_copies(documents(rows, partitions=5)).collect()
    assert len(got) == len(rows)
    taken, target, size = collections.Counter(), {}, {}
    for r in got:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        target[r.source], size[r.source] = r.target, r.source_size
    assert target["empty"] == 0 and size[None] == 50_000
    for source in ("s0", "s1", "s2"):
        assert abs(taken[source] - target[source]) <= 40 * 2 + 0.05 * target[source]


def test_mix_is_the_same_however_it_is_split(spark, documents):
    rows = [(i, "w " * (i * 7 % 50), "en", "abc"[i % 3]) for i in range(500)]
    some, other = (
        sorted((r.doc_id, r.copies) for r in mixed_copies(documents(rows, partitions=n)).collect()) for n in (1, 7)
    )
    assert some == other


def test_mixed_documents_keep_columns_and_copies(spark, documents):
    rows = [(i, "w " * (i % 30 + 1), "en", "ab"[i % 10 == 0]) for i in range(400)]
    docs = documents(rows)
    copies = {r.doc_id: r.copies for r in mixed_copies(docs).collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = collections.Counter(r.doc_id for r in mixed.collect())
    assert got == collections.Counter({d: n for d, n in copies.items() if n})
    assert mixed_documents(documents([])).count() == 0


def test_a_batch_given_again_gets_the_same_answer(spark, documents):
    index = DigestIndex.open(spark, buckets=3)
    old, new = documents([(1, "a"), (2, "b")]), documents([(3, "B"), (4, "c"), (5, "C"), (5, "c"), (6, None)])
    index.add(old, batch="one")
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    first = sorted(map(tuple, index.add(new, batch="two").select(columns).collect()), key=str)
    entries = index.entries.count()
    again = sorted(map(tuple, index.add(new.repartition(5), batch="two").select(columns).collect()), key=str)
    assert first == again and index.entries.count() == entries == 4
    assert sum(r[3] for r in first) == 2
    # the same documents as a batch of another name are known
    assert not any(r.kept for r in index.add(new, batch="three").collect())
    stays = first_of_equal_texts(new, index, batch="two")
    assert sorted(r.doc_id for r in stays.collect()) == [5, 6]


def test_compaction_keeps_the_entries_in_one_file_per_bucket(spark, documents, tmp_path):
    index = DigestIndex.open(spark, str(tmp_path / "index"), buckets=3)
    for k in range(3):
        index.add(documents([(10 * k + i, f"text {k} {i}") for i in range(20)]), batch=str(k))
    small = index.compacted(str(tmp_path / "compacted"))
    rows = lambda i: sorted(map(tuple, i.entries.collect()), key=str)
    assert rows(small) == rows(index) and small.entries.count() == 60
    files = lambda i: len([f for f in (tmp_path / i).iterdir() if f.suffix == ".parquet"])
    assert files("compacted") <= 3 < files("index")
    assert not any(r.kept for r in small.add(documents([(1, "text 0 1")])).collect())
