"""The stages of the pipeline against plain Python, one by one."""

from __future__ import annotations

import collections

import corpus_pipeline
import numpy as np
import pytest
from test_llm_simhash import groups, plain_fingerprint
from test_llm_tokens import BYTES, assert_packed
from tokenizers import Tokenizer

from vitalgauge.llm import common


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """Rows after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = common.table(spark, sf_dir, "documents")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert name == "pack" or docs.columns == columns
        found[name] = docs.collect()
    return found


def test_quality_keeps_what_is_labelled_good(kept, table):
    labels = {r.doc_id: r.quality for r in table("labels").collect()}
    stays = {r.doc_id for r in kept["quality"]}
    good, bad = ([d for d, y in labels.items() if y == v] for v in (1, 0))
    assert sum(d in stays for d in good) >= 0.95 * len(good) and sum(d in stays for d in bad) <= 0.2 * len(bad)


def test_exact_dedup_keeps_the_largest_id(kept):
    largest = {}
    for r in kept["quality"]:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        largest[key] = max(largest.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in kept["exact_dedup"]) == sorted(largest.values())


def test_near_dedup_keeps_the_smallest_id_of_a_group(kept):
    ids = sorted(r.doc_id for r in kept["exact_dedup"])
    texts = {r.doc_id: r.text for r in kept["exact_dedup"]}
    of = groups([plain_fingerprint(texts[d]) for d in ids])
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted(ids[i] for i in set(of))


def test_mix_takes_each_document_at_most_three_times(kept):
    times = collections.Counter(r.doc_id for r in kept["mix"])
    whole = {r.doc_id: r for r in kept["near_dedup"]}
    assert set(times) <= set(whole) and max(times.values()) <= 3
    assert all(r == whole[r.doc_id] for r in kept["mix"])
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert words(kept["mix"]) == pytest.approx(words(kept["near_dedup"]), rel=0.1)


def test_pack_holds_every_token(kept):
    library, times = Tokenizer.from_file(BYTES), collections.Counter(r.doc_id for r in kept["mix"])
    texts = {r.doc_id: r.text for r in kept["mix"]}
    wanted = {d: (library.encode(t or "", add_special_tokens=False).ids + [1], times[d]) for d, t in texts.items()}
    assert_packed(kept["pack"], wanted)


def test_run_applies_all_stages(spark, sf_dir, kept):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(r.length for r in rows) == sum(r.length for r in kept["pack"])
    ids = lambda rows: collections.Counter(i for r in rows for i in np.frombuffer(r.ids, "<u4").tolist())
    assert ids(rows) == ids(kept["pack"])


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_of_empty_and_odd_documents(spark, sf_dir, documents, name, stage):
    assert stage(spark, documents([], clashing=False), sf_dir).count() == 0
    rows = [(None, None), (1, ""), (2, "good words of a text", None, None), (2, "good words of a text", None, None), (3, "w " * 30_000, "en", "a")]
    odd = documents(rows)
    out = stage(spark, odd, sf_dir)
    assert (name == "pack" or out.columns == odd.columns) and out.count() > 0
