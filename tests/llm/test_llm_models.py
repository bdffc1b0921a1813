"""Fitted operators: held-out accuracy, brute force, odd rows."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitalgauge.llm import ann, kneser_ney, language, queries, toxicity
from vitalgauge.llm.ann import Centroids, balanced_centroids, nearest_neighbours, squared
from vitalgauge.llm.common import words
from vitalgauge.llm.kneser_ney import discounts, fit_kneser_ney, model_scores
from vitalgauge.llm.language import fit_language, language_sample, predicted_languages
from vitalgauge.llm.quality import fit_quality, good_documents, quality_scores
from vitalgauge.llm.samples import labelled_sample
from vitalgauge.llm.toxicity import fit_toxicity, ordinal_fit, toxicity_scores

MID = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def remainder(doc_id, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}


# --- quality ----------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, labels):
    got = queries.op8_compression_quality(spark, MID).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    judged = [(r.predicted, labels[r.doc_id].quality) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) >= 0.9 * len(judged)


def test_quality_of_odd_rows(spark, documents):
    good = [(i, f"plain words of text number {i} and some more of them", "en", "a") for i in range(40)]
    bad = [(100 + i, "BUY!! NOW!! " * (i + 3), "en", "a") for i in range(40)]
    docs = documents([*good, *bad, (500, None), (501, ""), (502, "BUY!! NOW!! " * 20_000), (503, "plain words"), (503, "plain words")])
    marks = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)] + [(999, 1, 0), (None, 1, 0), (3, None, 0), (1, 1, 0)]
    model = fit_quality(docs, spark.createDataFrame(marks, LABELS))
    scores = {r.doc_id: r.score for r in quality_scores(docs, model).collect()}
    assert scores[502] < 0.5 < scores[503] and scores[500] == scores[501]
    assert quality_scores(docs, model).count() == docs.count()
    kept = good_documents(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {d for d, s in scores.items() if s >= 0.7}
    assert good_documents(documents([]), model).count() == 0


@pytest.mark.parametrize(("marks", "score"), [([], 1.0), ([(1, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_quality_without_labels_of_both_kinds(spark, documents, marks, score):
    docs = documents([(1, "a text"), (2, None)])
    model = fit_quality(docs, spark.createDataFrame(marks, LABELS))
    assert {r.score for r in quality_scores(docs, model).collect()} == {score}


# --- language ---------------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op5_language(spark, MID).collect()
    held_out = [r for r in got if r.held_out]
    assert len(got) == len(langs) and {r.doc_id for r in held_out} == {d for d in langs if remainder(d, 4) == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held_out) >= 0.97 * len(held_out)


def test_language_weights_equal_the_way_by_landmarks(spark, documents):
    rows = [(i, "the cat and the dog " * (i % 3 + 1), "en") for i in range(20)] + [(50 + i, "der Hund und die Katze " * (i % 3 + 1), "de") for i in range(20)]
    model = fit_language(documents(rows))
    texts = ["the dog", "die katze und", "zzz"]
    assert model.languages == ("de", "en") and model.predict(texts[:2])[0] == ["en", "de"]
    for text in texts:
        present = set(model.alphabet.present(text).tolist())
        grams = {(text.lower()[i : i + n]) for n in (1, 2, 3) for i in range(len(text) - n + 1)}
        if set(text) <= set(model.alphabet.characters):
            assert len(present) == len(grams)
        rows = [i for i, g in enumerate(model.grams.tolist()) if g in present]
        by_hand = model.weights[rows].sum(0) / math.sqrt(len(present)) + model.offsets
        assert np.allclose(by_hand, model.decisions([text])[0], atol=1e-5)


def test_language_of_odd_rows(spark, documents):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(10 + i, "le chat et le chien", "fr") for i in range(5)]
    odd = [(100, None), (101, ""), (102, "123 !?"), (103, "ö"), (104, "le chat " * 50_000), (105, "日本語"), (None, "the dog", None)]
    docs = documents(rows + odd)
    got = {r.doc_id: r for r in predicted_languages(docs, fit_language(docs)).collect()}
    assert [got[d].lang_pred for d in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[104].lang_pred == "fr" and got[None].lang_pred == "en" and got[105].lang_pred in ("en", "fr")
    assert all(0 <= r.score <= 1 for r in got.values())
    none = documents(odd)
    assert {r.lang_pred for r in predicted_languages(none, fit_language(none)).collect()} == {"und"}
    one = documents(rows[:5] + odd)
    assert {(r.lang_pred, r.score) for r in predicted_languages(one, fit_language(one)).collect()} == {("und", 0.0), ("en", 1.0)}
    assert predicted_languages(documents([]), fit_language(docs)).count() == 0


def test_languages_of_large_scripts(spark, documents):
    rng = np.random.default_rng(1)
    kana, han, hangul = ([chr(c) for c in range(low, low + n)] for low, n in ((0x3041, 86), (0x4E00, 600), (0xAC00, 600)))
    kana += [chr(c) for c in range(0x30A1, 0x30FB)]

    def texts(lang, letters, n, size):
        return [("".join(rng.choice(letters, size)), lang) for _ in range(n)]

    learned = texts("ja", kana, 40, 900) + texts("zh", han, 40, 80) + texts("ko", hangul, 40, 80)
    model = fit_language(documents([(i, *row) for i, row in enumerate(learned)]))
    asked = texts("zh", han, 20, 40) + texts("ko", hangul, 20, 40)
    assert model.predict([t for t, _ in asked])[0] == [lang for _, lang in asked]


def test_every_language_is_learned(spark, documents, monkeypatch):
    rows = [(3 * k + i, "".join(chr(0x4E00 + 4 * k + j) for j in (0, 1, 2, i)) * 3, f"l{k:03}") for k in range(230) for i in range(3)]
    model = fit_language(documents(rows))
    assert len(model.languages) == 230
    texts = [t for _, t, _ in rows]
    assert model.predict(texts)[0] == [lang for _, _, lang in rows]
    by_weights = model.decisions(texts)
    monkeypatch.setattr(language, "TABLE", 0)
    assert np.allclose(by_weights, model.decisions(texts), atol=1e-5)


# --- toxicity ---------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark, labels):
    got = queries.op1_toxicity(spark, MID).collect()
    judged = [(r.toxic, labels[r.doc_id].toxic) for r in got if remainder(r.doc_id, 4) == 2 and r.doc_id in labels]
    assert len(got) == 1000 and sum(p > y for p, y in judged) <= 2
    assert sum(p == y for p, y in judged) >= 0.9 * len(judged)


def test_ordinal_fit_reaches_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    grades = np.digitize(x @ [1.5, -1, 0] + rng.logistic(size=400), [0, 1, 3])
    share = rng.uniform(0.5, 2, 400)
    weights, cuts = ordinal_fit(x, grades, share, 4)

    def loss(p):
        edges = np.c_[np.zeros(400), 1 / (1 + np.exp(-(p[3:] - (x @ p[:3])[:, None]))), np.ones(400)]
        chance = edges[np.arange(400), grades + 1] - edges[np.arange(400), grades]
        return -(share @ np.log(chance)) + toxicity.PULL / 2 * p[:3] @ p[:3]

    best = np.r_[weights, cuts]
    assert (np.diff(cuts) > 0).all() and np.abs(weights - [1.5, -1, 0]).max() < 0.4
    for step in np.eye(6) * 1e-3:
        assert loss(best) <= loss(best + step) and loss(best) <= loss(best - step)


def test_toxicity_of_odd_rows(spark, documents):
    clean = [(i, f"kind words about thing {i} and nothing else at all", "en") for i in range(60)]
    bad = [(100 + i, f"about thing {i} " + "idiot " * (1 + i % 20), "en") for i in range(60)]
    docs = documents([*clean, *bad, (500, None), (501, ""), (502, "idiotic idiot"), (503, "kind words " * 40_000), (503, "kind words " * 40_000)])
    marks = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(60)], LABELS)
    model = fit_toxicity(docs, marks)
    got = {r.doc_id: r for r in toxicity_scores(docs, model).collect()}
    assert all(got[100 + i].toxic for i in range(60)) and not any(got[i].toxic for i in range(60))
    assert got[500].toxic == got[501].toxic == got[503].toxic == 0 and got[502].toxic == 1
    assert got[119].severity > got[105].severity > got[100].severity > got[0].severity >= 0
    assert toxicity_scores(docs, model).count() == docs.count()
    untold = fit_toxicity(docs, marks.filter("toxic = 0"))
    assert {(r.severity, r.toxic) for r in toxicity_scores(docs, untold).collect()} == {(0.0, 0)}
    assert toxicity_scores(documents([]), model).count() == 0


def test_toxic_texts_with_a_common_header(spark, documents):
    header = "posted in the forum of our own town today"
    clean = [(i, f"kind words about thing{i} and place{i * 7} and nothing else", "en") for i in range(60)]
    bad = [(100 + i, f"{header} about thing{i} and place{i * 7} " + "idiot " * (1 + i % 20), "en") for i in range(60)]
    docs = documents([*clean, *bad, (500, "what an idiot")])
    marks = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(60)], LABELS)
    model = fit_toxicity(docs, marks)
    got = {r.doc_id: r.toxic for r in toxicity_scores(docs, model).collect()}
    assert "idiot" in model.numbers and got[500] == 1
    assert all(got[100 + i] for i in range(60)) and not any(got[i] for i in range(60))


def test_toxic_texts_of_a_rare_language(spark, documents):
    clean = [(i, f"kind words about thing{i} and place{i * 7}", "en") for i in range(1000)]
    bad = [(2000 + i, f"idiot about thing{i} and place{i * 7}", "en") for i in range(1000)]
    rare = [(4000 + i, f"trottel wegen ding{i} und ort{i * 7}", "de") for i in range(9)]
    docs = documents([*clean, *bad, *rare, (5000, "so ein trottel")])
    marks = [(d, 1, int(d >= 2000)) for d, _, _ in [*clean, *bad, *rare]]
    model = fit_toxicity(docs, spark.createDataFrame(marks, LABELS))
    got = {r.doc_id: r.toxic for r in toxicity_scores(docs, model).collect()}
    assert got[5000] == 1 and all(got[d] for d, _, _ in rare) and not any(got[d] for d, _, _ in clean)


def test_a_rare_language_keeps_features_where_there_are_too_many(monkeypatch):
    monkeypatch.setattr(toxicity, "FEATURES", 10)
    texts = [b"aaa bbb ccc ddd eee fff ggg hhh iii jjj kkk"] * 50 + [b"zzz"] * 9 + [b"kind"] * 60
    used = toxicity.select_features(texts, [1] * 59 + [0] * 60, np.ones(119))
    assert len(used) == 10 and "zzz" in used and "kind" not in used


def test_copies_count_as_one():
    texts = [b"the same text word for word"] * 5 + [b"another one of its kind", b"", b""]
    assert np.allclose(toxicity.copy_weights(texts, [1] * 4 + [0] * 4), [0.25] * 4 + [1, 1, 0.5, 0.5])


# --- language model -----------------------------------------------------------------------------------


class Plain:
    """The same model, counted in Python."""

    def __init__(self, texts):
        tokenised = [plain_tokens(t) for t in texts]
        self.count = collections.Counter(w for t in tokenised for w in t)
        self.pairs = collections.Counter(p for t in tokenised for p in zip([0, *t[:-1]], t, strict=True))
        self.contexts = collections.Counter(w for _, w in self.pairs)
        self.total, self.kinds = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
        for (v, _), c in self.pairs.items():
            self.total[v] += c
            self.kinds[v][min(c, 3) - 1] += 1
        of = lambda counts: discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)))
        self.d, self.e = of(self.pairs), of(self.contexts)
        self.spared = sum(self.e[min(c, 3) - 1] for c in self.contexts.values()) / max(len(self.pairs), 1)

    def single(self, w):
        c = self.contexts.get(w, 0)
        even = (self.spared if self.pairs else 1) / (len(self.count) + 1)
        return (c - self.e[min(c, 3) - 1]) / len(self.pairs) + even if c else even

    def chance(self, v, w):
        if not self.total.get(v):
            return self.single(w)
        c = self.pairs.get((v, w), 0)
        own = c - self.d[min(c, 3) - 1] if c else 0
        return (own + sum(a * b for a, b in zip(self.d, self.kinds[v], strict=True)) * self.single(w)) / self.total[v]

    def scores(self, text):
        tokens, n, size = plain_tokens(text), sum(self.count.values()), len(self.count)
        base = sum(math.log10((self.count[w] + 1) / (n + size + 1)) for w in tokens)
        score = sum(math.log10(self.chance(v, w)) for v, w in zip([0, *tokens[:-1]], tokens, strict=True))
        return len(tokens), sum(self.count[w] > 0 for w in tokens), base, score


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def assert_scored(got, texts, plain):
    assert len(got) == len(texts)
    for r, text in zip(got, texts, strict=True):
        n, known, base, score = plain.scores(text)
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_model_query_against_brute_force(spark, sf_dir, table):
    texts = {r.doc_id: r.text for r in table("documents").select("doc_id", "text").collect()}
    plain = Plain([t for d, t in texts.items() if remainder(d, 7) != 2])
    got = queries.op6_kneser_ney(spark, sf_dir).collect()
    assert_scored(got, [texts[r.doc_id] for r in got], plain)
    assert all(r.held_out == (remainder(r.doc_id, 7) == 2) and r.train_tokens == sum(plain.count.values()) for r in got)
    held_out = [r for r in got if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_model_sums_to_one_with_hot_contexts(spark, documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "_BLOCK", 500)
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 1000)
    texts = [f"the w{i % 97} the W{i % 31} x{i}" for i in range(400)] + [None, "", "the " * 5000, "é\xa0É"]
    docs = documents([(i, t) for i, t in enumerate(texts)])
    model, plain = fit_kneser_ney(docs), Plain(texts)
    assert model.shards.spread  # the most common context is dealt over several shards
    got = model_scores(docs, model).orderBy("doc_id").collect()
    assert_scored(got, texts, plain)
    for v in ("the", 0, "unheard"):
        assert sum(plain.chance(v, w) for w in plain.count) + plain.chance(v, "never seen") == pytest.approx(1)


def test_shards_follow_all_texts_not_the_first_nor_the_session(spark, documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 1000)
    texts = [f"a{i} b{i} c{i} d{i}" for i in range(3000)] + ["plain " * 12_000 + f"hot {i} hot x{i}" for i in range(3)]
    docs = documents([(i, t) for i, t in enumerate(texts)]).orderBy("doc_id")
    shards = kneser_ney.shards_for(docs)
    tokens = sum(len(plain_tokens(t)) for t in texts)
    assert shards.number == -(-tokens // 1000)
    plain, start = (int(x) for x in (kneser_ney._hashes[b"plain"], kneser_ney._START))
    assert shards.spread == {plain: min(-(-4 * 36_000 // 1000), shards.number), start: -(-4 * len(texts) // 1000)}
    context, word = np.full(5000, plain, np.uint64), np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    dealt = np.bincount(shards.of_pairs(context, word), minlength=shards.number)
    assert dealt.max() < 5 * 5000 / shards.number
    assert kneser_ney.shards_for(documents([])) == kneser_ney.Shards(1, {})


def test_each_distinct_word_of_a_block_is_hashed_once(monkeypatch):
    texts = [b"", b" ", b" a  B\x0b\x0cc\x1cd\x85e\xc2\xa0 ", b"\xff\xfe A\x00B", b"\tA\r\nZ", "É é b A".encode(), b"a b " * 50]
    found = [words(t) for t in texts]
    hash_of, asked = xxhash.xxh64_intdigest, []
    monkeypatch.setattr(kneser_ney.xxhash, "xxh64_intdigest", lambda w: asked.append(w) or hash_of(w))
    hashes, context, token, text = kneser_ney.token_places(texts)
    assert sorted(asked) == sorted({w for some in found for w in some})
    own = [[*map(hash_of, some), int(kneser_ney._END)] for some in found]
    assert hashes[token].tolist() == [h for some in own for h in some]
    assert hashes[context].tolist() == [h for some in own for h in [int(kneser_ney._START), *some[:-1]]]
    assert text.tolist() == [i for i, some in enumerate(own) for _ in some]
    assert [len(x) for x in kneser_ney.token_places([])[1:]] == [0, 0, 0]


def test_model_without_training_texts(spark, documents):
    model = fit_kneser_ney(documents([]))
    got = model_scores(documents([(1, "a b"), (1, "a b"), (2, None)]), model).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in got) == [(1, 3, 0, 0.0), (1, 3, 0, 0.0), (2, 1, 0, 0.0)]
    assert model_scores(documents([]), model).count() == 0


# --- nearest neighbours ---------------------------------------------------------------------------------


def test_neighbours_query(spark, sf_dir, table):
    rows = table("embeddings").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = collections.defaultdict(dict)
    for r in queries.op2_posting_lists(spark, sf_dir).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    found = 0
    for i in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((x - x[i]) ** 2).sum(1))
        far[i] = np.inf
        order = np.lexsort((ids, far))[:10]
        mine = [got[ids[i]][k] for k in range(1, 11)]
        assert mine == sorted(mine, key=lambda m: (m[1], m[0])) and ids[i] not in {m[0] for m in mine}
        assert all(s == pytest.approx(far[ids == v][0]) for v, s in mine)
        found += len({m[0] for m in mine} & set(ids[order].tolist()))
    assert set(got) == set(ids[ids % 100 == 0].tolist()) and found >= 0.9 * 10 * len(got)


def test_recall_with_many_lists_and_hot_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 12)).astype("f4").astype(float)
    x[1000:2000] = x[1000]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in nearest_neighbours(df, df.filter("vec_id % 50 = 0")).orderBy("rank").collect():
        got[r.query_id].append(r.vec_id)
    found = 0
    for q in range(0, 3000, 50):
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        order = np.argsort(far, kind="stable")[:10].tolist()
        found += len(set(order) & set(got[q]))
        if 1000 <= q < 2000:
            assert got[q] == [i for i in range(1000, 1012) if i != q][:10]
    assert len(got) == 60 and found >= 0.9 * 600


def test_blocks_of_vectors_and_of_queries_meet_once_each(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(400, 6)), 9 + rng.normal(size=(100, 6))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)

    def rows():
        got = nearest_neighbours(df, df.filter("vec_id % 3 = 0"))
        return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())

    plain = rows()
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "QUERIES", 5)
    assert rows() == plain and len(plain) == 167 * 10
    assert nearest_neighbours(df, df.limit(0)).count() == 0


def test_ranking_keeps_few_rows_of_a_key_before_the_shuffle(spark):
    rows = spark.range(0, 5000, 1, 5).selectExpr("id % 2 AS k", "id")
    got = ann.first_of(rows, 3, ["k"], ["id"])
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(map(tuple, got.collect())) == [(k, 2 * i + k) for k in (0, 1) for i in range(3)]


def test_vectors_that_take_no_part(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(6)] + [(6, [2.0, 1.0])]
    rows += [(10, None), (11, [0.0, 0.0]), (12, [None, 1.0]), (13, [float("nan"), 1.0]), (14, [float("inf"), 1.0]), (15, [1.0]), (16, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest_neighbours(df, df, k=3).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        by[r.query_id].append((r.vec_id, r.score))
    assert set(by) == set(range(7))
    assert by[1] == [(6, 0.0), (0, 1.0), (2, 1.0)] and by[0] == [(1, 1.0), (6, 1.0), (2, 2.0)]
    assert nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
    assert nearest_neighbours(df.filter("vec_id = 0"), df.filter("vec_id = 0")).count() == 0


def test_lists_are_balanced_and_the_walk_finds_the_nearest():
    x = np.random.default_rng(2).normal(size=(4096, 8))
    centroids = Centroids(balanced_centroids(x, 128))
    assert len(centroids.points) == 128
    ids, _ = centroids.nearest(x[:500], 8)
    assert (ids[:, 0] == squared(x[:500], centroids.points).argmin(1)).mean() > 0.97
    row, _ = centroids.homes(x[:500])
    assert np.bincount(row).max() > 1 and set(row) == set(range(500))


def test_batched_products_equal_kernels_text_by_text(spark, table):
    """The scores of the query's model, from n-gram sets and kernel values computed one by one."""
    docs = table("documents")
    model = fit_language(docs, rows=60, landmarks=25)
    texts = ["", "a", "é", *(r.text for r in docs.orderBy("doc_id").limit(30).collect() if r.text)]

    def grams(text):
        lower = text.lower()
        return {lower[i : i + n] for n in (1, 2, 3) for i in range(len(lower) - n + 1)}

    held = [set() for _ in model.landmarks.norms]
    for i, (start, end) in enumerate(zip(model.landmarks.starts, model.landmarks.starts[1:], strict=False)):
        for k in model.landmarks.holders[start:end]:
            held[k].add(int(model.landmarks.grams[i]))
    landmarks = [set(model.alphabet.present(text).tolist()) for _, text in language_sample(docs, 60)]
    assert all(h in landmarks for h in held) and [len(h) ** 0.5 for h in held] == model.landmarks.norms.tolist()
    got = model.decisions(texts)
    for row, text in zip(got, texts, strict=True):
        own = set(model.alphabet.present(text).tolist())
        assert len(own) == len(grams(text))
        kernel = [len(own & h) / ((len(own) or 1) * len(h)) ** 0.5 for h in held]
        np.testing.assert_allclose(row, np.array(kernel) @ model.ridge + model.offsets, atol=1e-9)


def test_samples_take_eligible_texts_and_agree(spark, documents):
    long = "long words of a good text " * 1200
    docs = documents([(i, f"{long}{i}") for i in range(40)] + [(100 + i, f"bad {i}") for i in range(40)] + [(100, "another text of one id"), (7, None)])
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(101, 1), (None, 1), (3, None)], "doc_id long, quality int")
    first = labelled_sample(docs, labels, "quality", 30)
    assert first.labels.count(0) == 30 and first.labels.count(1) == 20 and first.known == {0: 40, 1: 40}
    assert b"another text of one id" not in first.texts  # the shortest text of an id is the one
    for _ in range(2):
        assert labelled_sample(docs.repartition(7), labels.repartition(3), "quality", 30) == first
    assert labelled_sample(docs.limit(0), labels, "quality", 30).texts == []
