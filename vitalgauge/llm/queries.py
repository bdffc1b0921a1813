"""The operators bound to the test tables, with production parameters, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.llm.alignment import alignments, with_link_counts
from vitalgauge.llm.ann import nearest_neighbours
from vitalgauge.llm.common import WORD, id_remainder, table
from vitalgauge.llm.exact_dedup import DigestIndex
from vitalgauge.llm.html_extraction import extracted, fit_extraction
from vitalgauge.llm.kneser_ney import fit_kneser_ney, model_scores
from vitalgauge.llm.language import fit_language, predicted_languages
from vitalgauge.llm.mixing import MOST_COPIES, SEED, SLICE_DIGITS, UNIT, mixed_copies
from vitalgauge.llm.packing import packed_pieces
from vitalgauge.llm.periodic import periodic_runs
from vitalgauge.llm.quality import fit_quality, predicted, quality_scores
from vitalgauge.llm.simhash import near_duplicate_groups
from vitalgauge.llm.token_prefixes import LIMIT, prefix_tables
from vitalgauge.llm.toxicity import fit_toxicity, toxicity_scores
from vitalgauge.sources.shared import share

Query = Callable[[SparkSession, str], DataFrame]


def _held_out() -> Column:
    return id_remainder(F.col("doc_id"), 4) == 2


def _learned_from(rows: DataFrame) -> DataFrame:
    return rows.filter(~_held_out())


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_scores(docs, fit_toxicity(docs, _learned_from(labels)))


def op2_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_tables(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = predicted_languages(docs, fit_language(_learned_from(docs)))
    return predicted.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 7) == 2
    model = fit_kneser_ney(docs.filter(~held_out))
    scores = model_scores(docs, model).withColumn("held_out", held_out).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = DigestIndex.open(spark).add(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality_scores(docs, fit_quality(docs, _learned_from(labels))).withColumn("held_out", _held_out())
    return scores.select("doc_id", "held_out", "score", predicted(F.col("score")).alias("predicted"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, fit_extraction(pages)).withColumn("n_chars", F.length("text").cast("long"))


def _with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of a tenth of the documents with a period from some word on that their id sets."""
    h = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=_with_planted_period)
    fractions = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.expr("CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>)")
    best = F.aggregate("runs", best, lambda best, r: F.when(fractions(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = alignments(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    stored = share(aligned.withColumn("groups_sha256", digest).drop("groups"), "alignments", compression="zstd")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return with_link_counts(stored).select(columns)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_posting_lists,
        op3_token_counts,
        op4_simhash_near_dedup,
        op5_language,
        op6_kneser_ney,
        op7_exact_dedup,
        op8_compression_quality,
        op9_mix_sources,
        op10_pack_sequences,
        op11_html_extraction,
        op12_periodic_runs,
        op13_token_alignment,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op9_mix_sources": rf"""
        WITH RECURSIVE s AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
        w AS (SELECT source, sum(size)::BIGINT AS source_size,
                     (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s GROUP BY source),
        fill(round, bounded) AS (
            SELECT 0, [] ::VARCHAR[] UNION ALL
            SELECT round + 1, (SELECT list(coalesce(source, chr(0)) ORDER BY source) FROM w WHERE
                weight * ((SELECT sum(source_size)::DOUBLE FROM w) - coalesce((SELECT sum(source_size) FROM w v
                             WHERE list_contains(bounded, coalesce(v.source, chr(0)))), 0)::DOUBLE * {MOST_COPIES})
                       / (SELECT sum(weight) FROM w v WHERE NOT list_contains(bounded, coalesce(v.source, chr(0))))
                > {MOST_COPIES} * source_size OR list_contains(bounded, coalesce(source, chr(0))))
            FROM fill WHERE round < 12),
        last AS (SELECT coalesce(arg_max(bounded, round), []) AS bounded FROM fill),
        t AS (SELECT source, source_size, CASE WHEN list_contains(bounded, coalesce(source, chr(0)))
                     THEN {MOST_COPIES}.0::DOUBLE * source_size
                     ELSE ((SELECT sum(source_size)::DOUBLE FROM w) - coalesce((SELECT sum(source_size) FROM w v
                             WHERE list_contains(bounded, coalesce(v.source, chr(0)))), 0)::DOUBLE * {MOST_COPIES})
                       / (SELECT sum(weight) FROM w v WHERE NOT list_contains(bounded, coalesce(v.source, chr(0)))) * weight
                     END AS target FROM w, last),
        u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * {UNIT}) ELSE 0 END::HUGEINT AS units,
                     ('0x' || substr(md5('{SEED}' || coalesce(source, chr(0))), 1, 12))::BIGINT::HUGEINT % {UNIT} AS start FROM t),
        p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY
                     length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)),
                     substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {SLICE_DIGITS}), md5(coalesce(doc_id::VARCHAR, '')), doc_id)::HUGEINT AS place
              FROM s)
        SELECT doc_id, size, source_size, target,
               (size * ((place * units + start) // {UNIT} - ((place - 1) * units + start) // {UNIT}))::BIGINT AS taken
        FROM p JOIN u ON p.source IS NOT DISTINCT FROM u.source""",
}
