"""Exact deduplication against a persistent digest index.

The index is a table of SHA-256 digests, bucketed by digest and sorted within each bucket. New
documents are reduced to digests, the digests to one row each (combined before the shuffle, so a
text that a third of all rows share is one row per task), and those rows meet the index in a
sort-merge anti-join that reads it bucket by bucket without shuffling it. What is left is appended.

Everything is DataFrame operations. Texts are read once and never shuffled.

Defined cases: a null text is an empty text; a null id is smaller than any other; of repeated rows
with one id and one text exactly one is kept; an empty table gives no rows and appends nothing;
columns other than the id and the text are neither read nor returned.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.llm.common import ascii_lower, numbered
from vitalgauge.sources.shared import share, shared_path

_ENTRY = "digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case, in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A digest index at ``path``, known to the session's catalog as ``name``."""

    spark: SparkSession
    name: str
    path: str

    @classmethod
    def open(cls, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """The index stored at ``path``, or a new one; without a path, a new one in the shared folder.

        ``buckets`` holds for a new index, and must be given again when it is opened later; by default it
        is the number of shuffle partitions, so that new digests are dealt as any other shuffle is.
        """
        path = path or shared_path(spark, "digest-index")
        name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, name, path)

    @property
    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def buckets(self) -> int:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").filter("col_name = 'Num Buckets'").first()
        return int(described["data_type"])

    def add(
        self,
        docs: DataFrame,
        id_column: str = "doc_id",
        text_column: str = "text",
        row_column: str | None = None,
        batch: str | None = None,
    ) -> DataFrame:
        """Append the digests of ``docs`` that are new, and tell what became of each document.

        Returns per document: the id, ``digest``, ``group_size`` (rows of this batch with the same
        text), ``keep_id`` (the id that stands for the text), ``kept`` and ``row``, the document's value
        of ``row_column``, which must be unique and stable, or a number given here. Of equal texts within
        the batch the largest id stays; a text known from an earlier batch keeps its earlier id and none of
        its new documents.

        ``batch`` names the documents. If what comes after this call fails, calling again with the same documents and the same
        name gives the same answer and appends nothing twice; without a name each call is a batch of its own.
        """
        batch = batch or uuid.uuid4().hex
        digests = docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            text_digest(F.col(text_column)).alias("digest"),
            *([F.col(row_column).alias("row")] if row_column else []),
        )
        rows = share(digests, "digests") if row_column else numbered(digests, "digests")[0]
        rank = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("rank"), "row")
        groups = rows.groupBy("digest").agg(F.max(rank).alias("keep"), F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        groups = share(groups.select("digest", "group_size", "keep_id", F.col("keep.row").alias("keep_row")), "digest-groups")
        new = groups.join(self.entries.hint("merge"), "digest", "left_anti")
        self._append(new.select("digest", "keep_id", "keep_row", F.lit(batch).alias("batch")))
        # the row that stays is this call's: numbers of rows may differ from those of an earlier call for this batch
        entries = self.entries.select("digest", "keep_id", (F.col("batch") == batch).alias("own"))
        known = share(groups.drop("keep_id").join(entries.hint("merge"), "digest"), "digests-known")
        kept = F.col("own") & (F.col("keep_row") == F.col("row"))
        return rows.join(known, "digest").select("doc_id", "row", "digest", "group_size", "keep_id", kept.alias("kept"))


    def compacted(self, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """A copy at a new ``path`` (by default in the shared folder) with one sorted file per bucket, whatever the number of batches.

        Each batch adds a file to each bucket it has digests of. This index stays as it is, until the caller drops it.
        """
        copy = DigestIndex.open(self.spark, path, buckets or self.buckets)
        # read as plain files: of a bucketed scan Spark leaves out the dealing by bucket, and then the buckets
        copy._append(self.spark.read.schema(self.entries.schema).parquet(self.path))
        return copy

    def _append(self, entries: DataFrame) -> None:
        dealt = entries.repartition(self.buckets, "digest").write.format("parquet").mode("append")
        dealt.bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name)


def first_of_equal_texts(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, after adding them to ``index``."""
    rows, row = numbered(docs, "exact-dedup")
    stays = index.add(rows, row_column=row, batch=batch).filter("kept").select(F.col("row").alias(row))
    return rows.join(stays, row, "left_semi").select(*docs.columns)
