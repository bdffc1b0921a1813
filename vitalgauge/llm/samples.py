"""Bounded samples of labelled documents, for fitting on the driver."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts longer than this are not fitted on (they are scored like all others).
FIT_BYTES = 20_000
#: A label with fewer texts of that length also gets some of its shortest longer ones, up to this length.
LEAST_ROWS, LONG_BYTES = 20, 1 << 20


class Labelled(NamedTuple):
    texts: list[bytes]
    labels: list[int]
    #: Labelled documents there are of each label, for fits that must know how common each is.
    known: dict[int, int]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, fit_bytes: int = FIT_BYTES) -> Labelled:
    """Texts of up to ``rows`` labelled documents of each label 0 and 1, in the order of a hash of the id.

    Only texts of up to ``fit_bytes`` bytes are eligible, and the rows are chosen among these. A label with fewer than ``LEAST_ROWS``
    of them also gets its shortest other texts, up to ``LEAST_ROWS`` of at most ``LONG_BYTES``. So at most 2 x ``rows`` x
    ``fit_bytes`` + 2 x ``LEAST_ROWS`` x ``LONG_BYTES`` bytes reach the driver. Rows without an id or a label, or with other labels, are left
    out. Of an id with several labels the least counts, and of several texts the shortest, then least one; so reruns agree.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    known = known.dropna().filter(F.col("label").isin(0, 1)).groupBy("id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    texts = texts.withColumn("size", F.octet_length("text")).filter(F.col("size") <= max(LONG_BYTES, fit_bytes))
    sizes = known.join(texts.select("id", "size"), "id").groupBy("id", "label").agg(F.min("size").alias("size"))
    mixed = F.xxhash64(F.col("id"), F.lit(label))
    chosen = []
    for value in (0, 1):
        own = sizes.filter(F.col("label") == value)
        short = own.filter(F.col("size") <= fit_bytes).orderBy(mixed, "id").limit(rows).collect()
        missing = max(min(LEAST_ROWS, rows) - len(short), 0)
        long = own.filter(F.col("size") > fit_bytes).orderBy("size", mixed, "id").limit(missing).collect() if missing else []
        chosen += [(r["id"], value, r["size"]) for r in [*short, *long]]
    ids = F.broadcast(docs.sparkSession.createDataFrame(chosen, "id long, label int, size int"))  # at most 2 x rows small rows
    found = texts.join(ids, ["id", "size"]).groupBy("id", "label").agg(F.min("text").alias("text"))
    got = found.orderBy(mixed, "id").limit(2 * max(rows, LEAST_ROWS)).select("text", "label").collect()
    return Labelled([bytes(r["text"]) for r in got], [r["label"] for r in got], counts)
