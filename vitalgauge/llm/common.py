"""Small helpers of several operators."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.sources.shared import share

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def numbered(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df``, stored in the shared folder with a number for each row, and that column's name.

    The numbers are made once, as they would differ from one evaluation to another; so decisions about
    single rows can be joined back, and rows that agree in all columns stay apart.
    """
    row = free_name(df, "row")
    return share(df.withColumn(row, F.monotonically_increasing_id()), label, compression="zstd"), row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(batch: pa.RecordBatch, column: str, step: int = 256) -> Iterator[bytes]:
    """The texts of a batch in UTF-8, null as empty, taken over a few rows at a time."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    for start in range(0, len(values), step):
        for value in values.slice(start, step).to_pylist():
            yield value or b""


def give_back() -> None:
    """Give the system what Arrow's pool holds unused: Spark keeps a worker for later tasks, next to whose memory it would stay."""
    pa.default_memory_pool().release_unused()


def words(text: bytes) -> list[bytes]:
    """The words of a text with A-Z in lower case: what bytes know as letters and white space is ASCII's."""
    return text.lower().split()
