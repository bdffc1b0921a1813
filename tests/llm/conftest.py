from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents frame of (doc_id, text[, lang[, source]]) rows, in several partitions, with columns that clash."""

    def made(rows, partitions: int = 3, clashing: bool = True):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(partitions)
        if clashing:
            names = "row size copies digest fp root kept start queue ids score label".split()
            df = df.selectExpr("*", *(f"cast(doc_id AS string) AS {n}" for n in names))
        return df

    return made


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
