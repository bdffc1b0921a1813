"""Writing scorecards and other results by month."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalgauge.sources.shared import remove


def write_by_month(df: DataFrame, path: str, month_column: str = "year_month", within: str = "account_id") -> None:
    """Write a scorecard as Parquet, one folder per month.

    Rows are range-partitioned by month and account before writing, so a large month is written by
    several tasks while each task writes to few folders.
    """
    df.repartitionByRange(month_column, within).write.mode("errorifexists").partitionBy(month_column).parquet(path)


def replace_months(
    df: DataFrame, path: str, months: Collection, run: str, month_column: str = "year_month", within: str = "account_id"
) -> bool:
    """Replace some months of what :func:`write_by_month` wrote by their rows in ``df``; all other months stay.

    ``run`` names the run. A run that is done is marked as such next to the result (``<path>.runs``), and giving it again
    changes nothing; the answer tells whether anything was written. Rows are written aside and take the old
    ones' place when the whole job is done, so a run that fails leaves the old rows, and repeating it starts
    over. A month without rows in ``df`` ends up without rows. Rows of months not named are not written.

    Two runs must not replace the same month at one time.
    """
    spark = df.sparkSession
    if run in runs_done(spark, path):
        return False
    seen = Observation()
    named = df.where(F.col(month_column).isin(list(months)))
    named = named.observe(seen, F.collect_set(F.col(month_column).cast("string")).alias("months"))
    dealt = named.repartitionByRange(month_column, within)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month_column).parquet(path)
    for month in {str(m) for m in months} - set(seen.get["months"]):
        remove(spark, f"{path}/{month_column}={month}")
    spark.range(1).select(F.lit(run).alias("run")).write.mode("append").parquet(_runs(path))
    return True


def runs_done(spark: SparkSession, path: str) -> set[str]:
    """The runs of :func:`replace_months` that are done: a row per run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_runs(path))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return set()
    return {r["run"] for r in spark.read.schema("run string").parquet(_runs(path)).distinct().collect()}


def _runs(path: str) -> str:
    return f"{path.rstrip('/')}.runs"
