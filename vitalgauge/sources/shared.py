"""Sub-results that several branches of one plan read.

A sub-result used by several branches is written once, as Parquet, to the shared folder the
cluster names in ``spark.checkpoint.dir`` (or ``SparkContext.setCheckpointDir``), else to one in the
warehouse (``spark.sql.warehouse.dir``), where tables are kept that all read. Later branches
then read only the columns they need, and a lost executor costs no recomputation. Before a folder is used on
a cluster, executors write a few rows to it, which must be found there again; if neither folder is shared in
fact, every function here raises ``NoSharedFolder``. Programs that run on
one machine, such as tests and the benchmark, may call ``use_local_folder`` first.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_FOLDER, _WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"


class NoSharedFolder(RuntimeError):
    """The session names no folder that the driver and all executors share."""


def _one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; the executors of ``local-cluster`` are not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _named_folder(spark: SparkSession) -> str | None:
    """The folder of the setting, unless ``setCheckpointDir`` was called since with another, which overrides it."""
    setting, current = spark.conf.get(_FOLDER, None), spark.sparkContext.getCheckpointDir()
    if setting and current:  # Spark makes its current one in the folder it is given
        path = spark._jvm.org.apache.hadoop.fs.Path
        if path(current).getParent().toUri().getPath() == path(setting).toUri().getPath():
            return setting
    return current or setting


def configured_folder(spark: SparkSession) -> str | None:
    """The named folder; on a cluster the first of it and one in the warehouse that is shared in fact."""
    named = _named_folder(spark)
    if _one_machine(spark):
        return named
    of = spark.sparkContext.applicationId, named
    if of not in _found:
        folders = [named, f"{spark.conf.get(_WAREHOUSE).rstrip('/')}/vitalgauge-shared"]
        shared = next((folder for folder in folders if folder and is_shared(spark, folder)), None)
        if shared is None:
            return None
        target = spark._jvm.org.apache.hadoop.fs.Path(shared)
        _found[of] = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return _found[of]


_found: dict[tuple[str, str | None], str] = {}


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether rows that the executors write to the folder are all found there by the driver and read again."""
    path, parts = f"{folder.rstrip('/')}/probe-{uuid.uuid4().hex}", 2 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, parts, 1, parts).write.parquet(path)
        found = spark.read.schema("id long").parquet(path).count()
        remove(spark, path)
    except (PySparkException, Py4JError):
        return False
    return found == parts


def work_folder(spark: SparkSession) -> str:
    """This application's folder for shared sub-results. A folder without a scheme is one of the default file system."""
    folder = configured_folder(spark)
    if not folder:
        raise NoSharedFolder(f"set {_FOLDER} to a folder that the driver and all executors share")
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def use_local_folder(spark: SparkSession) -> None:
    """Name a temporary folder where none is set and the driver and executors are one machine."""
    if _one_machine(spark) and not configured_folder(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vitalgauge-"))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def share(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df``, computed once and read back from the shared folder. ``options`` go to the Parquet writer."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.options(**options).parquet(path)
    for opened in _open:
        opened.append(path)
    return spark.read.schema(df.schema).parquet(path)


_open: list[list[str]] = []


@contextmanager
def shared_for(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, what ``share`` wrote in it; results must be written by then."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.remove(paths)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_shared(spark: SparkSession) -> None:
    """Remove the shared sub-results of this application. Frames that read them stop working."""
    if configured_folder(spark):
        remove(spark, work_folder(spark))
