"""Session set-up and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "staywise", master: str | None = None, **options: str) -> SparkSession:
    """Session with the options this package relies on; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}  # folder of a local session by application
_SCOPES: list[str] = []  # open ``scratch`` blocks


def work_root(spark: SparkSession) -> str:
    """The application's own folder below ``spark.checkpoint.dir``, the storage that all executors share.

    Only a local session may go without that setting; it then gets one temporary folder, which goes with the process.
    """
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="staywise-")
            atexit.register(shutil.rmtree, _LOCAL[application], ignore_errors=True)
        shared = _LOCAL[application]
    return f"{shared.rstrip('/')}/staywise/{application}"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder in the application's own one."""
    return "/".join([work_root(spark), *_SCOPES, f"{purpose}-{uuid.uuid4().hex}"])


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to work folders inside the block is removed at its end, so nothing read from there may leave it."""
    _SCOPES.append(f"scratch-{uuid.uuid4().hex}")
    folder = "/".join([work_root(spark), *_SCOPES])
    try:
        yield
    finally:
        _SCOPES.pop()
        remove_folder(spark, folder)


def remove_work(spark: SparkSession) -> None:
    """Remove all that this application has written to work folders; call it when its results have been stored."""
    remove_folder(spark, work_root(spark))


def materialize(df: DataFrame, purpose: str, rebalance: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For tables that are read many times (folds, oversampled training rows): a lost executor then costs
    a re-read and never a recomputation of the whole lineage. ``rebalance`` evens out the file sizes first, at
    the price of a shuffle: worth it for a table that an iterative fit reads again and again.
    """
    return _written(df, work_dir(df.sparkSession, purpose), rebalance)


def _written(df: DataFrame, path: str, rebalance: bool) -> DataFrame:
    (df.hint("rebalance") if rebalance else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, purpose: str, rebalance: bool = False) -> Iterator[DataFrame]:
    """``materialize`` for the time of the block; other threads' folders stay, which ``scratch`` does not promise."""
    path = work_dir(df.sparkSession, purpose)
    try:
        yield _written(df, path, rebalance)
    finally:
        remove_folder(df.sparkSession, path)
