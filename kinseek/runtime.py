"""Session helpers: local sessions for tests and benches, lineage cuts on shared storage."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        # Recording the call site of every column operator dominates small plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("kinseek")
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; the driver and all executors reach it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        folder = os.path.join(tempfile.gettempdir(), f"kinseek-checkpoints-{os.getpid()}")
    return folder


def stage(df: DataFrame, **options: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and go on from the written table.

    Later reads of it prune columns and rows. Its files go when the driver's Python ends,
    or earlier by `drop_staged`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{uuid.uuid4().hex}"
    if not _staged(spark):
        atexit.register(drop_staged, spark)
    _staged(spark).append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run meanwhile hand Arrow batches of about `size` bytes at most to Python; a larger row is alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables staged so far; no frame that reads them may be in use."""
    while _staged(spark):
        path = _staged(spark).pop()
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may have ended before
            continue


def _staged(spark: SparkSession) -> list[str]:
    # Kept on the session: functions sent to tasks take this module's globals with them.
    return spark.__dict__.setdefault("_kinseek_staged", [])
