"""Session defaults, the shared scratch folder and staged tables."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


# What the library is tuned for, where nothing else is set. Dates are read in UTC; shuffles start in many partitions, which
# adaptive execution puts together again.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def build_session(app: str = "newsflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``conf`` and, where neither that nor the cluster or the user has set a key, the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in DEFAULTS.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)
    return spark


_own_folders: dict[str, str] = {}
# The folders staged in each open ``staging`` block, outermost first; every thread and task has its own.
_staging: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("staging", default=())


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folders[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared scratch folder that nothing has used yet."""
    return f"{scratch_root(spark)}/newsflow/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write once, with the writer's ``options``, and read back: cuts the lineage and survives the loss of executors."""
    path = new_folder(df.sparkSession, label)
    if _staging.get():
        _staging.get()[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes what was staged inside the block when it ends; results must be written or collected by then.

    Operators that return a DataFrame over staged tables leave them to the block they are called in.
    """
    with staged_folders() as folders:
        try:
            yield
        finally:
            delete_folders(spark, folders)


@contextlib.contextmanager
def staged_folders() -> Iterator[list[str]]:
    """Gives the list of folders that are staged inside the block, for an owner that deletes them later."""
    own: list[str] = []
    token = _staging.set((*_staging.get(), own))
    try:
        yield own
    finally:
        _staging.reset(token)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged folders and forget them."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    while folders:
        folder = hadoop.Path(folders.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; the caller's own come back behind it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def arrow_batches(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """Arrow batches of ``rows`` at most for the jobs inside; where the session has fewer, these stay."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    return settings(spark, {key: str(min(rows, now) if now > 0 else rows)})


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent jobs at the same time, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(contextvars.copy_context().run, inheritable_thread_target(job)) for job in jobs]
        return [job.result() for job in running]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, used before anything is broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's automatic broadcast threshold in bytes, 0 when switched off."""
    size = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return max(0, int(size))


def spread(df: DataFrame, limit: int = 256 << 20) -> DataFrame:
    """A small input in one piece per core.

    One file with one row group is one task, whatever the work per row. Inputs above ``limit`` bytes have
    enough splits of their own and are left alone.
    """
    if estimated_bytes(df) > limit:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
