"""Intermediate results of a job, and narrowing large tables to a measured set of keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.operators import sift

# A key set is broadcast only when it was counted and stays within both bounds.
MAX_BROADCAST_KEYS = 500_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


class Scope:
    """Folders staged in one job, or one part of it."""

    def __init__(self, outer: Scope | None):
        self.outer, self.folders = outer, []

    def add(self, folder: str) -> None:
        self.folders.append(folder)

    def released(self) -> str:
        """Hand what was staged last to the scope outside, where there is one, and return its folder."""
        folder = self.folders.pop()
        if self.outer is not None:
            self.outer.add(folder)
        return folder


# The innermost open scope of this thread or task; threads started by ``staged_together`` share it.
_scope: ContextVar[Scope | None] = ContextVar("tallyroom_stage_scope", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, or set on the Spark context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[Scope]:
    """Delete what was staged inside once the results have been written, or the job has failed.

    Jobs in different threads of one driver have scopes of their own.
    """
    scope = Scope(_scope.get())
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        for folder in scope.folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame) -> DataFrame:
    """Write a result that several outputs read to the shared folder and read it back.

    The table outlives lost executors, cuts the lineage, and its file sizes let the planner
    choose joins from real figures.
    """
    spark = df.sparkSession
    target = f"{scratch_folder(spark)}/tallyroom-stage-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.add(target)
    df.write.mode("error").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def staged_together(**frames: DataFrame) -> dict[str, DataFrame]:
    """Stage independent results at the same time: small ones do not wait for large ones.

    The threads take over the caller's scope, job group, tags and scheduler pool.
    """
    session = next(iter(frames.values())).sparkSession
    stage = inheritable_thread_target(session)(staged)
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        started = [pool.submit(copy_context().run, stage, frame) for frame in frames.values()]
        return dict(zip(frames, [one.result() for one in started], strict=True))


def measured(keys: DataFrame, on: str = "user_id") -> tuple[int, int]:
    """Rows and bytes of a key column taken from a staged table.

    One column is read and every task returns one row; a ``limit`` would instead gather that
    many rows of each partition in a single task.
    """
    key = F.col(on).cast("string")
    size = keys.agg(F.count("*").alias("n"), F.sum(F.octet_length(key)).alias("bytes")).first()
    return size["n"], size["bytes"] or 0


def fits_broadcast(
    keys: DataFrame,
    on: str = "user_id",
    max_keys: int = MAX_BROADCAST_KEYS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure a key set taken from a staged table and hold it against the limits."""
    n, size = measured(keys, on)
    return n <= max_keys and size <= max_bytes


def kept(rows: DataFrame, keys: DataFrame, on: str = "user_id") -> DataFrame:
    """Rows of a key set that ``fits_broadcast`` has passed; the others go at the scan."""
    return rows.join(F.broadcast(keys.select(on)), on, "left_semi")


def sieve(keys: DataFrame, on: str = "user_id", max_keys: int = sift.MAX_KEYS) -> Callable[[DataFrame], DataFrame]:
    """Drops most rows of other keys at the scan, for key sets that ``fits_broadcast`` has turned down.

    What is broadcast is a filter of bounded size (``operators.sift``), staged once for all tables
    that go through the sieve; beyond ``max_keys`` keys rows pass unchanged. Some rows of other keys
    slip through: callers join or filter by the key afterwards, so only the road differs.
    """
    if measured(keys, on)[0] > max_keys:
        return lambda rows: rows
    words = staged(sift.key_words(keys, on))
    return lambda rows: sift.sifted(rows, words, on)


def narrowed(rows: DataFrame, keys: DataFrame, on: str = "user_id") -> DataFrame:
    """Drop rows of other keys at the scan: all of them when ``keys`` is small enough to broadcast,
    else those that a ``sieve`` holds back. ``keys`` should come from a staged table: it is counted
    here and read again by the join.
    """
    return kept(rows, keys, on) if fits_broadcast(keys, on) else sieve(keys, on)(rows)
