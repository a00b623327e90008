"""Sinks: replace a table as a whole (K1), partition by a date column (K2),
lay rows out by a cluster column (K3), stage then final folders (K5).

Output goes to a folder under a shared file system: the caller's path, or a
folder under ``spark.checkpoint.dir`` as the cluster sets it. Only a local
master may go without that setting; anywhere else its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import tables
from tidewater.sources.layout import PART, in_parts, key_bounds, numbered
from tidewater.sources.store import Store


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset, a local master gets a temporary folder; on a cluster each
    executor would write to its own disk, so that is refused.

    The SparkContext's checkpoint folder is pointed at it too (when it has
    none), so ``DataFrame.checkpoint()`` writes there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_inside: dict[SparkSession, list] = {}


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job are removed when the job ends, not when the
    driver happens to collect its garbage. Threads of a session may be inside at once;
    the last that leaves restores the setting."""
    with _lock:
        held = _inside.setdefault(spark, [0, spark.conf.get(_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _inside[spark]
                spark.conf.unset(_CLEANUP) if held[1] is None else spark.conf.set(_CLEANUP, held[1])


def publish(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: str | None = None,
            files: int | None = None, sort_within=None, keys: DataFrame | None = None, keep: int = 0,
            stored: str | None = None) -> str:
    """Write ``df`` as Parquet and make it the current version of the table at
    ``path`` in one step (K1, see ``tables``); the folder of the version.

    ``partition_by`` gives one folder per value (K2; NULL lands in the
    default partition and reads back as NULL). ``cluster_by`` lays the rows out
    by that column (K3, see ``layout``) in about ``files`` files, so Parquet
    min/max statistics let readers skip files; with ``partition_by`` too, a
    value that holds most rows is split by cluster-key ranges. ``keys`` may give
    the (partition, cluster) columns of the same rows from a cheaper source. With
    ``stored`` the rows lie in that scratch folder already; it is deleted on the way.
    """
    run = tables.begin(path)
    try:
        with freed(df.sparkSession):
            write_run(df, path, run, partition_by, cluster_by, files, sort_within, keys, stored)
        tables.commit(df.sparkSession, path, run, keep)
    except BaseException:
        tables.abandon(df.sparkSession, path, run)
        raise
    return tables.run_folder(path, run)


#: Turns in which the rows of a large table are laid out.
TURNS = 4


def write_run(df: DataFrame, path: str, run: str, partition_by: str | None = None, cluster_by: str | None = None,
              files: int | None = None, sort_within=None, keys: DataFrame | None = None, stored: str | None = None) -> str:
    """Write the files of a run without making it current; its folder."""
    folder = tables.run_folder(path, run)
    if cluster_by is not None:
        columns = [partition_by, cluster_by] if partition_by else [cluster_by]
        _write_laid_out(df, folder, columns, files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), keys, stored)
        return folder
    # The reference's ORDER BY, kept inside each file (a stored
    # table has no global order; see ``present`` for an ordered export).
    out = df.sortWithinPartitions(*sort_within) if sort_within is not None else df
    w = out.write.format("parquet")
    if partition_by is not None:
        w = w.partitionBy(partition_by)
    w.save(folder)
    return folder


def _write_laid_out(df: DataFrame, folder: str, columns: list[str], n: int, keys: DataFrame | None, stored: str | None) -> None:
    """The rows are worked out once and stored; when their bounds are known they are
    stored by the turn of their part, and each turn is shuffled to its parts and then
    deleted. So on disk there are the rows, once or twice, and a turn's shuffle."""
    spark, turned = df.sparkSession, scratch_path(df.sparkSession, "turned")
    try:
        if keys is None:
            if stored is None:
                stored = scratch_path(spark, "unlaid")
                df.write.option("compression", "zstd").parquet(stored)
                df = spark.read.schema(df.schema).parquet(stored)
            keys = df.select(*columns)
        rows, n = numbered(df, columns, key_bounds(keys, columns, n))
        turns = min(TURNS, n)
        # Part k is in turn k * turns // n, so a turn has a range of parts.
        rows = rows.withColumn("__turn", F.floor(F.col(PART) * turns / n).cast("int"))
        rows.write.option("compression", "zstd").partitionBy("__turn").parquet(turned)
        if stored is not None:
            Store(spark, stored).remove()
        for k in range(turns):
            low, high = -(-k * n // turns), -(-(k + 1) * n // turns)
            mine = spark.read.schema(rows.schema).parquet(turned).where(F.col("__turn") == k).drop("__turn")
            w = in_parts(mine, columns, low, high).write.format("parquet").mode("append")
            (w.partitionBy(columns[0]) if len(columns) > 1 else w).save(folder)
            Store(spark, turned).remove(f"__turn={k}")
    finally:
        for path in filter(None, (stored, turned)):
            Store(spark, path).remove()


def publish_bucketed(df: DataFrame, path: str, table: str, bucket_by: str, buckets: int | None = None,
                     sort_by: str | None = None, mode: str = "overwrite") -> str:
    """Write ``df`` as an external table bucketed and sorted on ``bucket_by``.

    Tables bucketed alike on their join key are read back co-partitioned, so
    a later sort-merge join on that key needs no shuffle (J12 joins three
    staged tables on the PO number). Rows are hash-partitioned into the
    buckets first, so each task writes one file per bucket. The files go to
    ``path`` (the shared folder); only the table's name and bucket spec live
    in the session catalog. ``sort_by`` orders rows within each bucket file
    (default: the bucket column). ``mode`` "append" adds a file to the buckets.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, bucket_by).write.mode(mode).format("parquet").option("path", path)
       .bucketBy(n, bucket_by).sortBy(sort_by or bucket_by).saveAsTable(table))
    return table


def stage_path(base: str, layer: str, name: str) -> str:
    """K5: ``<base>/<layer>/<name>`` with layer 'stage' or 'final'."""
    return os.path.join(base, layer, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def present(df: DataFrame, order) -> DataFrame:
    """R1-R3 for reading or export: a global ``orderBy`` (range shuffle)."""
    return df.orderBy(*order)
