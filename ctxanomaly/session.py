"""Session-level helpers: where stage cuts are written, and what Spark can broadcast."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stage cuts, taken from ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the caller (a shared file system
    or object store).  A local-mode session without one uses a folder of its
    warehouse.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "that every executor can read"
            )
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_ctxanomaly"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_RUN_DIR: contextvars.ContextVar[str | None] = contextvars.ContextVar("ctxanomaly_run_dir", default=None)


@contextlib.contextmanager
def run_folder(spark: SparkSession, run_dir: str | None = None):
    """Collect every cut written inside the block under one run folder.

    Nested blocks reuse the outer folder.  Yields the folder path.
    """
    current = _RUN_DIR.get()
    if current is not None:
        yield current
        return
    folder = run_dir or f"{checkpoint_root(spark)}/ctxanomaly/run-{uuid.uuid4().hex}"
    token = _RUN_DIR.set(folder)
    try:
        yield folder
    finally:
        _RUN_DIR.reset(token)


#: Bucketed tables by the folder of their files.
_TABLES: dict[str, list[str]] = {}


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a run folder (recursively) through the Hadoop file system, and
    forget the bucketed tables in it."""
    for table in _TABLES.pop(folder, ()):
        spark.sql(f"drop table if exists {table}")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the files instead of recomputing
    the upstream plan) and gives later scans column pruning and row counts
    from parquet footers.  Inside :func:`run_folder` the cut goes to the
    run's folder.
    """
    spark = df.sparkSession
    base = _RUN_DIR.get() or f"{checkpoint_root(spark)}/ctxanomaly/{uuid.uuid4().hex}"
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def cut_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`cut`, and aggregates of ``df`` collected by the tasks that write
    it (no scan of their own).  They are exact where ``df``'s last stage
    computes them: a task that is run again replaces its figures."""
    seen = Observation()
    out = cut(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), name)
    return out, seen.get


def cut_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """:func:`cut` in ``buckets`` buckets of the keys, sorted by them: one
    shuffle now, and none for later aggregates and joins on these keys."""
    spark = df.sparkSession
    base = _RUN_DIR.get() or f"{checkpoint_root(spark)}/ctxanomaly/{uuid.uuid4().hex}"
    table = f"ctxanomaly_{name}_{uuid.uuid4().hex[:12]}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", f"{base}/{table}").saveAsTable(table, format="parquet")
    _TABLES.setdefault(base, []).append(table)
    return spark.table(table)


def broadcast_limit_bytes(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` as Spark parses it (any unit)."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size statistics put ``df`` (a cut: the size of its
    files) within the broadcast threshold.  No hint is given anywhere; this
    only tells which of two equal plans is the cheaper one."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= broadcast_limit_bytes(df.sparkSession)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ctxanomaly`` importable in the Python workers.

    The tree grower and the scorer run in Python workers, which import this
    package.  The driver zips the package once per application and adds it
    with ``addPyFile`` (harmless when a wheel is installed on the
    executors).  On a cluster the zip is first copied into the shared
    checkpoint folder, so executors fetch it from shared storage.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    local_zip = os.path.join(tempfile.mkdtemp(prefix="ctxanomaly-pyfiles-"), "ctxanomaly.zip")
    with zipfile.ZipFile(local_zip, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    zf.write(path, os.path.relpath(path, base))
    target = local_zip
    if not sc.master.startswith("local"):
        jvm = spark._jvm
        dst = jvm.org.apache.hadoop.fs.Path(
            f"{checkpoint_root(spark)}/ctxanomaly/pyfiles/{uuid.uuid4().hex}/ctxanomaly.zip"
        )
        fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(local_zip), dst)
        target = dst.toString()
    sc.addPyFile(target)
    _SHIPPED.add(app)
