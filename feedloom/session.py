"""Session setup and the shared working folder.

Intermediate tables (round-trip logs, drop-folder checkpoints, snapshots)
go under the folder the cluster names in ``spark.checkpoint.dir``. Only a
local-mode session without that setting (tests, the bench) gets a fresh
temporary folder; a cluster session without it is an error, because a
machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "feedloom",
                  driver_memory: str = "6g") -> SparkSession:
    """A session with AQE (coalescing, skew joins) and no UI server.

    In local mode the driver JVM runs the executors too, so its heap (default
    1 GB) is the memory for every task; ``driver_memory`` sizes it.
    """
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared working folder: ``spark.checkpoint.dir`` of the session.

    Sets a temporary folder only for a local-mode session that has none.
    """
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; a shared folder is required on a cluster")
        d = tempfile.mkdtemp(prefix="feedloom-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


_SCRATCH: list[str] = []
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder, of the scope it is made in."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    scope = _SCOPE.get()
    (_SCRATCH if scope is None else scope).append(path)
    return path


def _delete_all(spark: SparkSession, paths: list[str]) -> int:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    done = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done


def clean_scratch(spark: SparkSession) -> int:
    """Delete the working tables made so far outside a scope (once their readers
    are done); returns how many there were. Works on any Hadoop file system."""
    return _delete_all(spark, _SCRATCH)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """The working tables made inside are deleted at the end, and no others:
    for work whose result is written elsewhere by then."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete_all(spark, paths)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    For subtrees that a plan would otherwise recompute; unlike a cache it
    survives the loss of executors. :func:`stage_table` is better where later
    steps read a few columns only.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df, name: str):
    """Write ``df`` once as a Parquet table under the shared folder and read
    it back: later reads get column pruning and filter pushdown, and an
    expensive producer (workbook parsing) runs once."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedloom`` importable on executors (``addPyFile``, like
    ``--py-files``), once per application. Needed by the Python parts that
    run in tasks: the workbook UDTF and the workbook writer."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="feedloom-pkg-"), "feedloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith((".py", ".yaml")):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
