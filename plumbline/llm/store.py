"""Tables and files in the folder that driver and executors share.

The folder is what the cluster names in ``spark.checkpoint.dir``. Only where that is unset and the master is a single
local process (tests, a laptop) a temporary folder of this machine is used; on a cluster an unset folder is an error,
since each executor would write to a disk of its own. Intermediate results go there as Parquet, which also cuts
lineage: a lost executor costs a re-read and no recomputation. What is no longer read is discarded at once, all else
when the interpreter ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of a new, unique folder below the shared folder (not created yet)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="plumbline-"))
    path = f"{base.rstrip('/')}/plumbline-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def keep(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and return the written table."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def discard(kept: DataFrame) -> None:
    """Remove a table that :func:`keep` has returned and that nothing reads any more."""
    drop(kept.sparkSession, kept._kept_at)


#: Bounds of one Arrow batch between the JVM and Python, rows and bytes: what a task holds at a time on either side.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def _give_back() -> None:
    """Return freed memory to the system: Python workers live on and would keep each stage's high water mark."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with bounded batches, whose tasks give freed memory back when they end. The bounds are settings
    of the session and stay set: texts of any length then meet in few megabytes, where the defaults gather 10,000."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`shared_dir`, wherever that filesystem is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _made.pop(path, None)


@atexit.register
def _drop_all() -> None:
    """Folders of sessions that still run; a stopped session has nobody left to ask for its filesystem."""
    for path, spark in list(_made.items()):
        try:
            drop(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone
            return


def filesystem(uri: str):
    """(pyarrow filesystem, path) for a URI; used inside Python workers, which have no JVM."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)
