"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# A failing plan raises the first, a failing task or file system the second.
SPARK_ERRORS = (PySparkException, Py4JJavaError)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # state of the streaming queries lives on disk, not in the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "transitloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings every job relies on; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent jobs at the same time, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [done.result() for done in running]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path, unique per call, that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. A machine-local folder is used only
    in local mode, where driver and executors are one process.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        parent = tempfile.mkdtemp(prefix="transitloom-")
    return f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made under the shared one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def folders_in(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders in a folder that begin with ``prefix``; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, f"{prefix}*")) or ()
    return [f.getPath().getName() for f in found if f.isDirectory()]
