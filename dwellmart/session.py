"""Session settings and the shared folder that jobs keep their intermediate tables in."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "dwellmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE on. Keyword names use ``__`` for dots: ``spark__ui__enabled="false"``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared folder.

    The base is the session's ``spark.checkpoint.dir``, which every executor can reach. Only a session
    without one (a local test) gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="dwellmart-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results, wherever its file system is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders whose path fits a glob, wherever their file system is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return [status.getPath().toString() for status in found or []]


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply settings to one session for the length of a block, then put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
