"""Sessions, and the driver's tables as DataFrames."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """The active session or a new one with this library's settings."""
    builder = SparkSession.builder.config(map=CONF | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def isolated(spark: SparkSession) -> SparkSession:
    """A session of its own views and settings over the same cluster."""
    own = spark.newSession()
    for k, v in CONF.items():
        own.conf.set(k, v)
    return own


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Where that is unset, a temporary one, if the session
    is one process; on a cluster it has to be set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="lantern-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        path = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")
