"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; they change plans and time rendering, never results.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.broadcastTimeout": "3600",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings above to an existing session."""
    for name, value in SESSION_DEFAULTS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create a session for an application; ``conf`` uses ``_`` in place of ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings.update({name.replace("_", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path all executors can reach, below ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode with the setting absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidelog-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
