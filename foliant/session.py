"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def build_session(app: str = "foliant", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; extra settings win."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in settings.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for cut lineage and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session inside one
    JVM, such as that of a test, may do without; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _OWN.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="run-"))
