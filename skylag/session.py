"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", app: str = "skylag", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; for scripts and tests.

    On a cluster the caller brings its own session. Nothing in the library
    needs more than what is set here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, for checkpoints and cut tables.

    It is the one named by ``spark.checkpoint.dir``. Only a local session may
    fall back on a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="skylag-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
