"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "prepkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join handling and ANSI mode on.

    ``master`` and the shuffle partition count are left to the cluster unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given.

    Only a session on a single machine that names none gets a local folder, recorded in
    the session, so that later calls share it. On a cluster that is an error: executors
    would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("prepkit.scratch.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="prepkit-")
        spark.conf.set("prepkit.scratch.dir", base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable where no folder was named; one that was stays."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
