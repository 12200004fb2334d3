"""Spark session helpers.

The library never creates a hidden session: every operator takes DataFrames. These
helpers exist for scripts, tests and the bench. Settings a cluster already carries
(shuffle partitions, checkpoint folder) are only filled in when unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs as pafs
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS = 256


def build_session(
    master: str | None = None,
    app_name: str = "cyclecount",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    ANSI mode stays on (Spark 4 default); operators use ``try_*`` parsers.
    The session time zone is pinned to UTC so minute timestamps parse the same
    everywhere.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_partitions(spark: SparkSession) -> None:
    """Shuffles start with ``PARTITIONS`` at least, which adaptive execution joins to parts of its
    advisory size: what one task holds then doesn't grow with the table. A number that the session
    names itself stays, and without coalescing nothing is set."""
    named = spark.conf.get(INITIAL_CONF, None)
    if named is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < PARTITIONS:
        spark.conf.set(INITIAL_CONF, str(PARTITIONS))


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    a cluster session without one is an error (a driver-local folder would not be
    readable by executors). Local-mode runs (tests, bench) without one get a
    fresh scratch folder.
    """
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir() or current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    fallback = fallback or tempfile.mkdtemp(prefix="cyclecount-ckpt-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder named the way Hadoop names it."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)
