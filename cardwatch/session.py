"""Where jobs may write intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A single-process session without that setting gets one folder of its own.
    A cluster without it is refused: executors on other machines could not read
    a folder of the driver's machine.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="run-")
    return f"file://{_local_root}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/cardwatch/{label}-{uuid.uuid4().hex}"


def sibling_session(spark: SparkSession) -> SparkSession:
    """Another session of the same application with the same settings.

    A session in which a batch was observed cannot be shipped to tasks any more, and freshly fitted models ship theirs; so
    observed batches run in a session beside it.
    """
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, value)
    return other
