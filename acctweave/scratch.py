"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str = "stage") -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    The setting is read from the session. Only a ``local`` master without it falls back to a new
    temporary folder; on a cluster a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/acctweave/{name}-{uuid.uuid4().hex}"
