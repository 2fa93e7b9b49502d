"""The folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local master may leave that unset; a temporary folder of the machine then serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="headway-")
    return f"{base.rstrip('/')}/headway-{purpose}-{uuid.uuid4().hex}"
