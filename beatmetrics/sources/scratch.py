"""Folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting it lies under ``spark.sql.warehouse.dir``, which a
    session's driver and executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
