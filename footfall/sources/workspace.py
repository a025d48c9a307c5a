"""Folders for data that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder of the session.

    Only a local session without that setting falls back to a temporary
    folder; on a cluster the setting is required because executors must all
    see the folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="footfall-")
    return f"{base.rstrip('/')}/footfall/{label}-{uuid.uuid4().hex}"
