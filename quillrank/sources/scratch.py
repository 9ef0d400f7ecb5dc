"""Folders for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share: below spark.checkpoint.dir, or where that is unset, as in tests, a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='quillrank-')}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
