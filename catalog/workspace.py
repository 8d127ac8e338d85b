"""Where the queries write what they read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is used, which only a local master can share with its tasks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="pagemill-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
