"""Folders for files between steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which the driver and all executors share; a temporary one only where that is unset and Spark runs in one process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = getattr(spark.sparkContext, "_cuelattice_files", None) or tempfile.mkdtemp(prefix="cuelattice-files-")
        spark.sparkContext._cuelattice_files = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
