"""Where intermediate files may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder the session names.

    Only a local session without that setting falls back to the machine's
    temporary folder; on a cluster executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tabsieve-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
