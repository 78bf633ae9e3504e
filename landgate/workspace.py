"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A fresh path under ``root``, or in the shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets one, for all that it writes; on a cluster, where the
    executors would each see a different disk, it has to be made.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="landgate-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/landgate-{purpose}-{uuid.uuid4().hex}"
