"""Where intermediate tables and streaming checkpoints go.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``. A
temporary folder of the driver machine is only used when the whole session runs
on one machine and the setting is absent.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _temporary(application: str) -> str:
    return "file:" + tempfile.mkdtemp(prefix=f"tallystream-{application}-")


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    return _temporary(spark.conf.get("spark.app.id"))


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
