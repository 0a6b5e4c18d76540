"""Session helpers.

Library functions never create a session; these helpers are for tests, the
bench and local runs. ``shared_dir`` returns the folder the cluster names in
``spark.checkpoint.dir`` (or the context's checkpoint dir). Only on a local
master, when nothing is configured, as in tests, it names a fresh temporary
folder, which goes at exit; on a cluster it raises.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "titlepulse", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_dir() -> str:
    d = tempfile.mkdtemp(prefix="titlepulse-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    return d


def shared_dir(spark: SparkSession) -> str:
    """Base folder for lineage cuts, stream checkpoints and stream fixtures."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = _local_dir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/titlepulse/{name}/{uuid.uuid4().hex}"
