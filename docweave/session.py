"""Sessions as this engine wants them, the folder that driver and executors share, and shipping functions to executors."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

_own: list[str] = []


def runs_on_executors(module: str) -> None:
    """A module's functions travel by value, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; on a local master, where all run in one place, one of our own if it names none."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="docweave-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/docweave/{label}-{uuid.uuid4().hex}"


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; give ``shuffle_partitions`` only for local runs, a cluster sets its own."""
    b = SparkSession.builder.appName("docweave")
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}),
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
