"""Sends this package to the executors, which may not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def shared(spark: SparkSession, tag: str) -> str:
    """A new folder that the driver and all executors share, below spark.checkpoint.dir; on one machine, where that isn't set, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="lineloom-")
        atexit.register(shutil.rmtree, folder, True)
    return f"{folder}/{tag}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Once per application; a few kilobytes of source."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lineloom-")
    atexit.register(shutil.rmtree, folder, True)
    path = f"{folder}/lineloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)
