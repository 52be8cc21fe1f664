"""Session settings that the operators rely on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def session(app: str = "freshet", **conf: str) -> SparkSession:
    """UTC calendar (labels are UTC), ANSI arithmetic, adaptive execution; ``conf`` uses _ for the dots."""
    builder = SparkSession.builder.appName(app)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    for key, value in (base | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_folders: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share. Where that is unset, a temporary one
    serves a local master, whose executors are the driver's process; on a cluster it is an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = tempfile.mkdtemp(prefix="freshet-")
        atexit.register(shutil.rmtree, _folders[app], ignore_errors=True)
    return "file://" + _folders[app]
