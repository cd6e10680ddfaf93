"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "orgmetrics") -> SparkSession:
    """A session for one machine; cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _scratch_dir()


@lru_cache(maxsize=1)
def _scratch_dir() -> str:
    return tempfile.mkdtemp(prefix="orgmetrics-")
