"""A session for tests, the benchmark and small runs, and a place for files that all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Only a local session may do without that setting and gets a temporary
    folder: no other executor would see one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="storewright-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


# On a cluster the caller brings the session.
def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app_name: str = "storewright") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
