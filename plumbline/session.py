"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode. A pack of rules fused into one
    # generated method easily exceeds that and would then be interpreted; beyond this limit Spark keeps
    # the operators apart and splits their expressions into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that matter for speed to a session made elsewhere."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", SETTINGS["spark.sql.codegen.hugeMethodLimit"])
    return spark


def build_session(master: str | None = None, app: str = "plumbline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting, such as a test, gets a folder of its own; on a cluster the
    executors would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go with the end of each, not when the driver happens to collect its garbage.

    Meant for writes and for collects of frames that are not run again.
    """
    own = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(own)
    spark.conf.set(own, "true")
    try:
        yield
    finally:
        spark.conf.set(own, before)


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
