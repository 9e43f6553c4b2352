"""Session helpers."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

REPORT_TIME_ZONE = "UTC"

# The JVM leaves methods beyond 8000 bytes of bytecode uncompiled, and wide log rows make
# longer ones. From this limit on Spark splits a stage into smaller methods instead.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("footfall")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", REPORT_TIME_ZONE)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_report_settings(spark: SparkSession, zone: str = REPORT_TIME_ZONE) -> SparkSession:
    """Pin the zone in which days and hours are cut, so results do not follow the machine, and the method limit."""
    for key, value in (("spark.sql.session.timeZone", zone), _METHOD_LIMIT):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


#: Folders made for applications on a local master, by application id.
_MADE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables that every executor can reach.

    Read from ``spark.checkpoint.dir``. Where that is unset, a temporary folder is made once per
    application, but only if driver and executors are one process; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _MADE:
        _MADE[application] = tempfile.mkdtemp(prefix="footfall-")
    return _MADE[application]
