"""SparkSession construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are unset, so cluster-wide values (shuffle partitions,
checkpoint folder, AQE) always win over the local defaults used by tests.
"""

from __future__ import annotations

import os
import re
import shlex
import tempfile
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Local defaults; each is applied only when the key is not set already.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
}
# What a cluster's operator sizes; never touched unless the master is local.
CLUSTER_SIZED = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.driver.memory",
                 "spark.ui.enabled")
SUBMIT_FLAGS = {"--driver-memory": "spark.driver.memory", "--master": "spark.master",
                "--executor-memory": "spark.executor.memory", "--name": "spark.app.name"}


def submitted_settings() -> dict[str, str]:
    """Settings given at submit: of the running gateway, or else of the defaults file and the submit
    arguments (reading these does not start a JVM, so its memory can still be chosen)."""
    if os.environ.get("PYSPARK_GATEWAY_PORT") or SparkContext._gateway is not None:
        return dict(SparkConf().getAll())
    found: dict[str, str] = {}
    folder = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(folder, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults, encoding="utf-8") as lines:
            for line in lines:
                parts = line.strip().split(None, 1)
                if len(parts) == 2 and parts[0].startswith("spark."):
                    found[parts[0]] = parts[1].strip()
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    for flag, value in zip(args, args[1:], strict=False):
        if flag in ("--conf", "-c") and "=" in value:
            key, _, found[key] = value.partition("=")
        elif flag in SUBMIT_FLAGS:
            found[SUBMIT_FLAGS[flag]] = value
    return found


def is_local(master: str | None) -> bool:
    """One JVM, whose folders the driver sees; a local-cluster has executors of its own."""
    return master is not None and re.fullmatch(r"local(\[.*\])?", master) is not None


def get_session(master: str | None = None, app_name: str = "quarry",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one.

    Values given at submit always win; then those the caller names in ``conf``; then the local
    defaults, of which a cluster gets only those that do not size it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    given = submitted_settings()
    local = is_local(given.get("spark.master", master or "local[*]"))
    wanted = {k: v for k, v in LOCAL_DEFAULTS.items() if local or k not in CLUSTER_SIZED}
    builder = SparkSession.builder.appName(app_name)
    if master and "spark.master" not in given:
        builder = builder.master(master)
    for key, value in {**wanted, **(conf or {})}.items():
        if key not in given:
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; without one, make a scratch folder if the master is
    local (tests) and refuse otherwise, since executors would not see a folder of the driver."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


@contextmanager
def batches_by_rows(spark: SparkSession):
    """Jobs inside send rows to Python in batches bounded by their number alone, unless the session sets a bound in bytes.

    With its default bound Spark adds up the sizes of all columns again for every row, which takes longer than sending the
    row. For rows of a few numbers, whose batches are small by their number.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key in spark.conf.getAll:
        yield
        return
    spark.conf.set(key, str(2 ** 31 - 1))
    try:
        yield
    finally:
        spark.conf.unset(key)
