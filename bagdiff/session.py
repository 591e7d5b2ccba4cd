"""Session helpers: a local session for tests and benches, charset settings, and
the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Spark 4 accepts only a handful of charsets in decode() and raises on malformed
# bytes. The reference decodes with any Java charset and substitutes U+FFFD, which
# these two settings restore.
JAVA_CHARSET_CONF = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bagdiff") -> SparkSession:
    """A local session configured as the tests and ``bench.py`` use it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BAGDIFF_DRIVER_MEMORY", "8g"))
    )
    for k, v in JAVA_CHARSET_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def enable_java_charsets(spark: SparkSession) -> None:
    """Let ``decode`` take any Java charset and replace malformed bytes (session-wide)."""
    for k, v in JAVA_CHARSET_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset and the master is
    local (tests, benches) is a private temporary folder created, and removed when the
    process ends; on a cluster an
    unset folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the setting
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="bagdiff-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)  # private to this process
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (for round-trip output)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
