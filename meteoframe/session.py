"""Spark session settings and the shared scratch folder.

On a cluster the session is built by the platform; ``configure`` only sets
options that are still unset, so cluster-wide choices (checkpoint folder,
shuffle partitions) always win over ours.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  ANSI mode is the Spark 4 default and is
# kept: feed text is parsed with try_* functions, never with plain casts.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # EUC-KR feeds are decoded with decode()/csv(encoding=...), which
    # Spark 4 refuses for non-standard charsets unless this is on.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "meteoframe",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("METEOFRAME_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00"}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs rely on, applied to an existing session.

    * EUC-KR feeds: ``decode``/``encode`` and the CSV reader accept that
      charset only with ``spark.sql.legacy.javaCharsets`` on.
    * Feed times are wall-clock (TIMESTAMP_NTZ); formatting goes through the
      session zone, so a zone with daylight saving could shift times that
      fall in a gap.  A non-UTC session is switched to UTC.
    * The shared checkpoint folder is read from the session (set only when
      unset, as in tests).
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    if spark.conf.get("spark.sql.session.timeZone") not in UTC_NAMES:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform (a shared filesystem) and is only
    read here.  When it is unset - local tests - a fresh folder is created and
    registered, so ``DataFrame.checkpoint()`` and scratch tables work.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="meteoframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
