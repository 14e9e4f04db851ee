"""Session helpers.

The library never creates its own cluster settings inside operators; it only
reads what the session already has.  ``get_session`` is for tests, bench and
local runs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local run needs; a cluster session brings its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "loanmart", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is used as is.
    Only in local mode, when it is unset, a scratch folder is made and set; on
    a cluster a folder of the driver's own would be invisible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="loanmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its (Hadoop) file system; storage errors propagate."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@contextlib.contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    """A session setting for the actions inside, put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
