"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "catalog_engine", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs. A running session is
    returned as it is: none of these options touches it."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CATALOG_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir (or the context's
    checkpoint dir). Only in local mode, when neither is set, a private folder
    is made and registered; on a cluster that is an error, as each machine
    would write to a folder of its own."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        jd = sc._jsc.sc().getCheckpointDir()
        d = jd.get() if jd.isDefined() else None
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        d = tempfile.mkdtemp(prefix="catalog-ckpt-")
        sc.setCheckpointDir(d)
        jd = sc._jsc.sc().getCheckpointDir()
        d = jd.get() if jd.isDefined() else d
    return d.rstrip("/")


#: While a table is written: its shuffles are deleted as soon as each step is done, not
#: when the driver collects its garbage; a join whose one side is short in every task (64 MB
#: as shuffled) hashes that side and sorts none; rows dealt by folder are not sorted by it.
WRITING_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


@contextmanager
def writing(spark: SparkSession):
    """The settings of WRITING_CONF for the steps inside, and those before it after them."""
    before = {k: v for k, v in spark.conf.getAll.items() if k in WRITING_CONF}
    for k, v in WRITING_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in WRITING_CONF:
            if k in before:
                spark.conf.set(k, before[k])
            else:
                spark.conf.unset(k)


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def path_fingerprint(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder (any Hadoop file system)."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return f"{path}:missing"
    st = fs.getFileStatus(p)
    size = fs.getContentSummary(p).getLength()
    return f"{path}:{size}:{st.getModificationTime()}"


def cut(df):
    """Reliable checkpoint in the shared folder: what follows starts from files
    that survive any executor."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)
