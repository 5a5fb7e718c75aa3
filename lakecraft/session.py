"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions; the session time
# zone is pinned so date arithmetic does not depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "lakecraft",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests use
    ``local[*]`` with a small shuffle-partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is (missing it is an error there). Only in local mode with
    nothing configured (tests) a fresh local directory is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive executor loss on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        conf = tempfile.mkdtemp(prefix="lakecraft-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path as it knows it (for listings and deletes)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def materialize(df, name: str = "table"):
    """Cut lineage by writing ``df`` as a Parquet table in the shared checkpoint
    folder and reading it back.

    Compared with ``Dataset.checkpoint()`` this is one write job (no second
    pass to save the RDD), and later scans get column pruning and real file
    statistics, which AQE uses for join planning. Files survive executor loss.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)      # known schema: no footer-reading job


def expire_scratch(spark: SparkSession, older_than: dt.datetime, prefix: str = "") -> list[str]:
    """Remove tables of :func:`materialize` from the checkpoint folder that were written before
    ``older_than`` and whose name starts with ``prefix``; returns their folders' names. Nothing
    else in the folder is touched. Choose ``older_than`` before the start of every running
    application: they may still read theirs."""
    base = checkpoint_dir(spark)
    fs, place = file_system(spark, base)
    gone = []
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        stale = status.getModificationTime() < older_than.timestamp() * 1000
        if stale and name.startswith(prefix) and re.fullmatch(r".*-[0-9a-f]{32}", name):
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


_SHARED: dict = {}


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the tables in a folder: differs when one of them changes."""
    fs, place = file_system(spark, sf_dir)
    if not fs.exists(place):
        return ()
    found = []
    for s in fs.listStatus(place):
        files = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        found += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(found))


def shared_table(spark: SparkSession, key: tuple, build):
    """Derived input tables (mart, change feed, feature table) built once per
    application and state of the source folder, stored with :func:`materialize`;
    later queries of the session read the stored table until a source file changes.
    ``key`` is (name, folder)."""
    k = (spark.sparkContext.applicationId, *key, source_state(spark, key[1]))
    if k not in _SHARED:
        _SHARED[k] = materialize(build(), "_".join(str(x) for x in key[:1]))
    return _SHARED[k]

