"""Session settings, the shared scratch folder and the parallelism helper."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "spark.checkpoint.dir"


def build_session(app: str = "corvane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session that names none (tests) gets a folder of its own: on a
    cluster a private folder would be another one on every machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get(SCRATCH_KEY, None) or sc.getConf().get(SCRATCH_KEY)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    own = sc.getCheckpointDir()
    if own:
        return own
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError(f"set {SCRATCH_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corvane-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark reaches."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def frozen(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: fixed row placement, no lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with few splits one partition per core before heavy row work.

    A large input has more splits than cores and passes through untouched, so
    no text is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
