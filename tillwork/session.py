"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files once their DataFrames are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tillwork", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none is ``fallback`` — or, on a single-process local
    master only, a fresh folder under ``$TILLWORK_SCRATCH``/the system temp dir —
    set.  On a cluster without the setting this raises: a machine-local
    folder would not survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if fallback is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/…) for checkpoints")
        if fallback is None:
            import tempfile

            base = os.environ.get("TILLWORK_SCRATCH") or tempfile.gettempdir()
            fallback = tempfile.mkdtemp(prefix="tillwork-ckpt-", dir=base)
        conf_dir = fallback
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (a reliable checkpoint computes it
    once): for a frame that several branches of a later plan read, each of which would compute
    it again, as their different columns keep Spark from reusing the exchange."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the session's shuffle partitions: for work that is heavy by the
    row on a compact file, which has fewer splits than the cluster has cores."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder; what is written there goes when the
    session's JVM ends."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, for rounds of a loop: unlike a
    checkpoint it has the size of its files as statistics, not the product of all joins before.
    Without dictionaries: a table that is read once or twice pays more for looking every text up
    when it is written and read than its blocks shrink by; they are compressed as a whole."""
    path = fresh_folder(df.sparkSession, "written")
    df.write.option("parquet.enable.dictionary", "false").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
