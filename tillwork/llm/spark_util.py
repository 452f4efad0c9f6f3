"""Small Spark helpers shared by the operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder that the
    session names in ``spark.checkpoint.dir`` ."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Take the folder from the session.  Only a single-process local master, as in tests,
    gets a fresh temporary one where none is set; a cluster without one is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tillwork-checkpoint-")
    sc.setCheckpointDir(folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with underscores appended until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
