"""Session settings the engine relies on."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, name: str = "mandrel", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | more)
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all of a cluster shares, from spark.checkpoint.dir. A local session without it gets one of its own; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="mandrel-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: computed once, read by whatever follows, safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
