"""Exactly-once ingestion: one file stream for each table, run until nothing new is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mandrel.sources import bronze


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    with_open = fs.open(p)
    try:
        return bytes(with_open.readAllBytes()).decode()
    finally:
        with_open.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside its place, then renamed."""
    fs, p = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.part")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.rename(beside, p)


def place(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/bronze/{table}"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(place(root, name))


def run(rows: DataFrame, out: str, checkpoint: str):
    """A stream into Parquet that ends by itself. Its checkpoint knows every file it has taken, so landing one again adds nothing."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start(spark: SparkSession, inbox: str, root: str, name: str):
    """The stream of one delivered table."""
    return run(bronze.stream(spark, inbox, name), place(root, name), f"{root.rstrip('/')}/checkpoints/{name}")


def update(spark: SparkSession, inbox: str, root: str, full_refresh: bool = False, tables: tuple[str, ...] = bronze.TABLES) -> None:
    """All streams side by side; full_refresh forgets what was taken and reads the raw files again."""
    running = []
    for name in tables:
        if full_refresh:
            delete(spark, place(root, name))
            delete(spark, f"{root.rstrip('/')}/checkpoints/{name}")
        running.append(start(spark, inbox, root, name))
    for q in running:
        q.awaitTermination()


def land(staging: str, inbox: str, date: str, tables: tuple[str, ...] = bronze.TABLES) -> None:
    """Copy one date's files from staging to the inbox, through Spark's file systems."""
    spark = SparkSession.getActiveSession()
    conf = spark._jsc.hadoopConfiguration()
    util = spark._jvm.org.apache.hadoop.fs.FileUtil
    for name in tables:
        fs, source = _fs(spark, f"{staging}/{name}/extract_date={date}")
        if not fs.exists(source):
            continue
        to, folder = _fs(spark, f"{inbox}/{name}/extract_date={date}")
        to.mkdirs(folder)
        for status in fs.listStatus(source):
            file = status.getPath()
            target = spark._jvm.org.apache.hadoop.fs.Path(folder, file.getName())
            util.copy(fs, file, to, target, False, True, conf)
