"""Shared plumbing: tables written to the cluster's shared folder, and columns that need no names of the caller's."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Prefix of columns that operators add beside a caller's own columns.
OWN = "__mandrel_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where it is unset, a local session gets one of its own; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="mandrel-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/mandrel-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._mandrel_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    path = getattr(df, "_mandrel_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


#: Bytes of a table's rows up to which it may be sent to every task.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, size: Column) -> DataFrame:
    """A staged table, marked for broadcast if its rows' sizes add up to BROADCAST_BYTES at most; beyond that the join shuffles."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def named(column: str) -> Column:
    """A column by its whole name, dots and quotes included."""
    return F.col("`" + column.replace("`", "``") + "`")


def fields(**types: str) -> T.StructType:
    """A struct of plain types by name."""
    out = T.StructType()
    for name, kind in types.items():
        out.add(name, kind)
    return out


def sliced(batch: pa.RecordBatch, column: int, most: int = 8 << 20, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in slices of `rows` rows or about `most` bytes of one column, one row at least."""
    values = batch.column(column)
    if pa.types.is_binary(values.type) or pa.types.is_string(values.type):
        sizes = pc.binary_length(values).fill_null(0).to_pylist()
    else:
        sizes = [values.slice(k, 1).nbytes for k in range(len(values))]
    at = 0
    while at < batch.num_rows:
        end, size = at, 0
        while end < batch.num_rows and end - at < rows and (end == at or size + sizes[end] <= most):
            size += sizes[end]
            end += 1
        yield batch.slice(at, end - at)
        at = end


#: A key with more than this part of all rows is split, so HOT_KEYS keys are at most; and into how many parts.
HOT_KEYS, PARTS = 1024, 64


def split_join(rows: DataFrame, info: DataFrame, key: str, n: str = "n") -> DataFrame:
    """An inner join on a key that few rows, or a third of all rows, may share. info: one row for each key, with n rows of it.

    The rows of a key with more than 1/HOT_KEYS of all are dealt over PARTS parts by their content, and its one row of info
    goes to each; these keys, HOT_KEYS at most, are literals of the plan. No key has a task of its own.
    """
    limit = (info.agg(F.sum(n)).first()[0] or 0) // HOT_KEYS
    part = f"{OWN}part"
    hot = [F.lit(r[0]) for r in info.where(F.col(n) > limit).select(key).collect()]  # HOT_KEYS at most
    # Without such keys every row is in part 0, by an expression still, so that the plan is the same with and without.
    parts_of = F.when(F.col(key).isin(hot), F.lit(PARTS)).otherwise(F.lit(1)) if hot else F.lit(1)
    dealt = F.pmod(F.xxhash64(*rows.columns), parts_of).cast("int")
    parts = F.when(F.col(n) > limit, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn(part, dealt).join(info.withColumn(part, F.explode(parts)), [key, part]).drop(part)


def scanned(items: Column, state: Column, step: Callable[[Column, Column], Column], out: str, block: int = 64) -> Column:
    """What a running state gives out over an array. state: a struct; step(state, item) -> struct(state, out: array).

    Arrays can't grow in place, so what is given out is gathered block by block: a block's own, then the blocks'.
    Copies are so n * block and (n / block) ** 2 / 2 references, never n ** 2 / 2.
    """
    n = F.size(items)
    firsts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(block)))
    blocks = F.transform(firsts, lambda at: F.slice(items, at, F.lit(block)))

    def one(acc: Column, x: Column) -> Column:
        both = step(acc["state"], x)
        return F.transform(F.array(both), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))[0]

    def many(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["state"].alias("state"), F.array().cast(f"array<{out}>").alias("out")), one)
        return F.transform(F.array(inner), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))[0]

    begin = F.struct(state.alias("state"), F.array().cast(f"array<array<{out}>>").alias("out"))
    whole = F.aggregate(blocks, begin, many, lambda acc: F.flatten(acc["out"]))
    return F.coalesce(whole, F.array().cast(f"array<{out}>"))


def crc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
