"""Transaction archives: zipped CSV members with changing headers, and the vendor master built from them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mandrel.functions.normalize import normalize_address, normalize_name, zip5
from mandrel.session import written
from mandrel.sources import zipped

#: Our column, then the headers it may have; the first that is there counts.
HEADERS: Mapping[str, tuple[str, ...]] = {
    "uei": ("recipient_uei",),
    "name_raw": ("recipient_name_raw",),
    "dba_name": ("recipient_doing_business_as_name",),
    "parent_uei": ("recipient_parent_uei",),
    "parent_name_raw": ("recipient_parent_name_raw", "recipient_parent_name"),
    "address_line_1": ("recipient_address_line_1",),
    "city": ("recipient_city_name",),
    "state": ("recipient_state_code",),
    "zip": ("recipient_zip_4_code", "recipient_zip_code"),
    "country": ("recipient_country_code",),
}
NEEDED = frozenset({"uei", "name_raw", "address_line_1", "city", "state", "zip"})
#: Names that hide a recipient.
HIDDEN = "REDACTED|MULTIPLE RECIPIENTS|PRIVATE INDIVIDUAL|INDIVIDUAL RECIPIENT"


def transactions(spark: SparkSession, folder: str, pattern: str = "FY*_Full_*.zip") -> DataFrame:
    """All members of the archives of a folder, all columns text, absent columns ''. source_file is the archive's name."""
    return zipped.read(spark, folder, dict(HEADERS), NEEDED, pattern)


KEY = ["uei", "name_raw", "address_norm"]


def vendors(tx: DataFrame) -> DataFrame:
    """One row for each (uei, name, address): values of the first transaction by file and content."""
    text = [c for c, t in tx.dtypes if t == "string"]
    tx = tx.withColumns({c: F.trim(c) for c in text})
    shown = ~F.upper("name_raw").rlike(HIDDEN) & F.col("country").isin("USA", "")
    there = (F.col("uei") != "") & (F.col("name_raw") != "") & (F.col("address_line_1") != "")
    tx = tx.where(shown & there).withColumns({
        "name_raw": F.regexp_replace("name_raw", r"\s+", " "),
        "address_norm": normalize_address("address_line_1"),
        "zip5": zip5("zip"),
    })
    rest = ["dba_name", "parent_uei", "parent_name_raw", "address_line_1", "city", "state", "zip5"]
    first = F.min(F.struct("source_file", *rest))
    out = tx.groupBy(*KEY).agg(first.alias("f"), F.count("*").alias("transaction_count"))
    return out.select(*KEY, *[F.col(f"f.{c}").alias(c) for c in rest], "transaction_count", normalize_name("name_raw").alias("name_norm"))


def pair_stats(rows: DataFrame) -> DataFrame:
    """Counts of pairs that share a key, in closed form: C(n, 2) less the pairs that agree."""
    pairs = lambda n: n * (n - 1) / 2

    def within(by: list[str], also: str | None = None) -> DataFrame:
        return rows.groupBy(*by, *([also] if also else [])).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(pairs(F.col("n"))), F.lit(0)).cast("long").alias("p"))

    per = rows.groupBy("uei").agg(F.count("*").alias("rows"), F.countDistinct("name_raw").alias("names"), F.countDistinct("name_norm").alias("norms"))
    total = per.agg(
        F.sum("rows").alias("vendor_rows"), F.count("*").alias("distinct_ueis"), F.count_if(F.col("names") >= 2).alias("ueis_multi_spelling"),
        F.sum(pairs(F.col("rows"))).cast("long").alias("positive_pairs_all"), F.count_if(F.col("norms") >= 2).alias("ueis_multi_after_normalization"),
    )
    same_name, same_norm = within(["uei"], "name_raw"), within(["uei"], "name_norm")
    child = rows.where((F.col("parent_uei") != "") & (F.col("parent_uei") != F.col("uei")))
    rel = child.groupBy("parent_uei", "uei").agg(F.count("*").alias("n")).groupBy("parent_uei").agg(F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("own"))
    rel = rel.agg(F.coalesce(F.sum(pairs(F.col("n")) - F.col("own")), F.lit(0)).cast("long").alias("related_pairs_same_parent"))
    out = total.crossJoin(same_name.withColumnRenamed("p", "sn")).crossJoin(same_norm.withColumnRenamed("p", "so")).crossJoin(rel)  # four one-row tables
    return out.withColumns({"positive_pairs_diff_name": F.col("positive_pairs_all") - F.col("sn"), "positive_pairs_diff_norm_name": F.col("positive_pairs_all") - F.col("so")}).drop("sn", "so")


def _running(groups: DataFrame) -> DataFrame:
    """groups with the running sum of n by (h, uei): hash ranges are summed first and then run through side by side."""
    ranged = groups.withColumn("r", F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 56).cast("int"))
    before = ranged.groupBy("r").agg(F.sum("n").alias("s")).select("r", F.coalesce(F.sum("s").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))  # 256 rows
    inside = Window.partitionBy("r").orderBy("h", "uei").rowsBetween(Window.unboundedPreceding, 0)
    return ranged.withColumn("sofar", F.sum("n").over(inside)).join(F.broadcast(before), "r").withColumn("sofar", F.col("sofar") + F.col("b")).drop("r", "b")


def fitting(groups: DataFrame, target: int) -> DataFrame:
    """Groups (uei, n, h) in the order of h that fit into target, one after another; what doesn't fit is passed over.

    Each round takes all groups up to the first that doesn't fit, and drops those larger than what is left; sizes of
    passed-over groups fall from round to round, so there are at most as many rounds as sizes.
    """
    taken, left, rest = [], target, groups
    while True:
        order = written(_running(rest), "order")
        wall = order.where(F.col("sofar") > left).agg(F.min(F.struct("h", "uei"))).first()[0]
        at = F.struct("h", "uei")
        stop = F.struct(F.lit(wall["h"]).alias("h"), F.lit(wall["uei"]).alias("uei")) if wall else None
        part = order.where(at < stop) if wall else order
        taken.append(part.select("uei"))
        left -= part.agg(F.sum("n")).first()[0] or 0
        if not wall or left <= 0:
            return reduce(DataFrame.unionByName, taken)
        rest = order.where((at > stop) & (F.col("n") <= left)).select("uei", "n", "h")


def sample(rows: DataFrame, target: int, seed: int = 42) -> DataFrame:
    """target rows at most, in key order: whole groups of several spellings first, in hash order while they fit; then rows of other groups, drawn by hash."""
    groups = rows.groupBy("uei").agg(F.countDistinct("name_raw").alias("names"), F.count("*").alias("n")).withColumn("h", F.xxhash64(F.lit(seed), "uei"))
    groups = written(groups, "groups")
    many = fitting(groups.where("names >= 2").select("uei", "n", "h"), target)
    whole = rows.join(many, "uei", "left_semi")
    fill = target - whole.count()
    if fill <= 0:
        return whole.orderBy(*KEY)
    drawn = groups.where("names < 2").orderBy("h", "uei").limit(fill).select("uei")
    return whole.unionByName(rows.join(drawn, "uei", "left_semi").orderBy(*KEY).limit(fill)).orderBy(*KEY)


def numbered(rows: DataFrame) -> DataFrame:
    """vendor_id by key order. The order is total, so the ids are; ranges are counted before they are numbered."""
    ranged = rows.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("p", F.spark_partition_id())
    local = ranged.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(*KEY)))
    sizes = local.groupBy("p").agg(F.count("*").alias("n"))
    before = sizes.select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    return local.join(before, "p").withColumn("vendor_id", F.format_string("V%06d", F.col("b") + F.col("r"))).drop("p", "r", "b")


VENDOR_COLUMNS = ["vendor_id", "name_raw", "name_norm", "dba_name", "address_line_1", "address_norm", "city", "state", "zip5", "transaction_count"]
LABEL_COLUMNS = ["vendor_id", "uei", "parent_uei", "parent_name_raw"]


def write(rows: DataFrame, vendor_path: str, label_path: str) -> None:
    """The vendor table without its answer key, and the key apart from it."""
    rows = numbered(rows).cache()
    rows.select(*VENDOR_COLUMNS).write.mode("overwrite").parquet(vendor_path)
    rows.select(*LABEL_COLUMNS).write.mode("overwrite").parquet(label_path)
    rows.unpersist()
