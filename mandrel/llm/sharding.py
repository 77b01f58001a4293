"""Sharding by balanced label propagation, with DataFrame functions only.

Documents with equal texts are neighbours of each other. A row starts with the shard that its id hashes to. Each
round, a join brings every row the shard that holds most of its neighbours, ties by a hash of text and shard, or
several for a text that needs several; a row that is elsewhere asks to move there. A quota admits as many movers as
a shard has room for when others leave, in hash order, whole groups of copies together. The state after the last round
is the result, so with no rounds copies stay where their ids put them, and each round cuts fewer links. Then rows
without a neighbour, which may be anywhere, and the last groups of a shard that holds more than its exact size, side by
side, fill the other shards up: counts are at most one apart (law `rows`).

The neighbours of a text are counted, not listed: rows of one text that began at one place move as one node, and
a text has PLACES nodes at most, whatever its copies. So a text that a third of all documents have costs PLACES
rows in a round, its nodes fill shard after shard, and no task reads all of its rows. Group, not pair, is what is
joined; the links that a state cuts follow from the counts (`cut_links`).

A group of copies is parted when it is larger than a shard, when rounds end before room is found for the rest of
it, or where a shard's exact size ends inside it; `propagate` gives the cut links of every round.

Only ids, sizes and hashes move, never texts. Texts are equal when their 64-bit hash, checksum and size are.

Defined results: a null text has size 16 and links with nothing; empty texts are equal; null ids hash as
such; repeated rows take slots of their own; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandrel.llm.common import release, staged

SHARDS, ROUNDS = 40, 8
#: Nodes of one text at each shard that its rows may begin with.
PIECES = 4
#: What a shard may hold while labels move, as a multiple of its exact size.
SLACK = 1.25
#: Groups over this part of a shard's size move node by node, others as a whole.
WHOLE = 16
#: Hash ranges that a shard's rows are numbered in, more where a range would hold more rows than this.
RANGES, RANGE_ROWS = 64, 1_000_000

_TEXT = ["hash", "text_crc32", "size"]
_NODE = [*_TEXT, "place"]


def nodes(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of one text that begin at one place, for texts with copies: n rows, of `copies` in all, now at a shard."""
    each = rows.where("hash IS NOT NULL").groupBy(*_NODE).agg(F.count("*").alias("n"))
    texts = each.groupBy(*_TEXT).agg(F.sum("n").alias("copies")).where("copies > 1")
    return each.join(texts, _TEXT).withColumn("now", F.pmod("place", F.lit(shards)).cast("int"))


def cut_links(state: DataFrame) -> int:
    """Pairs of equal texts that lie in different shards."""
    held = state.groupBy(*_TEXT, "copies", "now").agg(F.sum("n").alias("n"))
    same = held.groupBy(*_TEXT, "copies").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("same"))
    return same.agg(F.sum((F.col("copies") * (F.col("copies") - 1) - F.col("same")) / 2).cast("long")).first()[0] or 0


def _quota(total: int, shards: int) -> list[int]:
    return [total * (s + 1) // shards - total * s // shards for s in range(shards)]


def _of(values: list, at: str, kind: str = "long") -> F.Column:
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col(at))


def admitted(asks: dict[tuple[int, int], int], free: list[int]) -> list[float]:
    """The part of its movers that each shard takes, so that none gets more than it has free and others leave.

    asks: movers by (from, to). All are let in first; parts then shrink until every shard's sum is right.
    """
    shards = range(len(free))
    enter = [sum(n for (_, to), n in asks.items() if to == s) for s in shards]
    part = [1.0] * len(free)
    for _ in range(200):
        leave = [0.0] * len(free)
        for (at, to), n in asks.items():
            leave[at] += part[to] * n
        part = [min(part[s], max(0.0, (free[s] + leave[s]) / enter[s])) if enter[s] else 1.0 for s in shards]
    return part


def _round(state: DataFrame, quota: list[int], shut: list[bool], salt: int) -> tuple[DataFrame, list[bool]]:
    shards = len(quota)
    load = {r["now"]: r["n"] for r in state.groupBy("now").agg(F.sum("n").alias("n")).collect()}  # one row for each shard
    held = state.groupBy(*_TEXT, "now").agg(F.sum("n").alias("held")).withColumn("pull", F.struct("held", F.xxhash64("hash", "now").alias("tie"), F.col("now").alias("shard")))
    # The shards with the most neighbours, but for those that took nobody; several for a text that needs more than one.
    ranked = F.sort_array(F.collect_list("pull"), asc=False)
    goals = held.where(~_of(shut, "now", "boolean")).groupBy(*_TEXT).agg(F.transform(ranked, lambda x: x["shard"]).alias("goals"))
    wants = state.join(goals, _TEXT, "left").withColumn("goals", F.slice("goals", 1, F.ceil(F.col("copies") / F.lit(max(min(quota), 1))).cast("int")))
    moves = (F.size("goals") > 0) & ~F.array_contains("goals", F.col("now"))
    goal = F.get("goals", F.pmod(F.xxhash64(F.lit(8), *_NODE), F.size("goals")).cast("int"))
    one = F.when(F.col("copies") * WHOLE <= min(quota), F.xxhash64(F.lit(salt), *_TEXT)).otherwise(F.xxhash64(F.lit(salt), *_NODE))
    lot = F.pmod(one, F.lit(1 << 20)) / F.lit(float(1 << 20))
    wants = staged(wants.select(*_NODE, "copies", "n", "now", F.when(moves, goal).alias("goal"), lot.alias("lot")), "wants")
    asks = wants.where("goal IS NOT NULL").groupBy("now", "goal").agg(F.sum("n").alias("n")).collect()  # one row for each two shards
    part = admitted({(r["now"], r["goal"]): r["n"] for r in asks}, [int(quota[s] * SLACK) - load.get(s, 0) for s in range(shards)])
    enters = F.col("goal").isNotNull() & (F.col("lot") < _of(part, "goal", "double"))
    after = staged(wants.select(*_NODE, "copies", "n", F.when(enters, F.col("goal")).otherwise(F.col("now")).cast("int").alias("now")), "state")
    release(wants)
    return after, [x < 0.01 for x in part]


def propagate(rows: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS) -> tuple[DataFrame, list[int]]:
    """Nodes with the shard where each is after the rounds, and the links cut before the first and after each; without cut links rounds end."""
    state = staged(nodes(rows, shards), "state")
    cuts, shut = [cut_links(state)], [False] * shards
    while cuts[-1] and len(cuts) <= rounds:
        after, shut = _round(state, _quota(total, shards), shut, len(cuts))
        release(state)
        state = after
        cuts.append(cut_links(state))
    return state, cuts


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: counts at most one apart, copies together where a shard has room for them."""
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("hash"), F.pmod(F.xxhash64(F.lit(1), F.col(doc_id)), F.lit(shards * PIECES)).cast("int").alias("place"),
    )
    rows = staged(rows, "rows")
    total = rows.count()
    quota = _quota(total, shards)
    state, _ = propagate(rows, total, shards, rounds)
    ranges = max(RANGES, total // (shards * RANGE_ROWS))
    content = ["key", "part", "doc_id", "text_crc32", "size"]
    # Rows of a text that is large for a shard are numbered in several ranges; others stay side by side.
    spread = F.when(F.col("copies") * WHOLE > min(quota), F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(ranges))).otherwise(F.lit(0)).cast("int")
    placed = staged(rows.join(state.select(*_NODE, "now", "copies"), _NODE, "left").withColumn("part", spread), "placed")
    kept = placed.where("now IS NOT NULL").withColumn("key", F.xxhash64(F.lit(4), *_TEXT))
    kept = _ranked(kept.select("now", *content), ["now"], F.pmod("key", F.lit(ranges)), content, "linked")
    # At most one row for each shard goes to the driver; quotas are the exact sizes of the law.
    load = {r["now"]: r["n"] for r in kept.groupBy("now").agg(F.count("*").alias("n")).collect()}
    taken = [min(load.get(s, 0), quota[s]) for s in range(shards)]
    room = [0]
    for s in range(shards):
        room.append(room[-1] + quota[s] - taken[s])
    fits = F.col("position") < _of(quota, "now")
    stay = kept.where(fits).select("doc_id", "size", "text_crc32", F.col("now").alias("shard"), F.col("position").alias("slot"))
    # Rows that are linked with nothing, and what ids alone crowd over a quota, fill the shards up.
    free = placed.where("now IS NULL").withColumn("key", F.xxhash64(F.lit(3), "doc_id"))
    pool = free.select(*content).unionByName(kept.where(~fits).select(*content))
    pool = _ranked(pool, [], F.pmod("key", F.lit(ranges * shards)), content, "pool")
    ends = F.array(*[F.lit(v).cast("long") for v in room[1:]])
    pool = pool.withColumn("shard", F.size(F.filter(ends, lambda end: end <= F.col("position"))))
    slot = _of(taken, "shard") + F.col("position") - _of(room, "shard")
    return stay.unionByName(pool.select("doc_id", "size", "text_crc32", F.col("shard"), slot.alias("slot")))


def _ranked(rows: DataFrame, within: list[str], of: F.Column, order: list[str], label: str) -> DataFrame:
    """rows with their position, from 0, in hash ranges and their parts, which are counted first and then numbered side by side."""
    rows = staged(rows.withColumn("range", of.cast("int")), label)
    sizes = rows.groupBy(*within, "range", "part").agg(F.count("*").alias("n"))
    sofar = Window.partitionBy(*within).orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*within, "range", "part", F.coalesce(F.sum("n").over(sofar), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy(*within, "range", "part").orderBy(*order))
    return rows.withColumn("rank", rank).join(before, [*within, "range", "part"]).withColumn("position", F.col("before") + F.col("rank") - 1).drop("rank", "before", "range")
