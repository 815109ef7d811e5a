"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Groups of equal texts are the keys of the ring. A key goes to the shard of the next virtual node
clockwise, and on to the next shard that is not full where that shard has reached its bound. The
bound is the mean load in bytes (of the shards that no single group fills), so no other shard
exceeds it by more than the last group it took, and sizes come out near equal (law ``bytes``).
Larger groups go first, so the last ones are small.

All of it is DataFrame work. A round offers every open group to its next shard with room;
running sums over (size class, hash) buckets find in each shard the bucket in which the bound is
reached, and only that bucket is ordered row by row. At most one round per shard is needed.

Defined results: null text counts as the empty text (size 1, CRC 0); repeated rows are rows of
one group; a group larger than the bound is cut into parts of a 64th of the bound by a
hash of doc_id, since no shard can hold it; all other equal texts share a shard.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.llm.names import all_columns, unused
from lendmill.session import materialise

PARTS = 64  # a group that no shard can hold is cut into parts of a shard's load through this
POSITIONS = 1 << 12  # of the ring, for virtual nodes and keys alike
GROUP = ["h", "crc", "size", "part"]


def ring(shards: int, virtual: int) -> list[list[int]]:
    """For every position of the ring all shards in clockwise order of their virtual nodes."""
    points = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:4]) % POSITIONS,
                     s) for s in range(shards) for v in range(virtual))
    places = [p for p, _ in points]
    around = {}
    for at in range(len(points)):
        around[at] = list(dict.fromkeys(points[(at + k) % len(points)][1]
                                        for k in range(len(points))))
    return [around[bisect.bisect_left(places, position) % len(points)]
            for position in range(POSITIONS)]


def _offer(open_: DataFrame, room: dict[int, int], parts: int) -> tuple[DataFrame, DataFrame]:
    """One round: (groups with their shard, groups still open)."""
    left = F.create_map(*[F.lit(x) for s, r in room.items() for x in (s, r)])
    full = [F.lit(s) for s, r in room.items() if r <= 0]
    choice = F.array_except("clockwise", F.array(*full)) if full else F.col("clockwise")
    bucket = ["shard", "class", "slice"]
    offered = open_.withColumns({
        "shard": F.get(choice, F.lit(0)),
        "class": -F.floor(F.log2(F.col("bytes").cast("double")) * 4).cast("int"),
        "slice": F.pmod(F.xxhash64("h", "crc", "size", "part", F.lit("slice")), F.lit(parts))})
    sums = offered.groupBy(*bucket).agg(F.sum("bytes").alias("held"))
    order = W.partitionBy("shard").orderBy("class", "slice")
    sums = sums.withColumn("before", F.sum("held").over(order) - F.col("held")) \
        .withColumn("room", F.element_at(left, F.col("shard"))) \
        .withColumn("state", F.when(F.col("before") >= F.col("room"), 0)
                    .when(F.col("before") + F.col("held") <= F.col("room"), 2).otherwise(1)) \
        .drop("held")
    judged = materialise(offered.join(sums, bucket), "shard-offers")
    within = W.partitionBy(*bucket).orderBy(F.col("bytes").desc(), *GROUP)
    edge = judged.where("state = 1").withColumn(
        "before", F.col("before") + F.sum("bytes").over(within) - F.col("bytes")) \
        .withColumn("state", F.when(F.col("before") < F.col("room"), 2).otherwise(0))
    judged = judged.where("state <> 1").unionByName(edge)
    columns = [*GROUP, "n", "bytes"]
    return (judged.where("state = 2").select(*columns, "shard"),
            judged.where("state = 0").select(*columns, "clockwise"))


def place(groups: DataFrame, shards: int, virtual: int, bound: int) -> DataFrame:
    """(h, crc, size, part, shard) for groups (h, crc, size, part, n, bytes)."""
    spark = groups.sparkSession
    # fixed by the parameters: POSITIONS rows of ``shards`` numbers
    table = spark.createDataFrame(list(enumerate(ring(shards, virtual))),
                                  "position int, clockwise array<int>")
    position = F.pmod(F.xxhash64(*GROUP), F.lit(POSITIONS)).cast("int")
    open_ = groups.withColumn("position", position).join(F.broadcast(table), "position") \
        .drop("position")
    parts = max(1, groups.count() // 100_000)
    room, placed = {s: bound for s in range(shards)}, None
    while True:
        taken, open_ = _offer(open_, room, parts)
        taken = materialise(taken, "shard-placed")
        placed = taken if placed is None else placed.union(taken)
        for row in taken.groupBy("shard").agg(F.sum("bytes").alias("b")).collect():  # <= shards
            room[row["shard"]] -= row["b"]
        if open_.isEmpty():
            return placed.select(*GROUP, "shard")


def balanced_bound(groups: DataFrame, shards: int, total: int) -> int:
    """The mean load of the shards that no single group fills; reads ``shards`` rows at most."""
    for row in groups.orderBy(F.desc("bytes")).limit(shards - 1).select("bytes").collect():
        if row["bytes"] * shards <= total:
            break
        total, shards = total - row["bytes"], shards - 1
    return -(-total // shards)


def assign(docs: DataFrame, shards: int = 16, virtual: int = 64, doc_id: str = "doc_id",
           text: str = "text", keep=(), bucket_rows: int = 20_000) -> DataFrame:
    """Every row's (doc_id, keep..., size, text_crc32, law, shard, slot, grown_shard)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.xxhash64(body).alias("h"),
                       F.crc32(body).alias("crc"),
                       (F.octet_length(body).cast("bigint") + 1).alias("size"))
    key = ["doc_id", *keep, "h", "crc", "size"]
    rows = materialise(rows.groupBy(*key).agg(F.count("*").alias("n")), "shard-rows")
    total, count = rows.agg(F.sum(F.col("size") * F.col("n")), F.sum("n")).first()
    bound = -(-(total or 0) // shards)
    groups = rows.groupBy("h", "crc", "size").agg(F.sum("n").alias("n"))
    # fewer than ``shards`` groups can be larger than the mean load
    large = groups.where(F.col("n") * F.col("size") > bound).where("n > 1").select(
        "h", "crc", "size", F.ceil(F.col("n") * F.col("size") * PARTS / max(bound, 1)).alias("cuts"))
    rows = rows.join(F.broadcast(large), ["h", "crc", "size"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("cuts")), F.lit(0))) \
        .drop("cuts")
    units = materialise(rows.groupBy(*GROUP).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes")), "shard-groups")
    placed = place(units, shards, virtual, balanced_bound(units, shards, total or 0))
    # slots: offsets of hash buckets inside a shard, then a rank inside the bucket
    buckets = max(1, -(-(count or 0) // (bucket_rows * shards)))
    rows = materialise(rows.join(placed, GROUP).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "h"), F.lit(buckets))), "shard-of-rows")
    order = W.partitionBy("shard").orderBy("bucket")
    offsets = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("m")) \
        .withColumn("offset", F.sum("m").over(order) - F.col("m")).drop("m")
    within = W.partitionBy("shard", "bucket").orderBy(*key)
    first = rows.join(offsets, ["shard", "bucket"]).withColumn(
        "first", F.col("offset") + F.sum("n").over(within) - F.col("n"))
    return first.select(
        "doc_id", *keep, "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = 16, virtual: int = 64) -> DataFrame:
    """All columns of every row with its shard, slot and size."""
    row, own, key = (unused(docs, x) for x in ("_row", "_id", "_key"))
    keyed = docs.withColumn(row, F.xxhash64(*all_columns(docs)))
    names = {x: unused(docs, x) for x in ("size", "shard", "slot")}
    found = assign(keyed, shards, virtual, keep=[row]).select(
        F.col("doc_id").alias(own), F.col(row).alias(key),
        *[F.col(x).alias(name) for x, name in names.items()])
    once = keyed.dropDuplicates(["doc_id", row])  # equal rows share all but shard and slot
    return once.join(found, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(row) == F.col(key))) \
        .select(*all_columns(docs), *names.values())
