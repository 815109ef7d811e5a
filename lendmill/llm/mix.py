"""Mixing sources to target weights by the cube method.

Targets: every source gets a share of ``total_ratio`` times all sizes by weight, at most
``cap`` times its own size; what lies above is shared again by weight. A document of a source
with target t and size s is taken floor(t / s) times for sure and once more with the remaining
fraction as inclusion probability. The flight phase moves these probabilities through the
null-space of the two balancing constraints of a source, its words and its documents, three
open documents at a time, until each becomes 0 or 1; both totals stay exact. Blocks of a source
fly in parallel and leave at most two open documents each, which meet again in the next round
until a dozen are left per source. This landing problem is solved by trying its roundings.

Random choices come from hashes of seed, source and block over documents in hash order, so a
rerun agrees whatever the partitions. Defined results: null text has size 0; the null source is
a source; sources without words get target 0 and taken 0; repeated rows are separate documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.llm.names import all_columns, unused
from lendmill.session import materialise

LANDING = 10  # documents per source that the flight leaves to the landing, besides two
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), total_ratio: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """(source, source_size, documents, target) from rows (source, size).

    The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count("*").alias("documents"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    limit = F.col("source_size") * F.lit(float(cap))
    ordered = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    above = ordered.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    per = per.withColumn("weight", weight).withColumn("limit", limit).withColumns({
        "goal": F.sum("source_size").over(everything) * F.lit(float(total_ratio)),
        "before": F.coalesce(F.sum("limit").over(above), F.lit(0.0)),
        "after": F.sum("weight").over(everything)
        - F.coalesce(F.sum("weight").over(above), F.lit(0.0))})
    # sources by limit per weight: one is at its limit if the level of those after it is higher
    per = per.withColumn("full", F.col("limit") <= F.col("weight")
                         * (F.col("goal") - F.col("before")) / F.col("after"))
    level = (F.col("goal") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0))
             .over(everything)) / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return per.select("source", "source_size", "documents", F.when(F.col("full"), F.col("limit"))
                      .otherwise(F.least("limit", F.col("weight") * level)).alias("target"))


def flight(p: np.ndarray, x: np.ndarray, draw) -> np.ndarray:
    """Move ``p`` to 0 or 1 with sum(p) and sum(p * x) kept; at most two entries stay open."""
    p = p.tolist()
    x = x.tolist()
    edge = 1e-9
    held = []
    for k in range(len(p)):
        if edge < p[k] < 1 - edge:
            held.append(k)
        else:
            p[k] = float(round(p[k]))
        while len(held) == 3 or (len(held) == 2 and x[held[0]] == x[held[1]]):
            # a vector of the null-space of the rows (1, 1, 1) and (x1, x2, x3)
            if len(held) == 2:
                u = (1.0, -1.0)
            else:
                a, b, c = (x[i] for i in held)
                u = (c - b, a - c, b - a)
                if u == (0.0, 0.0, 0.0):
                    u = (1.0, -1.0, 0.0)
            up = min(((1 - p[i]) / d if d > 0 else p[i] / -d) for i, d in zip(held, u) if d)
            down = min((p[i] / d if d > 0 else (1 - p[i]) / -d) for i, d in zip(held, u) if d)
            step = up if draw() * (up + down) < down else -down
            for i, d in zip(held, u):
                p[i] += step * d
                if p[i] < edge or p[i] > 1 - edge:
                    p[i] = float(round(p[i]))
            held = [i for i in held if 0.0 < p[i] < 1.0]
    return np.array(p)


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Round the few open entries: of all roundings the one with the least deviation of the
    words, in units of their mean size, plus that of the documents."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return p
    bits = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = bits - p[open_]
    cost = np.abs(off @ x[open_]) / max(x[open_].mean(), 1.0) + np.abs(off.sum(1))
    p = p.copy()
    p[open_] = bits[np.argmin(cost)]
    return p


def _fly(units: DataFrame, seed: int, level: int, last: bool) -> DataFrame:
    """One round over the blocks of all sources; ``units`` has source, block, p, size, key."""
    schema = units.schema

    def run(table: pa.Table) -> pa.Table:
        # equal keys are equal documents, so their order does not matter
        order = np.lexsort((table.column("size").to_numpy(), table.column("key").to_numpy()))
        table = table.take(pa.array(order))
        p, x = table.column("p").to_numpy().copy(), table.column("size").to_numpy().astype(float)
        name = table.column("source")[0].as_py()
        numbers = np.random.Generator(np.random.PCG64(
            [seed, level, table.column("block")[0].as_py(), *(name or "").encode(), name is None]))
        if last:  # the last few documents stay open for the landing
            stay = np.flatnonzero((p > 0) & (p < 1))[-LANDING:]
            kept = p[stay]
            p[stay] = 0.0
            p = flight(p, x, numbers.random)
            p[stay] = kept
            p = landing(p, x)
        else:
            p = flight(p, x, numbers.random)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p))

    return units.groupBy("source", "block").applyInArrow(run, schema)


def copies(docs: DataFrame, weights=(3.0, 1.0, 2.0), total_ratio: float = 1.5, cap: float = 2.0,
           seed: int = 7, block_rows: int = 20_000, doc_id: str = "doc_id", text: str = "text",
           source: str = "source", keep=()) -> DataFrame:
    """Every row's (doc_id, keep..., size, source_size, target, times): how often it is taken."""
    rows = materialise(docs.select(F.col(doc_id).alias("doc_id"), *keep,
                                   F.col(source).cast("string").alias("source"),
                                   word_count(text).alias("size")), "mix-sizes")
    sources = materialise(targets(rows, weights, total_ratio, cap), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), *[F.col(f"`{k}`") for k in keep])
    named = sources.withColumnRenamed("source", "_source")
    units = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumn("ratio", ratio).withColumns({
            "sure": F.floor("ratio"), "p": F.col("ratio") - F.floor("ratio"), "key": key,
            "block": F.pmod(key, F.ceil(F.col("documents") / block_rows))}).drop("ratio")
    largest = sources.agg(F.max("documents")).first()[0] or 0
    blocks, level, done = math.ceil(largest / block_rows), 0, None
    closed = F.col("p").isin(0.0, 1.0)
    while True:
        last = blocks <= 1
        flown = materialise(_fly(units, seed, level, last), "mix-flight")
        done = flown.where(closed) if done is None else done.union(flown.where(closed))
        if last:
            break
        # two open documents a block: join as many blocks as fill one again
        units = flown.where(~closed).withColumn("block", F.floor(F.col("block")
                                                                 / (block_rows // 2)))
        blocks, level = math.ceil(blocks / (block_rows // 2)), level + 1
    return done.select("doc_id", *keep, "source", "size", "source_size", "target",
                       (F.col("sure") + F.col("p")).cast("bigint").alias("times"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as they are taken, all columns; those taken 0 times go."""
    row, own, key, times, n = (unused(docs, x) for x in ("_row", "_id", "_key", "_times", "_n"))
    keyed = docs.withColumn(row, F.xxhash64(*all_columns(docs)))
    taken = copies(keyed, keep=[row], **options).groupBy("doc_id", row) \
        .agg(F.sum("times").alias(times)).where(F.col(times) > 0) \
        .select(F.col("doc_id").alias(own), F.col(row).alias(key), times)
    # repeated rows are equal: one stands for all, with the sum of their times
    once = keyed.dropDuplicates(["doc_id", row])
    return once.join(taken, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(row) == F.col(key))) \
        .withColumn(n, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))) \
        .select(*all_columns(docs))
