"""Deterministic, exactly sized splits, folds and samples.

Rows are ordered by a seeded hash of their id, so membership depends on the id alone and not
on partitioning. Instead of ranking the table, two small aggregations find the hash values at
the wanted positions; assigning rows is then a projection with a few literals. Only rows whose
hash prefix equals a boundary bucket are ever sorted, and the prefix is as long as the number of
rows asks for, so that a bucket holds about BUCKET_ROWS.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.config import SPLIT, SplitSpec
from lendmill.operators.quantiles import value_at
from lendmill.session import materialise

BUCKET_ROWS = 1_000
LITERAL_STRATA = 1_000  # up to here a split is a projection, beyond it a join on the class


def prefix_digits(rows: int) -> int:
    """Hex digits of the hash that leave about BUCKET_ROWS rows in a bucket."""
    return max(1, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16)) if rows > BUCKET_ROWS else 1)


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _cuts(df: DataFrame, stratum: str | None, id_col: str, seed: int,
          positions: Callable[[int], list[int]]) -> dict | None:
    """{stratum value: [(hash, id) of the row at each position]}; None for position 0.

    None instead of the whole if there are more than LITERAL_STRATA strata.
    """
    keyed = df.select((F.col(stratum) if stratum else F.lit(0)).alias("s"),
                      F.col(id_col).alias("id"), hash_key(id_col, seed).alias("h"))
    keyed = keyed.withColumn("b", F.substring("h", 1, prefix_digits(df.count())))
    # about one row per BUCKET_ROWS rows and class, stored so that the table is scanned once
    counts = materialise(keyed.groupBy("s", "b").agg(F.count("*").alias("n")), "split-counts")
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    strata = counts.groupBy("s").agg(F.sum("n").alias("n")).limit(LITERAL_STRATA + 1).collect()
    if len(strata) > LITERAL_STRATA:
        return None
    totals = {r.s: r["n"] for r in strata}

    at = {s: positions(n) for s, n in totals.items()}
    wanted = F.lit(False)
    for s, ranks in at.items():
        for k in ranks:
            wanted = wanted | (F.col("s").eqNullSafe(F.lit(s)) & (F.col("below") < k)
                               & (F.col("below") + F.col("n") >= k))
    edges = ranked.where(wanted).collect()
    if not edges:
        return {s: [None] * len(ranks) for s, ranks in at.items()}

    # one row per (class, position): a lookup of fixed size, and no filter that would be
    # pushed into (and repeat) whatever computes the label
    spots = [(e.s, e.b, k - e.below) for e in edges for k in at[e.s] if e.below < k <= e.below + e.n]
    schema = T.StructType([keyed.schema["s"], T.StructField("b", T.StringType()),
                           T.StructField("r", T.IntegerType())])
    lookup = F.broadcast(df.sparkSession.createDataFrame(sorted(set(spots), key=str), schema))
    in_edge = keyed.join(F.broadcast(lookup.select("s", "b").distinct()),
                         keyed["s"].eqNullSafe(lookup["s"]) & (keyed["b"] == lookup["b"]),
                         "left_semi")
    order = Window.partitionBy("s", "b").orderBy("h", "id")
    placed = in_edge.withColumn("r", F.row_number().over(order))
    rows = placed.join(lookup, placed["s"].eqNullSafe(lookup["s"]) & (placed["b"] == lookup["b"])
                       & (placed["r"] == lookup["r"]), "left_semi").collect()
    start = {(e.s, e.b): e.below for e in edges}
    found = {(r.s, start[(r.s, r.b)] + r.r): (r.h, r.id) for r in rows}
    return {s: [found.get((s, k)) for k in ranks] for s, ranks in at.items()}


def _segment(df: DataFrame, stratum: str | None, id_col: str, seed: int, cuts: dict,
             names: list) -> Column:
    """Name of the segment a row's (hash, id) falls in; the last name has no upper cut."""
    key = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    id_type = df.schema[id_col].dataType
    out = F.lit(None)
    for s, edges in cuts.items():
        member = F.lit(names[-1])
        for name, edge in reversed(list(zip(names, edges))):
            if edge is not None:
                cut = F.struct(F.lit(edge[0]).alias("h"), F.lit(edge[1]).cast(id_type).alias("id"))
                member = F.when(key <= cut, F.lit(name)).otherwise(member)
        same = F.col(stratum).eqNullSafe(F.lit(s)) if stratum else F.lit(True)
        out = F.when(same, member).otherwise(out)
    return out


def _joined_segment(df: DataFrame, stratum: str, id_col: str, seed: int,
                    positions: Callable[[Column], list[Column]], names: list,
                    out: str) -> DataFrame:
    """Add column ``out`` for any number of strata: the cuts are a table joined on the stratum.

    The same segments as ``_segment``. Buckets of hash values find the cuts here too, so a window
    orders the rows of a bucket that holds a cut, never those of a stratum.
    """
    keyed = df.select(F.col(stratum).alias("s"), F.col(id_col).alias("id"),
                      hash_key(id_col, seed).alias("h"))
    sizes = materialise(keyed.groupBy("s").agg(F.count("*").alias("total")), "split-strata")
    digits = prefix_digits(sizes.agg(F.max("total")).first()[0] or 0)
    keyed = keyed.withColumn("b", F.substring("h", 1, digits))
    counts = materialise(keyed.groupBy("s", "b").agg(F.count("*").alias("n")), "split-counts")
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = ranked.alias("c").join(sizes.alias("z"), F.expr("c.s <=> z.s")).select(
        "c.*", F.array(*[p.cast("long") for p in positions(F.col("total"))]).alias("cuts"))
    edges = materialise(ranked.where(F.exists(
        "cuts", lambda k: (k > F.col("below")) & (k <= F.col("below") + F.col("n")))), "split-edges")
    placed = keyed.alias("k").join(edges.alias("e"), F.expr("k.s <=> e.s AND k.b = e.b")).select(
        "k.s", "k.b", "k.h", "k.id", "e.below", "e.cuts")
    place = Window.partitionBy("s", "b").orderBy("h", "id")
    placed = placed.withColumn("at", F.col("below") + F.row_number().over(place)).withColumn(
        "times", F.size(F.filter("cuts", lambda k: k == F.col("at")))).where("times > 0")
    found = placed.groupBy("s").agg(F.collect_list(  # one entry per position at most
        F.struct(F.struct("h", "id").alias("key"), "times")).alias("found"))
    cuts = sizes.alias("z").join(found.alias("f"), F.expr("z.s <=> f.s"), "left").select(
        F.col("z.s").alias("_split_s"), F.col("f.found").alias("_split_found"),
        F.size(F.filter(F.array(*[p.cast("long") for p in positions(F.col("total"))]),
                        lambda k: k == 0)).alias("_split_none"))
    cuts = materialise(cuts, "split-cuts")
    key = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    passed = F.aggregate(
        F.coalesce("_split_found", F.array()), F.col("_split_none"),
        lambda n, c: n + F.when(c["key"] < key, c["times"]).otherwise(0))
    joined = df.join(cuts, df[stratum].eqNullSafe(cuts["_split_s"]))
    return joined.withColumn(out, F.get(F.array(*[F.lit(n) for n in names]), passed)) \
        .drop("_split_s", "_split_found", "_split_none")


def stratified_split(df: DataFrame, label: str = "default", id_col: str = "app_id",
                     spec: SplitSpec = SPLIT) -> DataFrame:
    """Add ``split`` (test / validation / train) with exact shares inside every class."""
    names = ["test", "validation", "train"]

    def positions(n: int) -> list[int]:
        test = math.floor(spec.test * n + 0.5)
        return [test, test + math.floor(spec.validation * n + 0.5)]

    def columns(n: Column) -> list[Column]:
        test = F.floor(F.lit(spec.test) * n + 0.5)
        return [test, test + F.floor(F.lit(spec.validation) * n + 0.5)]

    cuts = _cuts(df, label, id_col, spec.seed, positions)
    if cuts is None:
        return _joined_segment(df, label, id_col, spec.seed, columns, names, "split")
    return df.withColumn("split", _segment(df, label, id_col, spec.seed, cuts, names))


def stratified_folds(df: DataFrame, k: int, label: str = "default", id_col: str = "app_id",
                     seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1; class counts of two folds differ by at most one."""
    names = list(range(k))
    cuts = _cuts(df, label, id_col, seed, lambda n: [n * (i + 1) // k for i in range(k - 1)])
    if cuts is None:
        return _joined_segment(
            df, label, id_col, seed,
            lambda n: [F.floor((n * (i + 1) - n * (i + 1) % k) / k) for i in range(k - 1)],
            names, "fold")
    return df.withColumn("fold", _segment(df, label, id_col, seed, cuts, names))


def seeded_sample(df: DataFrame, n: int, id_col: str = "app_id", seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows; the same rows for any partitioning of the input."""
    cuts = _cuts(df, None, id_col, seed, lambda total: [min(n, total)])
    edge = cuts.get(0, [None])[0]
    if edge is None:
        return df.limit(0)
    key = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    cut = F.struct(F.lit(edge[0]).alias("h"),
                   F.lit(edge[1]).cast(df.schema[id_col].dataType).alias("id"))
    return _up_to(df, key < cut, F.coalesce(key == cut, F.lit(False)), n)


def _up_to(df: DataFrame, below: Column, edge: Column, n: int) -> DataFrame:
    """All rows below a cut and as many of those at it as are missing to ``n``: one row, unless
    ids repeat."""
    sure = df.where(below)
    return sure.unionByName(df.where(edge).limit(max(0, n - sure.count())))


def first_rows(df: DataFrame, n: int, id_col: str = "app_id") -> DataFrame:
    """The ``n`` rows with the smallest numeric ids (a table has no row order of its own). The
    n-th id is found by counting, so no task ever gathers n rows of every other."""
    total = df.where(F.col(id_col).isNotNull()).count()
    if n <= 0 or total == 0:
        return df.limit(0)
    if n >= total:
        return df.where(F.col(id_col).isNotNull())
    # the quantile at a whole rank is the value at that rank
    cut = value_at(df, id_col, n - 1)
    return _up_to(df, F.col(id_col) < cut, F.col(id_col) == cut, n)
