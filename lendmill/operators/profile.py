"""Column profiles and table summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.operators.quantiles import exact_quantiles
from lendmill.schema import numeric_columns


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, distinct_count), exact. Values go through narrow (feature, value) keys: hot
    values combine before the shuffle and no key ever spans several columns."""
    exact_as_double = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    numbers = [f.name for f in df.schema.fields
               if f.name in columns and isinstance(f.dataType, exact_as_double)]
    texts = [c for c in columns if c not in numbers]
    parts = []
    for names, kind in ((numbers, "double"), (texts, "string")):
        if names:
            cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("v"))
                              for c in names])
            parts.append(df.select(F.explode(cells).alias("c")).groupBy("c.feature", "c.v").agg(
                F.lit(1).alias("one")).groupBy("feature").agg(F.count("v").alias("distinct_count")))
    return reduce(DataFrame.unionByName, parts)


def feature_profile(df: DataFrame, id_col: str = "app_id", approximate: bool = False,
                    rsd: float = 0.02) -> DataFrame:
    """One row per column: type, nulls, null %, distinct values and the value at the smallest id.

    Exact distinct counts shuffle each column's distinct values; ``approximate`` uses a sketch
    and needs no shuffle beyond the final merge.
    """
    fields = [f for f in df.schema.fields if f.name != id_col]
    row = df.agg(
        F.count("*").alias("rows"),
        *[e for i, f in enumerate(fields) for e in (
            F.count_if(F.col(f.name).isNull()).alias(f"n{i}"),
            F.min_by(f.name, id_col).cast("string").alias(f"s{i}"),
            *([F.approx_count_distinct(f.name, rsd).alias(f"d{i}")] if approximate else []),
        )])
    records = F.array(*[F.struct(
        F.lit(f.name).alias("feature"),
        F.lit(f.dataType.simpleString()).alias("dtype"),
        F.col(f"n{i}").alias("null_count"),
        F.coalesce(F.try_divide(F.col(f"n{i}") * 100.0, F.col("rows")), F.lit(0.0)).alias("null_pct"),
        *([F.col(f"d{i}").alias("distinct_count")] if approximate else []),
        F.col(f"s{i}").alias("sample"),
    ) for i, f in enumerate(fields)])
    table = row.select(F.inline(records))
    if not approximate:
        table = table.join(distinct_counts(df, [f.name for f in fields]), "feature")
    return table.select("feature", "dtype", "null_count", "null_pct", "distinct_count", "sample")


def table_summary(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """One row per column: type, count and nulls; for numbers also mean, sample deviation, min,
    exact quartiles and max."""
    columns = numeric_columns(df, exclude)
    others = [c for c in df.columns if c not in columns and c not in exclude]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.count(c).alias(f"n{i}"),
        F.count_if(F.col(c).isNull()).alias(f"z{i}"),
        F.avg(c).alias(f"m{i}"),
        F.stddev_samp(c).alias(f"s{i}"),
        F.min(c).cast("double").alias(f"lo{i}"),
        F.max(c).cast("double").alias(f"hi{i}"),
    )], *[e for i, c in enumerate(others) for e in (
        F.count(c).alias(f"on{i}"), F.count_if(F.col(c).isNull()).alias(f"oz{i}"))])
    none = F.lit(None).cast("double")
    plain = [F.struct(F.lit(c).alias("feature"), F.lit(kinds[c]).alias("dtype"),
                      F.col(f"on{i}").alias("count"), F.col(f"oz{i}").alias("nulls"),
                      *[none.alias(n) for n in ("mean", "stddev", "min", "q25", "q50", "q75",
                                                "max")]) for i, c in enumerate(others)]
    return row.select(F.inline(F.array(*plain, *[F.struct(
        F.lit(c).alias("feature"),
        F.lit(kinds[c]).alias("dtype"),
        F.col(f"n{i}").alias("count"),
        F.col(f"z{i}").alias("nulls"),
        F.col(f"m{i}").alias("mean"),
        F.col(f"s{i}").alias("stddev"),
        F.col(f"lo{i}").alias("min"),
        F.lit(quartiles[c][0]).cast("double").alias("q25"),
        F.lit(quartiles[c][1]).cast("double").alias("q50"),
        F.lit(quartiles[c][2]).cast("double").alias("q75"),
        F.col(f"hi{i}").alias("max"),
    ) for i, c in enumerate(columns)])))


def table_shape(df: DataFrame) -> DataFrame:
    """Rows and columns of the table."""
    return df.agg(F.count("*").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("long"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """How many columns of each type the table has (schema only, no scan)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, columns long")


def target_distribution(df: DataFrame, target: str = "default") -> DataFrame:
    """Rows and share per class; the share is taken over the few per-class counts."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(1))  # over one row per class, not over the table
    return counts.withColumn("share", F.col("n") / F.sum("n").over(everything))


def base_rates(df: DataFrame, target: str = "default") -> DataFrame:
    """Default rate with the mean bureau score and obligation ratio."""
    return df.agg(F.avg(target).alias("default_rate"),
                  F.avg("cibil_score").alias("avg_cibil_score"),
                  F.avg("foir").alias("avg_foir"))
