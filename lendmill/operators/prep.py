"""Fitted preprocessing: impute, engineer, clip, encode, scale, select.

Fitting is a fixed number of aggregations over the input; applying is one projection built
from literals, so scoring never shuffles. Statistics are a few numbers per column. Category
codes are literals while the classes are few (a checked count) and a join on a class table
otherwise, whose strategy Catalyst picks from its size.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.config import PREP, PrepSpec
from lendmill.functions.finance import engineer
from lendmill.operators import gram
from lendmill.operators.quantiles import exact_quantiles
from lendmill.schema import numeric_columns, string_columns
from lendmill.session import materialise

CLASS_SCHEMA = "feature string, value string, code int"
COUNT_SCHEMA = "feature string, value string, n long"


# ---- single steps ------------------------------------------------------------------------

def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n) over string columns in one pass; hot values combine map-side."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(cells).alias("c")).where("c.value IS NOT NULL")
            .groupBy("c.feature", "c.value").agg(F.count("*").alias("n")))


def modes_of(counts: DataFrame) -> DataFrame:
    """Most frequent value per feature; ties go to the smallest value."""
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def modes_table(df: DataFrame, columns: list[str]) -> DataFrame:
    return modes_of(value_counts(df, columns))


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    return {r.feature: r["mode"] for r in modes_table(df, columns).collect()} if columns else {}


def impute(df: DataFrame, fill: dict) -> DataFrame:
    """Replace nulls (and NaN in doubles) by the given constants; other columns are untouched."""
    new = {}
    for f in df.schema.fields:
        if fill.get(f.name) is None:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if isinstance(f.dataType, T.NumericType):
            new[f.name] = F.coalesce(c.cast("double"), F.lit(float(fill[f.name])))
        else:
            new[f.name] = F.coalesce(c, F.lit(fill[f.name]))
    return df.withColumns(new) if new else df


def clip_bounds(df: DataFrame, columns: list[str], spread: float = 3.0
                ) -> dict[str, tuple[float, float] | None]:
    """mean -+ spread * sample deviation; None where the deviation is undefined (one row)."""
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"))]).first()
    return {c: None if row[f"s{i}"] is None
            else (row[f"m{i}"] - spread * row[f"s{i}"], row[f"m{i}"] + spread * row[f"s{i}"])
            for i, c in enumerate(columns)}


def clip(df: DataFrame, bounds: dict) -> DataFrame:
    """Limit values to their bounds; nulls stay null."""
    new = {}
    for c, b in bounds.items():
        if b is not None and c in df.columns:
            x = F.col(c).cast("double")
            new[c] = F.when(x < b[0], b[0]).when(x > b[1], b[1]).otherwise(x)
    return df.withColumns(new) if new else df


def scale_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a zero deviation becomes one."""
    return _scale_and_variance(df, columns, [])[0]


def _scale_and_variance(df: DataFrame, scaled: list[str], others: list[str]):
    """One pass for the scaling and for the sample variance every column has after it."""
    row = df.agg(F.count("*").alias("n"), *[e for i, c in enumerate(scaled) for e in (
        F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))],
        *[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(others)]).first()
    stats = {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(scaled)
             if row[f"m{i}"] is not None}
    # a scaled column has population variance one, or zero when it is constant
    inflation = row.n / (row.n - 1) if row.n > 1 else None
    after = {c: inflation if row[f"s{i}"] else 0.0 for i, c in enumerate(scaled) if c in stats}
    after.update({c: row[f"v{i}"] for i, c in enumerate(others)})
    return stats, after


def scale(df: DataFrame, stats: dict) -> DataFrame:
    new = {c: (F.col(c) - m) / s for c, (m, s) in stats.items() if c in df.columns}
    return df.withColumns(new) if new else df


def class_table(df: DataFrame, columns: list[str], literal_classes: int) -> DataFrame:
    """(feature, value, code): distinct values numbered 0.. in string order within a feature."""
    return classes_of(materialise(value_counts(df, columns), "classes"), literal_classes)


def classes_of(counts: DataFrame, literal_classes: int) -> DataFrame:
    """Number the distinct values of a stored (feature, value, n) table."""
    spark = counts.sparkSession
    per_feature = {r.feature: r["count"] for r in counts.groupBy("feature").count().collect()}
    if sum(per_feature.values()) <= literal_classes:
        seen: dict[str, list[str]] = {}
        for r in counts.collect():
            seen.setdefault(r.feature, []).append(r.value)
        rows = [(f, v, i) for f, vs in seen.items() for i, v in enumerate(sorted(vs))]
        return spark.createDataFrame(rows, CLASS_SCHEMA)
    # many classes: value ranges are numbered side by side, each after the rows of those before
    ranged = materialise(counts.select("feature", "value").repartitionByRange("feature", "value")
                         .withColumn("part", F.spark_partition_id()), "class-ranges")
    earlier = Window.partitionBy("feature").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("feature", "part").agg(F.count("*").alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("feature", "part").orderBy("value"))
    return ranged.withColumn("place", place).join(sizes, ["feature", "part"]).select(
        "feature", "value", (F.col("start") + F.col("place") - 1).cast("int").alias("code"))


def encode(df: DataFrame, classes: DataFrame, columns: list[str], literals: dict | None
           ) -> DataFrame:
    """Class codes; a value not seen at fit time gets code 0."""
    for c in columns:
        if c not in df.columns:
            continue
        if literals is not None:
            pairs = [F.lit(x) for v, code in literals.get(c, {}).items() for x in (v, code)]
            code = F.create_map(*pairs)[F.col(c).cast("string")] if pairs else F.lit(None)
            df = df.withColumn(c, F.coalesce(code.cast("int"), F.lit(0)))
        else:
            known = (classes.where(F.col("feature") == c)
                     .select(F.col("value").alias("_value"), F.col("code").alias("_code")))
            df = (df.join(known, F.col(c).cast("string") == F.col("_value"), "left")
                  .withColumn(c, F.coalesce("_code", F.lit(0))).drop("_value", "_code"))
    return df


def variances(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    row = df.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"v{i}"] for i, c in enumerate(columns)}


def constant_columns(found: dict[str, float | None], limit: float = 0.01) -> list[str]:
    return [c for c, v in found.items() if v is not None and v < limit]


def low_variance(df: DataFrame, columns: list[str], limit: float = 0.01) -> list[str]:
    return constant_columns(variances(df, columns), limit)


def highest_earlier_correlation(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """For each column, its largest absolute correlation with any column before it.

    One pass of array products; up to ``gram.BLOCK`` columns are one tile, and the tiles of wider
    tables stay in the tasks.
    """
    if len(columns) < 2:
        return {c: 0.0 for c in columns}
    return gram.highest_earlier(df, columns, gram.BLOCK)


def correlated(df: DataFrame, columns: list[str], limit: float = 0.95) -> list[str]:
    """Columns whose correlation with an earlier column (kept or not) exceeds the limit."""
    return [c for c, r in highest_earlier_correlation(df, columns).items() if r > limit]


def align(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """Frozen feature order: missing features become 0, extra columns go."""
    have = set(df.columns)
    return df.select(*[k for k in keep if k in have],
                     *[F.col(c) if c in have else F.lit(0).alias(c) for c in features])


# ---- the whole pipeline ------------------------------------------------------------------

@dataclass
class PrepModel:
    """Fitted statistics; ``transform`` is a projection unless a class table must be joined."""

    spec: PrepSpec
    numeric: list[str]
    categorical: list[str]
    fill: dict
    bounds: dict
    scaling: dict
    features: list[str]
    dropped_constant: list[str]
    dropped_correlated: list[str]
    classes: DataFrame = field(repr=False)
    literals: dict | None = field(default=None, repr=False)

    def transform(self, df: DataFrame, keep: list[str] = ("app_id", "default"),
                  stats_from: str = "fit", raw: str | None = None) -> DataFrame:
        """Feature table in frozen order, behind the kept columns.

        ``stats_from="batch"`` recomputes medians, modes and clip bounds on ``df`` itself.
        ``raw`` names a struct column that carries the features in their original units.
        """
        if stats_from not in ("fit", "batch"):
            raise ValueError("stats_from must be 'fit' or 'batch'")
        kept = [k for k in keep if k in df.columns]
        # kept columns travel under another name, out of reach of the feature steps
        work = df.withColumnsRenamed({k: f"_keep_{k}" for k in kept})
        bounds, fill = self.bounds, self.fill
        if stats_from == "batch":
            fill = {**medians(work, [c for c in self.numeric if c in work.columns]),
                    **modes(work, [c for c in self.categorical if c in work.columns])}
        work = engineer(impute(work, fill))
        if stats_from == "batch":
            bounds = clip_bounds(work, [c for c in self.numeric if c in work.columns],
                                 self.spec.outlier_std)
        work = clip(work, bounds)
        work = encode(work, self.classes, self.categorical, self.literals)
        carried = [f"_keep_{k}" for k in kept]
        if raw:
            have = set(work.columns)
            units = [(F.col(c) if c in have else F.lit(0)).cast("double").alias(c)
                     for c in self.features]
            work = work.withColumn("_keep_raw", F.struct(*units))
            carried.append("_keep_raw")
        out = align(scale(work, self.scaling), self.features, carried)
        names = {f"_keep_{k}": k for k in kept}
        return out.withColumnsRenamed({**names, "_keep_raw": raw} if raw else names)

    def _state(self) -> str:
        return json.dumps({
            "spec": asdict(self.spec), "numeric": self.numeric, "categorical": self.categorical,
            "fill": self.fill, "bounds": self.bounds, "scaling": self.scaling,
            "features": self.features, "dropped_constant": self.dropped_constant,
            "dropped_correlated": self.dropped_correlated})

    def save(self, path: str) -> None:
        """Two small Parquet tables: the statistics and the classes."""
        spark = self.classes.sparkSession
        (spark.createDataFrame([(self._state(),)], "state string")
         .write.mode("overwrite").parquet(f"{path}/state"))
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PrepModel":
        raw = json.loads(spark.read.schema("state string").parquet(f"{path}/state").first().state)
        spec = PrepSpec(**raw.pop("spec"))
        classes = spark.read.schema(CLASS_SCHEMA).parquet(f"{path}/classes")
        return PrepModel(spec=spec, classes=classes,
                         literals=class_literals(classes, spec.literal_classes), **raw)


def class_literals(classes: DataFrame, limit: int) -> dict | None:
    """Class maps when their checked number is small, else None (encode by join)."""
    rows = classes.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    maps: dict[str, dict[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r.feature, r.code)):
        maps.setdefault(r.feature, {})[r.value] = r.code
    return maps


def fit_prep(df: DataFrame, target: str = "default", ids: list[str] = ("app_id",),
             spec: PrepSpec = PREP) -> PrepModel:
    """Fit every step on ``df`` and return the model (see ``fit_transform`` for both at once)."""
    skip = {target, *ids}
    numeric = numeric_columns(df, skip)
    categorical = string_columns(df, skip)
    raw = df.select(*[c for c in df.columns if c in {*numeric, *categorical}])
    # modes and classes share one count of the category values; imputing adds no new class
    counts = (materialise(value_counts(raw, categorical), "classes") if categorical
              else df.sparkSession.createDataFrame([], COUNT_SCHEMA))
    modes_found = {r.feature: r["mode"] for r in modes_of(counts).collect()}
    classes = classes_of(counts, spec.literal_classes)
    literals = class_literals(classes, spec.literal_classes)
    fill = {**medians(raw, numeric), **modes_found}
    work = engineer(impute(raw, fill))
    bounds = clip_bounds(work, numeric, spec.outlier_std)
    work = encode(clip(work, bounds), classes, categorical, literals)
    others = [c for c in work.columns if c not in numeric]
    scaling, spread = _scale_and_variance(work, numeric, others)
    work = scale(work, scaling)
    constant = constant_columns(spread, spec.min_variance)
    rest = [c for c in work.columns if c not in constant]
    related = correlated(work, rest, spec.max_correlation)
    return PrepModel(spec, numeric, categorical, fill, bounds, scaling,
                     [c for c in rest if c not in related], constant, related, classes, literals)


def fit_transform(df: DataFrame, target: str = "default", ids: list[str] = ("app_id",),
                  spec: PrepSpec = PREP) -> tuple[PrepModel, DataFrame]:
    model = fit_prep(df, target, ids, spec)
    return model, model.transform(df, keep=[*ids, target])
