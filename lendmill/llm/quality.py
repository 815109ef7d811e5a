"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics. Per class, the mean and a shrunk
covariance are estimated from moments summed over all labelled training rows; the Cholesky
factors are computed once on the driver and cached in the model. The score is the posterior of
class 1 from the difference of the two Gaussian log densities (Mahalanobis terms) and the priors.

Defined results: null text counts as the empty text, which has a vector like any other; rows
with a null label take no part in the fit; a row labelled several times counts once per label;
without any labelled row every score is 0.5, with a single class the smoothed share of class 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.text import Rolling, is_white, steps, utf8, words
from lendmill.session import materialise

FEATURES = ["log_bytes", "log_words", "word_length", "word_spread", "symbols", "marked_words",
            "bare_symbols", "upper", "digits", "lines", "line_length", "repeated_lines",
            "repeated_words", "echoed_words", "stop_share", "non_ascii"]
STATISTICS = "array<double>"


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Smoothed log odds of a share: close to normal, finite for 0 and 1."""
    return np.log((part + 0.5) / (whole - part + 0.5))


def statistics(data: np.ndarray, offsets: np.ndarray, rolling: Rolling) -> np.ndarray:
    """One row of FEATURES per text, from its whole bytes."""
    rows = len(offsets) - 1
    white = is_white()
    size = np.diff(offsets).astype(float)
    code = np.arange(256)
    lower = (code >= 97) & (code <= 122)
    upper = (code >= 65) & (code <= 90)
    digit = (code >= 48) & (code <= 57)
    wide = code >= 128
    usual = np.isin(code, [ord(x) for x in ".,'-"])
    odd = ~(lower | upper | digit | wide | usual | white)

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    starts, ends, row = words(data, offsets, white)
    length = (ends - starts).astype(float)

    def per_row(weights=None, of=row) -> np.ndarray:
        return np.bincount(of, weights, rows)[:rows].astype(float)

    n = per_row()
    some = np.maximum(n, 1)
    mean = per_row(length) / some
    spread = np.sqrt(np.maximum(per_row(length * length) / some - mean * mean, 0))
    prefix = rolling.prefix(data)
    hashes = rolling.ranges(prefix, starts, ends)
    last_odd = odd[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    bare = last_odd & (length == 1)
    echo = np.zeros(len(starts), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])

    def distinct(of: np.ndarray, keys: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, of))
        of, keys = of[order], keys[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
        return np.bincount(of[new], minlength=rows)[:rows].astype(float)

    # lines: the pieces between line feeds, empty ones left out
    breaks = np.flatnonzero(data == 10)
    cuts = np.union1d(np.concatenate([breaks, breaks + 1]), offsets)
    left, right = cuts[:-1], cuts[1:]
    real = (data[left] != 10) if len(left) else np.zeros(0, bool)
    left, right = left[real], right[real]
    line_row = np.searchsorted(offsets, left, "right") - 1
    lines = per_row(of=line_row)
    short = length <= 3
    columns = [
        np.log1p(size), np.log1p(n), mean, spread, share(counted(odd[data]), size),
        share(per_row(last_odd.astype(float)), n), share(per_row(bare.astype(float)), n),
        share(counted(upper[data]), size), share(counted(digit[data]), size), np.log1p(lines),
        np.log1p(size / np.maximum(lines, 1)),
        share(lines - distinct(line_row, rolling.ranges(prefix, left, right)), lines),
        share(n - distinct(row, hashes), n), share(per_row(echo.astype(float)), n),
        share(per_row(short.astype(float)), n), share(counted(wide[data]), size),
    ]
    return np.stack(columns, axis=1) if rows else np.zeros((0, len(columns)))


def vectors(column: pa.Array, rolling: Rolling) -> np.ndarray:
    data, offsets = utf8(column)
    parts = [statistics(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], rolling)
             for a, b in steps(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def with_statistics(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """The kept columns and an array column ``statistics``."""
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            found = vectors(batch.column("_text"), rolling)
            flat = pa.array(found.ravel(), pa.float64())
            where = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.ListArray.from_arrays(where, flat)],
                names=[*keep, "statistics"])

    source = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in docs.select(*keep).schema.fields)
    return source.mapInArrow(run, f"{schema}, statistics {STATISTICS}")


@dataclass
class Discriminant:
    """Class priors, means, and inverse Cholesky factors with their log determinants."""
    prior: np.ndarray
    mean: np.ndarray = None
    factor: np.ndarray = None
    log_det: np.ndarray = None
    counts: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        if self.mean is None:
            return np.full(len(x), self.prior[1])
        density = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            density.append(-0.5 * (np.einsum("ij,ij->i", z, z) + self.log_det[k])
                           + np.log(self.prior[k]))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def moments(labelled: DataFrame) -> DataFrame:
    """Per class and task one row: count, sum and sum of outer products of ``statistics``."""
    d = len(FEATURES)

    def run(batches):
        total = {}
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("statistics").flatten().to_numpy().reshape(-1, d)
            for k in (0, 1):
                y = x[label == k]
                if len(y):
                    n, s, q = total.get(k, (0, np.zeros(d), np.zeros((d, d))))
                    total[k] = (n + len(y), s + y.sum(0), q + y.T @ y)
        for k, (n, s, q) in sorted(total.items()):
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([k], pa.int32()), "n": pa.array([n], pa.int64()),
                "sums": [np.concatenate([s, q.ravel()]).tolist()]})

    rows = labelled.mapInArrow(run, "label int, n bigint, sums array<double>")
    size = d + d * d
    return rows.select("label", "n", F.posexplode("sums").alias("at", "value")) \
        .groupBy("label", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("value")) \
        .groupBy("label").agg(F.first("n").alias("n"), F.map_from_entries(
            F.collect_list(F.struct("at", "value"))).alias("sums")) \
        .select("label", "n", F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                                          lambda i: F.element_at("sums", i)).alias("sums"))


def fit(labelled: DataFrame, pooled: float = 0.3, ridge: float = 0.1) -> Discriminant:
    """Fit on rows (statistics, label 0 or 1). Only class moments reach the driver.

    ``pooled`` draws each class covariance towards the covariance of both classes together,
    ``ridge`` then towards its own diagonal.
    """
    d = len(FEATURES)
    found = {r["label"]: (r["n"], np.array(r["sums"])) for r in moments(
        labelled.where("label in (0, 1)").select("statistics", F.col("label").cast("int")))
        .collect()}
    counts = np.array([found[k][0] if k in found else 0 for k in (0, 1)], float)
    prior = (counts + 1) / (counts.sum() + 2)
    if len(found) < 2:
        return Discriminant(prior, counts=counts.tolist())
    mean, scatter = np.zeros((2, d)), np.zeros((2, d, d))
    for k in (0, 1):
        n, sums = found[k]
        mean[k] = sums[:d] / n
        scatter[k] = sums[d:].reshape(d, d) - n * np.outer(mean[k], mean[k])
    together = scatter.sum(0) / max(counts.sum() - 2, 1)
    factor, log_det = np.zeros((2, d, d)), np.zeros(2)
    for k in (0, 1):
        own = scatter[k] / max(counts[k] - 1, 1)
        own = (1 - pooled) * own + pooled * together
        spread = np.diag(own) + 1e-3
        own = (1 - ridge) * own + ridge * np.diag(spread) + 1e-6 * np.eye(d)
        lower = np.linalg.cholesky(own)
        factor[k] = np.linalg.inv(lower)
        log_det[k] = 2 * np.log(np.diag(lower)).sum()
    return Discriminant(prior, mean, factor, log_det, counts.tolist())


def held_out(doc_id="doc_id"):
    """Whether a row's label is kept from the fit: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def labelled(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Statistics of every labelled row outside the held-out quarter."""
    known = labels.select("doc_id", F.col(label).alias("label")) \
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    return stats.join(known, "doc_id").select("statistics", "label")


def labelled_texts(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """As ``labelled``, from the texts; the statistics are stored before the join."""
    return labelled(materialise(with_statistics(docs, text), "quality-statistics"), labels)


def score(stats: DataFrame, model: Discriminant, threshold: float = 0.7) -> DataFrame:
    """The other columns of ``stats`` with score and prediction."""
    keep = [x for x in stats.columns if x != "statistics"]

    def run(batches):
        for batch in batches:
            x = batch.column("statistics").flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(model.score(x), pa.float64())],
                names=[*keep, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in stats.select(*keep).schema.fields)
    return stats.mapInArrow(run, ", ".join(filter(None, [schema, "score double"]))) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Discriminant, threshold: float = 0.7,
             text: str = "text") -> DataFrame:
    """The rows predicted to be class 1, all columns, in place (no shuffle)."""
    fields = docs.schema

    def run(batches):
        rolling = Rolling()
        for batch in batches:
            keep = model.score(vectors(batch.column(text), rolling)) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, fields)
