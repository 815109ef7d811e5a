"""Sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from lendmill.operators.portfolio import portfolio_flat, portfolio_metrics
from lendmill.operators.validate import quarantined, write_validated
from lendmill.plans.scoring import score_applications, score_with_scorecard
from lendmill.schema import APPLICATIONS, REQUEST
from lendmill.session import scratch
from lendmill.sources import files
from lendmill.streaming.scoring import portfolio_stream, read_portfolio, score_stream
from registry import variants
from registry.mapping import requests


def same(a, b):
    key = a.columns
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(key).collect()))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip(spark, apps, fmt):
    path = scratch(spark, f"test-{fmt}")
    files.write_table(apps, path, fmt)
    assert same(apps, files.read_table(spark, path, fmt, APPLICATIONS))


def test_missing_path_and_malformed_rows_raise(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_table(spark, scratch(spark, "nowhere"), "csv")
    path = scratch(spark, "test-bad")
    spark.createDataFrame([("app_id,loan_amnt",), ("1,abc",)], "line string").coalesce(1) \
        .write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.read_table(spark, path, "csv").collect()


def test_quarantine_is_written_beside_the_valid_rows(spark, sf_dir):
    bad = variants.with_invalid(requests(spark, sf_dir))
    path = scratch(spark, "test-quarantine")
    write_validated(bad, path)
    stored = spark.read.parquet(path)
    assert stored.count() == bad.count()
    assert stored.where("NOT is_valid").count() == quarantined(bad).count() > 0


def test_unreadable_request_is_rejected(spark):
    path = scratch(spark, "test-json")
    spark.createDataFrame([('{"app_id": 1, "age": "x"}',), ("not json",)], "value string") \
        .write.text(path)
    assert quarantined(files.read_requests(spark, path)).count() == 2


def test_results_are_json_records(spark, sf_dir):
    assessed = score_with_scorecard(requests(spark, sf_dir))
    text = files.as_json(portfolio_metrics(assessed)).first().record
    record = json.loads(text)
    assert record["total_applicants"] == assessed.count()
    assert set(record["decisions"]) == {"approved", "review", "rejected", "approval_rate"}


def source(spark, sf_dir):
    path = scratch(spark, "test-requests")
    (variants.with_invalid(requests(spark, sf_dir)).select(REQUEST.names)
     .withColumn("part", F.col("app_id") % 4).repartition(4, "part")
     .write.partitionBy("part").json(path))
    return path


@pytest.mark.parametrize("model", ["scorecard", "boosted"])
def test_stream_equals_batch(spark, sf_dir, result, model):
    if model == "scorecard":
        scorer = score_with_scorecard
    else:
        scorer = lambda df: score_applications(df, result.prep, result.models["boosted"])
    path = source(spark, sf_dir)
    out, check = scratch(spark, "test-out"), scratch(spark, "test-check")
    stream = files.read_request_stream(spark, f"{path}/part=*", files_per_batch=1)
    score_stream(stream, scorer, out, check, available_now=True).awaitTermination()
    batch = scorer(files.read_requests(spark, f"{path}/part=*"))
    assert same(batch, spark.read.parquet(out))


def test_replayed_batches_overwrite_themselves(spark, sf_dir):
    path = source(spark, sf_dir)
    out = scratch(spark, "test-metrics")
    for _ in range(2):  # a second run without the first one's checkpoint replays every batch
        stream = files.read_request_stream(spark, f"{path}/part=*", files_per_batch=1)
        portfolio_stream(stream, score_with_scorecard, out, scratch(spark, "test-check"),
                         available_now=True).awaitTermination()
    got = read_portfolio(spark, out)
    assert got.count() == 4
    whole = portfolio_flat(score_with_scorecard(files.read_requests(spark, f"{path}/part=*"))).first()
    row = got.agg(F.sum("total_applicants"), F.sum("total_expected_profit")).first()
    assert row[0] == whole.total_applicants
    assert row[1] == pytest.approx(whole.total_expected_profit)


def test_streamed_requests_are_dealt_over_files(spark, sf_dir, monkeypatch):
    """Many files a remainder, one micro-batch a remainder, and no row of a task is sorted."""
    from registry import queries
    one = [queries.rounded(q(spark, sf_dir)) for q in (queries.z2, queries.z3)]
    monkeypatch.setattr(queries, "FILE_ROWS", 60)
    path, n = queries._request_files(spark, sf_dir)
    assert n > 1
    for part in range(4):
        rows = spark.read.schema(REQUEST).json(f"{path}/part={part}")
        held = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
        assert len(held) == n and max(held) < 60 * 3
        assert rows.where(F.col("app_id") % 4 != part).count() == 0
    for before, query in zip(one, (queries.z2, queries.z3)):
        assert same(before, queries.rounded(query(spark, sf_dir)))
