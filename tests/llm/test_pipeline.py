"""The corpus pipeline, stage by stage, against the operators' plain results."""

import numpy as np
import pytest

import corpus_pipeline
from lendmill.llm import queries


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test")
        out.append(docs.toPandas())
    return out


def test_all_but_the_last_stage_return_documents(stages):
    for after in stages[1:-1]:
        assert list(after.columns) == list(stages[0].columns)
        assert set(after["doc_id"]) <= set(stages[0]["doc_id"])


def test_quality_stage_drops_what_the_query_rejects(spark, sf_dir, stages):
    rejected = {r["doc_id"] for r in queries.op9_quality(spark, sf_dir)
                .where("predicted = 0").collect()}
    assert set(stages[1]["doc_id"]) == set(stages[0]["doc_id"]) - rejected


def test_one_document_per_component_stays(stages):
    from test_documents import classes, plain_fingerprint

    before = stages[1].sort_values("doc_id")
    roots = classes([plain_fingerprint(t) for t in before["text"]], 4)
    assert set(stages[2]["doc_id"]) == set(before.groupby(np.array(roots))["doc_id"].min())


def test_leaks_go(spark, sf_dir, stages):
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = stages[2]["text"].map(lambda t: any(i in t for i in items))
    assert leaking.any()
    assert set(stages[3]["doc_id"]) == set(stages[2].loc[~leaking, "doc_id"])


def test_sources_meet_their_targets(stages):
    from test_documents import plain_targets

    words = lambda df: df["text"].str.split(r"[\x20\x09-\x0D]+", regex=True).map(
        lambda x: sum(map(bool, x)))
    before = words(stages[3]).groupby(stages[3]["source"]).sum()
    after = words(stages[4]).groupby(stages[4]["source"]).sum()
    targets = plain_targets(before.to_dict())
    assert all(abs(after.get(s, 0) - t) <= max(0.25 * t, 100) for s, t in targets.items())
    assert stages[4]["doc_id"].value_counts().max() <= 2


def test_rows_are_sharded(spark, sf_dir, stages):
    last = stages[5]
    assert len(last) == len(stages[4])
    for _, part in last.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert corpus_pipeline.run(spark, sf_dir).count() == len(last)


@pytest.fixture(scope="module")
def awkward_dir(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, repeated rows and clashing extra columns."""
    from test_documents import SCHEMA, documents

    path = str(tmp_path_factory.mktemp("awkward"))
    rows = documents(rows=60)
    docs = spark.createDataFrame([(*r, 1, "z", 2, 0.5) for r in rows],
                                 f"{SCHEMA}, _row int, size string, shard int, score double")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(50)] + [(None, 1, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    items = [(0, " ".join(rows[10][1].split()[:30])), (1, None), (2, "")]
    spark.createDataFrame(items, "item_id bigint, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_takes_awkward_rows(spark, awkward_dir):
    docs = spark.read.parquet(f"{awkward_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        # each stage on the untouched rows, and on none
        out = stage(spark, docs, awkward_dir)
        rows = out.collect()
        if stage is not corpus_pipeline.sharding:
            assert out.columns == docs.columns
            assert {r["_row"] for r in rows} <= {1} and {r["size"] for r in rows} <= {"z"}
        else:
            assert out.columns == [*docs.columns, "_size", "_shard", "slot"]
            assert len(rows) == docs.count()
        assert stage(spark, docs.limit(0), awkward_dir).count() == 0, name
    last = corpus_pipeline.run(spark, awkward_dir)
    assert last.count() > 0


def test_leak_stage_drops_the_leaking_row_only(spark, awkward_dir):
    docs = spark.read.parquet(f"{awkward_dir}/documents.parquet")
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, awkward_dir).collect()
    assert len(kept) == docs.where("doc_id is null or doc_id <> 10").count()
