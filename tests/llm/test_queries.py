"""Registered queries: SQL where there is some, columns and whole tables for the rest."""

import pytest

from compare import connect, differences
from lendmill.llm import queries

ROWS = {"op1_license": "documents", "op2_html": "pages", "op3_suffix": "documents",
        "op4_simhash": "documents", "op6_lines": "documents", "op7_mix": "documents",
        "op9_quality": "documents", "op10_shard": "documents", "op11_codebooks": "embeddings",
        "op13_pieces": "documents"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    problems, _ = differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir),
                              queries.ORACLES[name])
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(ROWS))
def test_one_row_per_input_row(spark, sf_dir, name):
    rows = spark.read.parquet(f"{sf_dir}/{ROWS[name]}.parquet").count()
    assert queries.QUERIES[name](spark, sf_dir).count() == rows


def test_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


def test_entry_registers_them():
    import __spark_entry__

    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
