"""Registered queries against SQL where there is some, and the pipeline's stages."""

from collections import Counter

import pytest
from llm_fixtures import importable  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline
from salesmart.llm import queries as training_data

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]
    assert len(names) == 14
    assert set(training_data.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", training_data.oracle_sql())
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, SMALL)
    columns = sorted(ours.columns)
    result = duck(SMALL).execute(training_data.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert columns == sorted(names)
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in ours.collect()) == theirs


def test_pipeline(spark, workspace):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.store(name, stage(spark, docs, SMALL))
        seen.append(docs.count())
        if name != "bpe":
            assert docs.columns == columns, name
        if name in ("quality_rules", "line_dedup", "near_dedup"):
            assert seen[-1] <= seen[-2]
        if name == "near_dedup":
            assert docs.select("text").distinct().count() == docs.count()
    assert seen[-1] == seen[-2] and docs.where("n_tokens = 0").count() == 0
