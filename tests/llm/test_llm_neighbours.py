"""Neighbours of vectors as they are stored, and how tables are cut into shards."""

import numpy as np
import pytest
from llm_fixtures import importable  # noqa: F401

from salesmart.llm import neighbours


@pytest.mark.parametrize("scale", [1.0, 1e60])
def test_scores_of_doubles_are_exact(spark, workspace, scale):
    x = np.random.default_rng(2).normal(size=(300, 6)) * scale
    x[7], x[8] = x[3], x[3] * (1 + 1e-12)  # the last differs from the others in double only
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    vectors = neighbours.usable(frame)
    graphs = workspace.store("g", neighbours.graph(vectors, shard_rows=100))
    assert graphs.schema["vector"].dataType.elementType.simpleString() == "double"
    found = neighbours.search(graphs, vectors.where("vec_id % 20 = 0")).collect()
    scores = x @ x.T
    hits = 0
    for query in range(0, 300, 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert [rank for rank, *_ in mine] == list(range(1, 21))
        for _, vec, score in mine:
            assert score == pytest.approx(scores[query, vec], rel=1e-13, abs=1e-13 * scale**2)
        best = [v for v in np.argsort(-scores[query], kind="stable") if v != query][:20]
        hits += len({v for _, v, _ in mine} & set(best))
    assert hits >= 0.9 * 20 * 15


def test_whole_numbers_are_taken_as_doubles(spark):
    frame = spark.createDataFrame([(1, [2**53, 1]), (2, [0, 0])], "vec_id int, embedding array<bigint>")
    rows = neighbours.usable(frame)
    assert rows.schema["embedding"].dataType.elementType.simpleString() == "double"
    assert [tuple(r) for r in rows.collect()] == [(1, [float(2**53), 1.0])]


def test_shards_grow_with_the_bytes_of_the_table():
    assert neighbours.shards_of(0, 0) == 1
    assert neighbours.shards_of(51_282, 51_282 * 64) == 7
    assert neighbours.shards_of(10**6, 64 * 10**6) == 64  # in parallel, though 10 would hold it
    many = [neighbours.shards_of(n, 64 * n) for n in (10**8, 10**9)]
    assert 9 < many[1] / many[0] < 11 and 100_000 < 10**9 / many[1] < 120_000
    assert neighbours.shards_of(10**8, 768 * 10**8) > 7 * many[0]
