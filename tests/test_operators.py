import hashlib
import random
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.operators import attach_key, dense_id, position_id, ranked_id, representative
from salesmart.plans import snowflake, star
from salesmart.schemas import SNOWFLAKE_TABLES
from salesmart.workspace import Workspace


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def brute_first(rows, keys):
    """Rows are dicts in column order; nulls sort first."""
    def order(row):
        return [(value is not None, value or "") for value in row.values()]

    best = {}
    for row in rows:
        key = tuple(row[k] for k in keys)
        if key not in best or order(row) < order(best[key]):
            best[key] = row
    return {
        key: {k: v for k, v in row.items() if k != "_id"} for key, row in best.items()
    }


TEXT = st.one_of(st.none(), st.sampled_from(["", "a", "b", "é", "B"]))


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXT, TEXT, TEXT, TEXT), max_size=25))
def test_representative_equals_brute_force(spark, tuples):
    names = ["_id", "k", "a", "b"]
    rows = [dict(zip(names, t)) for t in tuples]
    frame = spark.createDataFrame(tuples, "_id string, k string, a string, b string")
    picked = representative(frame, ["k"], ["k", "a", "b"], "_id").collect()
    assert {(row.k,): row.asDict() for row in picked} == brute_first(rows, ["k"])


def test_representative_does_not_depend_on_partitioning(spark):
    random.seed(1)
    rows = [
        (str(random.randrange(30)), random.choice("abc") if i % 3 else "hot", str(i % 7), str(i % 11))
        for i in range(3000)
    ]
    results = set()
    for partitions in (1, 3, 16):
        random.shuffle(rows)
        frame = spark.createDataFrame(rows, "_id string, k string, a string, b string")
        picked = representative(frame.repartition(partitions), ["k"], ["k", "a", "b"], "_id")
        results.add(tuple(sorted(map(tuple, picked.collect()))))
    assert len(results) == 1


def test_representative_combines_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("string(id) _id", "string(id % 3) k", "string(id) a")
    text = plan(representative(frame, ["k"], ["k", "a"], "_id"))
    assert text.count("partial_min") == 1 and text.count("Exchange") == 1


def test_representative_of_few_keys_is_the_same(spark, workspace, monkeypatch):
    random.seed(2)
    heads = ["order-1", "order-", "", "zürich", "\U0001f600\U0001f600", "a\0"]  # 7 bytes cut some characters
    ids = [None, *(head + tail for head in heads for tail in ["", "\0", "2", "10", "é"])]
    rows = [
        {"_id": random.choice(ids), "k": random.choice([None, "", "a", "é"]),
         "j": random.choice([None, "x"]), "a": random.choice([None, "", "b", "c"])}
        for _ in range(400)
    ]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "_id string, k string, j string, a string")
    module = sys.modules["salesmart.operators.representative"]
    for limit, joins in ((500_000, 1), (1, 0)):
        monkeypatch.setattr(module, "BROADCAST_ROWS", limit)
        picked = representative(
            frame, ["k", "j"], ["k", "j", "a"], "_id", few_keys=workspace.child(f"limit_{limit}")
        )
        assert plan(picked).count("BroadcastHashJoin") == joins  # the rows are narrowed before they are sorted
        result = picked.collect()
        assert {(row.k, row.j): row.asDict() for row in result} == brute_first(rows, ["k", "j"])
        assert len(result) == len({(r["k"], r["j"]) for r in rows})


def test_representative_of_many_keys_is_the_same(spark, workspace, monkeypatch):
    random.seed(4)
    ids = [None, "", "order-1", "order-12", "order-2", "a\0", "a"]
    rows = [
        {"_id": random.choice(ids), "k": random.choice([None, "", *map(str, range(300))]),
         "j": random.choice([None, "x"]), "a": random.choice([None, "", "b", "c"])}
        for _ in range(4000)
    ]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], "_id string, k string, j string, a string")
    module = sys.modules["salesmart.operators.representative"]
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    for words, most in ((2**20, 0.5), (1, 1)):  # all keys in one word: every bit is set
        monkeypatch.setattr(module, "BIT_WORDS", words)
        space = workspace.child(f"words_{words}")
        near = module._near_first(frame, ["k", "j"], "_id", space, hashed=True)
        assert near.count() <= most * len(rows)
        picked = representative(frame, ["k", "j"], ["k", "j", "a"], "_id", many_keys=space)
        assert "BroadcastHashJoin" in plan(picked)  # narrowed before they are sorted
        result = picked.collect()
        assert {(row.k, row.j): row.asDict() for row in result} == brute_first(rows, ["k", "j"])
        assert len(result) == len({(r["k"], r["j"]) for r in rows})


def test_customers_narrow_their_rows(spark, workspace, staging_rows, monkeypatch):
    staging = workspace.store("staging", staging_rows(*[
        {"id": str(i), "customer_email": f"{i % 5}@x.com"} for i in range(20)]))
    for limit, join in ((500_000, "LeftSemi"), (1, "Inner")):
        monkeypatch.setattr(sys.modules["salesmart.operators.representative"], "BROADCAST_ROWS", limit)
        for plan_of, name in ((star.picked, "customer_dim"), (snowflake.picked, "dim_customer")):
            assert join in plan(plan_of(staging, name, workspace.child(f"{name}_{limit}")))


def test_dimensions_of_few_keys_narrow_their_rows(spark, workspace, staging_rows):
    staging = workspace.store("staging", staging_rows({"id": "2"}, {"id": "1"}))
    for plan_of, names in (
        (star.picked, ["seller_dim", "product_dim", "store_dim", "supplier_dim"]),
        (snowflake.picked, ["dim_seller", "dim_product", "dim_store", "dim_supplier"]),
    ):
        for name in names:
            assert "LeftSemi" in plan(plan_of(staging, name, workspace))


def rank_by_hash(keys):
    def order(key):
        text = "|".join(part for part in key if part is not None)
        return hashlib.md5(text.encode()).hexdigest(), [(p is not None, p or "") for p in key]

    return {key: i for i, key in enumerate(sorted(keys, key=order), start=1)}


@pytest.mark.parametrize("digits", [1, 3])
@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_id_is_the_rank_by_hash(spark, digits, partitions):
    keys = [(f"k{i}", None if i % 5 == 0 else str(i % 4)) for i in range(700)]
    keys += [(None, None), ("", None), (None, ""), ("a|b", None), ("a", "b")]
    frame = spark.createDataFrame(keys, "a string, b string").repartition(partitions)
    got = {(r.a, r.b): r.id for r in dense_id(frame, ["a", "b"], "id", digits).collect()}
    assert got == rank_by_hash(keys)
    assert sorted(got.values()) == list(range(1, len(keys) + 1))


def test_dense_id_of_nothing(spark):
    frame = spark.createDataFrame([], "a string")
    assert dense_id(frame, ["a"], "id").collect() == []


def test_dense_id_never_sorts_the_rows_in_one_task(spark, workspace):
    frame = workspace.store("t", spark.range(1000).selectExpr("string(id) a", "string(id) payload"))
    text = plan(dense_id(frame, ["a"], "id"))
    single = text.split("SinglePartition")
    # Only the shifts, one row per bucket, go through a single partition.
    assert len(single) == 2 and "payload" not in single[1].split("BroadcastExchange")[0]


def test_position_id(spark, workspace):
    frame = spark.range(5000).selectExpr("id % 7 AS a", "1 AS copies").repartition(6)
    stored = workspace.store("fact", frame, rows_per_file=300)
    assert len(stored.inputFiles()) > 6
    numbered = position_id(stored, "id")
    ids = [row.id for row in numbered.select("id").collect()]
    assert sorted(ids) == list(range(1, 5001))
    assert numbered.columns == ["id", "a", "copies"]
    again = position_id(spark.read.parquet(f"{workspace.folder}/fact"), "id")
    assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, again.collect()))
    assert "BroadcastHashJoin" in plan(numbered)


@pytest.fixture
def dim(spark, workspace):
    rows = [("a", "x", 1), ("b", "x", 2), (None, "x", 3), ("", "x", 4)]
    return workspace.store("dim", spark.createDataFrame(rows, "k string, l string, dim_id long"))


def test_attach_key_left_keeps_rows_and_null_never_matches(spark, dim):
    rows = spark.createDataFrame(
        [(1, "a", "x"), (2, None, "x"), (3, "zz", "x"), (4, "", "x"), (5, "a", None), (6, "a", "x")],
        "n int, kk string, ll string",
    )
    got = attach_key(rows, dim, {"kk": "k", "ll": "l"}, "dim_id", "left", "fk")
    assert got.columns == ["n", "fk"]
    assert dict(map(tuple, got.collect())) == {1: 1, 2: None, 3: None, 4: 4, 5: None, 6: 1}
    got = attach_key(rows, dim, {"kk": "k", "ll": "l"}, "dim_id", "inner", "fk")
    assert dict(map(tuple, got.collect())) == {1: 1, 4: 4, 6: 1}


def test_attach_key_broadcasts_by_size_only(spark, dim):
    rows = spark.range(1000).selectExpr("id AS n", "string(id) AS kk")
    assert "BroadcastHashJoin" in plan(attach_key(rows, dim, {"kk": "k"}, "dim_id", "left", "fk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = plan(attach_key(rows, dim, {"kk": "k"}, "dim_id", "left", "fk"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


@pytest.mark.parametrize("hot", ["'7'", "CAST(NULL AS string)"])
def test_hot_and_null_keys_are_split(spark, workspace, hot):
    """A third of the rows under one key, beyond the broadcast limit."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    dims = workspace.store(
        "keys", spark.range(2000).selectExpr("string(id) AS k", "id + 1 AS dim_id")
    )
    rows = workspace.store("rows", spark.range(0, 60000, 1, 12).selectExpr(
        "id AS n", f"CASE WHEN id % 3 = 0 THEN {hot} ELSE string(id % 2000) END AS kk",
        "repeat(md5(string(id)), 3) AS payload",
    ))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = attach_key(rows, dims, {"kk": "k"}, "dim_id", "left", "fk")
        result = joined.agg(F.count("*"), F.sum("fk"), F.count_distinct("n"))
        count, total, distinct = result.collect()[0]
        text = plan(result)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert (count, distinct) == (60000, 60000)
    hot_id = 0 if "NULL" in hot else 8
    assert total == sum(hot_id if i % 3 == 0 else i % 2000 + 1 for i in range(60000))
    assert "skew=true" in text


def test_position_id_moves_no_row_of_the_fact(spark, workspace):
    stored = workspace.store("fact", spark.range(1000).repartition(3).withColumnRenamed("id", "v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = position_id(stored, "id")
        text = plan(numbered)
        assert "SortMergeJoin" not in text and "hashpartitioning(v" not in text
        assert sorted(row.id for row in numbered.collect()) == list(range(1, 1001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partitions", [1, 5])
def test_ranked_id_is_the_row_number_by_key(spark, workspace, partitions):
    keys = [(f"k{i}", None if i % 5 == 0 else str(i % 4)) for i in range(700)]
    keys += [(None, None), ("", None), (None, ""), ("é", None), ("Z", "b"), ("\U0001f642", "b"), ("￿", "b")]
    frame = spark.createDataFrame(keys, "a string, b string").repartition(partitions)
    got = {(r.a, r.b): r.id for r in ranked_id(frame, ["a", "b"], "id", workspace).collect()}
    encoded = lambda key: [(value is not None, (value or "").encode()) for value in key]
    assert got == {key: i for i, key in enumerate(sorted(keys, key=encoded), start=1)}
    assert ranked_id(frame.limit(0), ["a", "b"], "id", workspace.child("none")).count() == 0


def test_ranked_id_never_sorts_the_rows_in_one_task(spark, workspace):
    frame = workspace.store("t", spark.range(1000).selectExpr("string(id) a", "string(id) payload"))
    text = plan(ranked_id(frame, ["a"], "id", workspace))
    single = text.split("SinglePartition")
    # Only the shifts, one row per range, go through a single partition; the rows are read as stored.
    assert len(single) == 2 and "payload" not in single[1].split("BroadcastExchange")[0]
    assert "rangepartitioning" not in text


def test_the_fact_with_ids_is_written_once(spark, staging_rows, tmp_path, monkeypatch):
    staging = staging_rows(*[{"id": str(i), "customer_email": None if i % 3 == 0 else f"c{i}@x.com"}
                             for i in range(1, 40)]).repartition(4)
    stored, store = [], Workspace.store
    monkeypatch.setattr(Workspace, "store", lambda self, name, *a, **k: stored.append(name) or store(self, name, *a, **k))
    work, out = Workspace(spark, str(tmp_path / "work")), Workspace(spark, str(tmp_path / "out"))
    tables = snowflake.build(staging, work, target=out)
    assert stored.count("fact_sales") == 1 and stored.count("linked") == 1
    ids = sorted(r.id for r in tables["fact_sales"].select("id").collect())
    assert ids == list(range(1, 27))
    assert tables["fact_sales"].columns == [column for column, _ in SNOWFLAKE_TABLES["fact_sales"]]
