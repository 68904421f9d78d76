"""Audits on tables that are wrong on purpose."""

import pytest

from salesmart.plans import audits, snowflake, star
from salesmart.schemas import SNOWFLAKE_EDGES, SNOWFLAKE_KEYS, SNOWFLAKE_TABLES


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_table_counts(spark):
    assert found(audits.table_counts({"a": spark.range(3), "b": spark.range(0)})) == [
        ("a", 3), ("b", 0)
    ]


def test_fk_violations(spark):
    tables = {
        "parent": spark.createDataFrame([(1,), (2,)], "id long"),
        "child": spark.createDataFrame([(1,), (None,), (3,), (3,), (9,)], "p long"),
    }
    edges = [("child", "p", "parent")]
    assert found(audits.fk_violations(tables, edges, {"parent": "id"})) == [("child.p", 3)]
    tables["child"] = tables["child"].limit(0)
    assert found(audits.fk_violations(tables, edges, {"parent": "id"})) == [("child.p", 0)]


@pytest.mark.parametrize("ids, expected", [
    ([1, 2, 3], (0, 0)),
    ([1, 1, 1, 2, None, None], (2, 2)),
    ([32768, 32769, 32768, 65537, 1, 65537], (2, 0)),
    ([10**12, 10**12, 5], (1, 0)),
    ([], (0, 0)),
])
def test_pk_violations(spark, ids, expected):
    table = spark.createDataFrame([(i,) for i in ids], "id long")
    assert found(audits.pk_violations({"t": table}, {"t": "id"})) == [("t", *expected)]


def test_length_violations(spark):
    table = spark.createDataFrame([("abcd", "x"), ("ab", None), ("é" * 3, "y")], "a string, b string")
    layout = {"t": [("a", "varchar(3)"), ("b", "varchar(1)"), ("c", "int")], "u": [("c", "int")]}
    assert found(audits.length_violations({"t": table}, layout)) == [
        ("t", "a", 3, 1), ("t", "b", 1, 0)
    ]


@pytest.fixture
def staging(staging_rows):
    return staging_rows(
        {"id": "1"},
        {"id": "2", "customer_email": None, "sale_quantity": "12.7"},
        {"id": "3", "store_state": "PACA", "sale_date": "13/45/2001", "product_rating": "123.4"},
        {"id": "4", "sale_total_price": "-1.00", "customer_age": "old", "sale_date": ""},
    )


def test_snowflake_audits(staging, workspace):
    keys = snowflake.number(staging, workspace)
    tables = snowflake.build(staging, workspace, keys=keys)
    assert found(audits.snowflake_rejects(snowflake.linked(staging, keys))) == [
        ("2", "bad_sale_quantity"), ("2", "no_customer"),
        ("3", "bad_product_rating"), ("3", "bad_sale_date"), ("3", "no_store"),
        ("4", "bad_customer_age"), ("4", "bad_sale_total_price"),
    ]
    assert tables["fact_sales"].count() == 2
    edges = audits.fk_violations(tables, SNOWFLAKE_EDGES, SNOWFLAKE_KEYS).collect()
    assert len(edges) == 11 and not any(row.n for row in edges)
    keys = audits.pk_violations(tables, SNOWFLAKE_KEYS).collect()
    assert len(keys) == 12 and not any(row.surplus_ids or row.null_ids for row in keys)
    lengths = audits.length_violations(tables, SNOWFLAKE_TABLES).collect()
    assert len(lengths) == 34 and not any(row.n for row in lengths)


def test_star_audits(staging, workspace):
    tables = star.build(staging, workspace)
    rejects = audits.star_rejects(
        star.linked(staging, tables, ("id", "sale_date")), kept=("id", "sale_date")
    )
    assert found(rejects) == [
        ("2", "3/5/2021", "no_customer"), ("3", "13/45/2001", "bad_sale_date"),
        ("4", "", "bad_customer_age"),
    ]
    counts = audits.reject_counts({"star": rejects})
    assert found(counts) == [
        ("star", "bad_customer_age", 1), ("star", "bad_sale_date", 1), ("star", "no_customer", 1)
    ]


def test_each_child_is_scanned_once_for_all_its_edges(spark, workspace):
    child = workspace.store("child", spark.sql("SELECT id a, id + 1 b FROM range(5)"))
    tables = {"child": child, "p": spark.range(5), "q": spark.range(3)}
    edges = [("child", "a", "p"), ("child", "b", "q")]
    found = audits.fk_violations(tables, edges, {"p": "id", "q": "id"})
    assert {row.edge: row.n for row in found.collect()} == {"child.a": 0, "child.b": 3}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


@pytest.mark.parametrize("broadcast_rows", [500_000, 3, 0])
def test_fk_violations_of_any_ids(spark, monkeypatch, broadcast_rows):
    """Negative, far apart, repeated and missing ids; parents too large to broadcast are joined."""
    monkeypatch.setattr(audits, "BROADCAST_ROWS", broadcast_rows)
    ids = [0, 63, 64, -1, 10**15, 5, 5, None]
    used = [(0, 64), (63, 65), (1, None), (1, -1), (-64, -2), (10**15, 10**15 + 1), (None, 5), (5, 5)]
    tables = {
        "parent": spark.createDataFrame([(i,) for i in ids], "id long"),
        "none": spark.range(0),
        "child": spark.createDataFrame(used, "a long, b long"),
    }
    edges = [("child", "a", "parent"), ("child", "b", "parent")]
    keys = {"parent": "id", "none": "id"}
    assert found(audits.fk_violations(tables, edges, keys)) == [("child.a", 3), ("child.b", 3)]
    assert found(audits.fk_violations(tables, [("child", "a", "none")], keys)) == [("child.a", 7)]


def test_fk_violations_move_no_row_of_the_child(spark, workspace):
    child = workspace.store("child", spark.sql("SELECT id a, id % 7 b FROM range(1000)"))
    tables = {"child": child, "p": spark.range(990), "q": spark.range(7)}
    edges = [("child", "a", "p"), ("child", "b", "q")]
    rows = audits.fk_violations(tables, edges, {"p": "id", "q": "id"})
    assert {row.edge: row.n for row in rows.collect()} == {"child.a": 10, "child.b": 0}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "inline" in plan and "Aggregate [edge" not in plan


def test_rules_are_compiled(spark, staging, workspace):
    """A function with a lambda would be interpreted row by row, with all rules in it."""
    dims = star.dimensions(staging, workspace.child("star"))
    keys = snowflake.number(staging, workspace.child("snowflake"))
    for rows in (star.linked(staging, dims), snowflake.linked(staging, keys)):
        assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
        assert not rows.schema["broken"].dataType.containsNull
