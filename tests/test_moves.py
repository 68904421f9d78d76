"""What steps move, so that their cost grows no faster than the rows."""

from pathlib import Path

import duckdb
import pytest

from salesmart import fixture, sinks, sources
from salesmart.operators import attach_key


def test_packed_csv_round_trip(spark, staging_rows, tmp_path):
    staging = staging_rows(
        {"id": "1", "product_description": 'a "quoted"; text', "store_location": "two\nlines"},
        {"id": "2", "customer_email": "", "seller_email": None, "sale_quantity": " 7 "},
    )
    path = str(tmp_path / "csv")
    sinks.write_csv(staging, path, delimiter=";", compression="gzip")
    files = [file.name for file in Path(path).glob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files)
    again = sources.read_staging_csv(spark, path, delimiter=";")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, staging.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def by_size_none(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_is_broadcast_up_to_a_number_of_rows(spark, workspace, by_size_none):
    dims = workspace.store("dims", spark.sql("SELECT concat('k', id) AS k, id AS n FROM range(100)"))
    rows = spark.sql("SELECT id, if(id % 10 = 0, null, concat('k', id)) AS kk FROM range(200)")

    def joined(most):
        return attach_key(rows, dims, {"kk": "k"}, "n", "left", "fk", broadcast_rows=most)

    assert "SortMergeJoin" in plan(joined(99)) and "SortMergeJoin" not in plan(joined(100))
    expected = {(i, i if i % 10 and i < 100 else None) for i in range(200)}
    assert {tuple(r) for r in joined(99).collect()} == expected
    assert {tuple(r) for r in joined(100).collect()} == expected


def test_line_items_are_not_moved_for_customers_and_suppliers(spark, tmp_path, by_size_none):
    made = {
        "region": "select 0 as r_regionkey, 'R' as r_name",
        "nation": "select i::int as n_nationkey, 'N' || i as n_name, 0 as n_regionkey from range(2) t(i)",
        # key 3 comes twice; the nation of key 4 is unknown
        "customer": "select least(i, 3) as c_custkey, 'C' || i as c_name, if(i = 5, null, i % 2)::int"
                    " as c_nationkey, 'S' as c_mktsegment from range(6) t(i) where i <> 4",
        "supplier": "select i as s_suppkey, 'S' || i as s_name, (i % 2)::int as s_nationkey from range(3) t(i)",
        "part": "select i as p_partkey, 'P' || i as p_name, 'B' as p_brand, 'SMALL' as p_type,"
                " i::int as p_size, 9.5::double as p_retailprice from range(4) t(i)",
        "orders": "select i as o_orderkey, if(i = 7, null, i % 5) as o_custkey, '1' as o_orderpriority from range(9) t(i)",
        "lineitem": "select i % 10 as l_orderkey, i % 4 as l_partkey, i % 3 as l_suppkey, i::int as l_linenumber,"
                    " 2.0::double as l_quantity, 5.25::double as l_extendedprice, 'O' as l_linestatus,"
                    " timestamp '2001-02-03' as l_shipdate from range(40) t(i)",
    }
    duck = duckdb.connect()
    for name, sql in made.items():
        duck.execute(f"create view {name} as {sql}")
        duck.execute(f"copy {name} to '{tmp_path}/{name}.parquet'")
    expected = duck.execute(fixture.STAGING_SQL.format(**{name: name for name in made})).fetchall()
    rows = fixture.staging(spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, expected))
    moves = plan(fixture.staging(spark, str(tmp_path)))
    assert "hashpartitioning(l_orderkey" in moves and "hashpartitioning(l_suppkey" not in moves
    # Customers are joined to the orders by a plan without the line items.
    customers = [j for j in moves.splitlines() if "Join [o_custkey" in j or "Join [c_custkey" in j]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = [j for j in moves.splitlines() if "Join [l_orderkey" in j]
    assert len(customers) == len(lines) == 1 and depth(customers[0]) > depth(lines[0])
