"""Every registered query against its oracle, and the row counts the fixture must give."""

from collections import Counter

import pytest

import __spark_entry__ as entry

from conftest import TESTDATA

SMALL = str(TESTDATA / "sf0.001")
MEDIUM = str(TESTDATA / "sf0.01")
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def connection(duck):
    return duck(SMALL)


# The training-data queries have tests of their own, and may be missing.
QUERIES = {n: q for n, q in QUERIES.items() if not n.startswith("op") and n != "pipeline"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, connection, name):
    ours = QUERIES[name](spark, SMALL)
    columns = sorted(ours.columns)
    result = connection.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]).replace(" ", "") for column in result.description}
    assert columns == sorted(names)
    declared = {
        column: "VARCHAR" if kind.startswith("varchar") else TYPES.get(kind, kind.upper())
        for column, kind in ours.dtypes
    }
    assert declared == types
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in ours.collect()) == theirs


@pytest.mark.parametrize("folder", [SMALL])
def test_earlier_results_stay_when_a_query_is_called_again(spark, folder):
    names = [n for n in QUERIES if n.startswith(("snow_dim", "star_", "csv", "sink", "typed"))]
    first = {name: QUERIES[name](spark, folder) for name in names}
    for name in names:
        QUERIES[name](spark, folder)
    for name, rows in first.items():
        assert rows.count() >= 0, name


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_queries_leave_no_python_in_the_plan(spark):
    for name, query in QUERIES.items():
        text = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for operator in ("Python", "Arrow", "CartesianProduct", "NestedLoop"):
            assert operator not in text, name


# Row counts of the fixture at sf0.01.
EXPECTED = {
    "staging_raw": 60_000,
    "dim_address_customer": 1_286, "dim_pet_info": 2_752, "dim_address_seller": 25,
    "dim_address_store": 50, "dim_address_supplier": 86, "dim_category_product": 6,
    "dim_customer": 1_487, "dim_seller": 36, "dim_product": 1_801, "dim_store": 86,
    "dim_supplier": 99, "fact_sales": 28_348,
    "customer_dim": 1_488, "seller_dim": 37, "product_dim": 1_801, "store_dim": 86,
    "supplier_dim": 100, "sales_fact": 60_000,
}
NON_NULL = {
    "star_sales_fact": {
        "customer_id": 59_676, "seller_id": 58_566, "product_id": 49_376, "store_id": 59_459,
        "supplier_id": 59_417, "sale_date": 59_765, "quantity": 59_799, "total_price": 60_000,
    },
    "snow_fact_sales": {"sale_date": 28_235, "quantity": 28_095, "total_price": 28_275},
}


def test_row_counts(spark):
    rows = QUERIES["audit_table_counts"](spark, MEDIUM).collect()
    assert {row.table: row.n for row in rows} == EXPECTED


@pytest.mark.parametrize("name", NON_NULL)
def test_non_null_counts(spark, name):
    counts = QUERIES[name](spark, MEDIUM).selectExpr(
        *[f"count({column}) AS {column}" for column in NON_NULL[name]]
    ).collect()[0]
    assert counts.asDict() == NON_NULL[name]


