"""Semantics of the two profiles on hand-made rows."""

from datetime import date
from decimal import Decimal

import pytest

from salesmart.plans import reports, snowflake, star


def rows_of(table, *columns):
    return sorted(map(tuple, table.select(*columns).collect()), key=repr)


def test_star_keeps_every_row_and_null_keys_have_no_id(staging_rows, workspace):
    staging = staging_rows(
        {"id": "1"},
        {"id": "2", "customer_email": None, "product_brand": None, "store_name": None},
        {"id": "3", "customer_email": "", "supplier_name": None},
    )
    tables = star.build(staging, workspace)
    assert tables["sales_fact"].count() == 3
    # NULL and '' are one customer each, besides Ann.
    assert rows_of(tables["customer_dim"], "email") == [("",), ("ann@x.com",), (None,)]
    fact = tables["sales_fact"]
    assert fact.where("customer_id IS NULL").count() == 1
    assert fact.where("product_id IS NULL").count() == 1
    assert fact.where("store_id IS NULL").count() == 1
    assert fact.where("supplier_id IS NULL").count() == 1
    assert tables["product_dim"].count() == 2 and tables["supplier_dim"].count() == 2


def test_star_parses_leniently(staging_rows, workspace):
    staging = staging_rows(
        {"sale_quantity": "12.7", "sale_total_price": "-1.00", "sale_date": "13/45/2001",
         "customer_age": " 7 ", "product_price": "1e3", "product_expiry_date": "whenever"},
    )
    tables = star.build(staging, workspace)
    assert rows_of(tables["sales_fact"], "quantity", "total_price", "sale_date") == [
        (12, Decimal("-1.00"), None)
    ]
    assert rows_of(tables["customer_dim"], "age") == [(7,)]
    assert rows_of(tables["product_dim"], "price", "expiry_date") == [(1000.0, "whenever")]


def test_snowflake_is_strict(staging_rows, workspace):
    good = {"id": "1"}
    staging = staging_rows(
        good,
        {"id": "2", "sale_quantity": "12.7", "sale_total_price": "-1.00", "sale_date": ""},
        {"id": "3", "customer_email": None},
        {"id": "4", "seller_email": None},
        {"id": "5", "supplier_email": None},
        {"id": "6", "product_name": None},
        {"id": "7", "store_name": None},
        {"id": "8", "product_brand": None, "product_category": None, "product_color": None},
        {"id": "9", "customer_email": ""},
    )
    tables = snowflake.build(staging, workspace)
    fact = tables["fact_sales"]
    assert rows_of(fact, "sale_date", "quantity", "total_price") == [
        (None, None, None),
        *[(date(2021, 3, 5), 2, Decimal("19.00"))] * 3,
    ]
    assert rows_of(fact, "id") == [(1,), (2,), (3,), (4,)]
    # NULL names are rows of the dimension that nothing points at; emails are never NULL.
    assert rows_of(tables["dim_product"], "name", "brand", "color") == [
        ("Ball", "", ""), ("Ball", "Acme", "red"), (None, "Acme", "red"),
    ]
    assert rows_of(tables["dim_store"], "name") == [("Main",), (None,)]
    assert rows_of(tables["dim_customer"], "email") == [("",), ("ann@x.com",)]
    assert rows_of(tables["dim_category_product"], "name") == [("",), ("Toy",)]


def test_snowflake_drops_sales_in_another_state_of_the_store(staging_rows, workspace):
    staging = staging_rows(
        {"id": "1", "store_state": "IDF"}, {"id": "2", "store_state": "PACA"},
        {"id": "3", "store_state": "IDF"},
    )
    tables = snowflake.build(staging, workspace)
    assert tables["dim_store"].count() == 1 and tables["dim_address_store"].count() == 2
    assert tables["fact_sales"].count() == 2
    assert star.build(staging, workspace.child("star"))["sales_fact"].where(
        "store_id IS NOT NULL").count() == 3


def test_the_first_row_of_a_key_represents_it(staging_rows, workspace):
    staging = staging_rows(
        {"id": "b", "customer_country": "AA"},
        {"id": "a", "customer_country": "ZZ", "customer_age": "50"},
        {"id": "a", "customer_country": "ZZ", "customer_age": "40"},
    )
    customers = star.build(staging, workspace)["customer_dim"]
    assert rows_of(customers, "country", "age") == [("ZZ", 40)]
    tables = snowflake.build(staging, workspace.child("snowflake"))
    joined = tables["dim_customer"].join(tables["dim_address_customer"], "address_id")
    assert rows_of(joined, "country", "age") == [("ZZ", 40)]


def test_build_does_not_depend_on_partitioning(staging_rows, workspace):
    staging = staging_rows(*[
        {"id": str(i % 3), "customer_email": f"c{i % 5}", "product_name": f"p{i % 4}",
         "product_price": str(i), "store_city": f"t{i % 2}", "customer_age": str(i % 9)}
        for i in range(60)
    ])
    one = star.build(staging.coalesce(1), workspace.child("one"))
    many = star.build(staging.repartition(7), workspace.child("many"))
    for name in one:
        assert rows_of(one[name], "*") == rows_of(many[name], "*"), name


def test_strict_build_raises(staging_rows, workspace):
    staging = staging_rows({"sale_date": "13/45/2001"})
    with pytest.raises(Exception, match="PARSE|TIMESTAMP"):
        snowflake.build(staging, workspace, strict=True)


@pytest.mark.parametrize("column", ["product_category", "customer_first_name"])
def test_strict_build_raises_on_long_text(staging_rows, workspace, column):
    staging = staging_rows({column: "a" * 5000})
    assert snowflake.build(staging, workspace.child("lenient"))["fact_sales"].count() == 1
    with pytest.raises(Exception, match="longer than varchar"):
        snowflake.build(staging, workspace, strict=True)


@pytest.fixture
def mart(staging_rows, workspace):
    tables = star.build(staging_rows(
        {"id": "1", "product_brand": "A", "product_rating": "4.0", "sale_total_price": "10.00"},
        {"id": "2", "product_brand": "A", "product_rating": "4.0", "sale_total_price": "20.00"},
        {"id": "3", "product_brand": "B", "product_rating": "1.0", "sale_total_price": "free",
         "customer_email": "bob@x.com", "supplier_name": "Other"},
        {"id": "4", "product_brand": None, "sale_total_price": "5.00", "sale_date": "",
         "customer_email": None},
    ), workspace)
    return reports.Mart(tables)


def test_products_of_all_brands_merge(mart):
    assert rows_of(reports.report(mart, "products_top10"), "*") == [
        ("Ball", "Toy", 6, Decimal("30.00"))
    ]
    # Per product row, without the sales, they do not.
    assert reports.report(mart, "quality_top_rated").count() == 3


def test_average_rating_is_weighted_by_sales(mart):
    assert rows_of(reports.report(mart, "products_avg_rating"), "avg_rating") == [(3.0,)]


def test_unpriced_sales_count_as_orders_but_not_in_averages(mart):
    assert rows_of(reports.report(mart, "time_monthly"), "*") == [(2021, 3, Decimal("30.00"), 3)]
    assert rows_of(reports.report(mart, "time_avg_by_month"), "avg_order_size") == [(15.0,)]
    assert rows_of(reports.report(mart, "stores_by_location"), "sales_count") == [(4,)]


def test_all_null_groups_stay_null(mart):
    checks = reports.report(mart, "customers_avg_check")
    assert rows_of(checks, "email", "avg_check") == [("ann@x.com", 15.0), ("bob@x.com", None)]
    spent = reports.report(mart, "customers_top10").collect()
    assert [(row.email, row.total_spent) for row in spent] == [
        ("ann@x.com", Decimal("30.00")), ("bob@x.com", None),
    ]


def test_only_customers_with_sales_are_counted(mart):
    assert rows_of(reports.report(mart, "customers_by_country"), "*") == [
        ("FR", 2, Decimal("30.00"))
    ]


def test_averages_of_values_beyond_decimals(staging_rows, workspace):
    tables = star.build(staging_rows({"product_rating": "1e30"}, {"product_rating": "1e30"}), workspace)
    result = reports.report(reports.Mart(tables), "products_avg_rating")
    assert rows_of(result, "avg_rating") == [(1e30,)]


def test_stored_rollups_give_the_same_reports(mart, workspace):
    tables = {
        "product_dim": mart.products, "customer_dim": mart.customers, "store_dim": mart.stores,
        "supplier_dim": mart.suppliers, "sales_fact": mart._fact,
    }
    built = reports.build(tables, workspace.child("reports"), ordered=True)
    assert list(built) == list(reports.REPORTS) and len(built) == 18
    for name, table in built.items():
        assert rows_of(table, "*") == rows_of(reports.report(mart, name), "*"), name


def test_ordered_reports_are_sorted(mart):
    rows = reports.report(mart, "suppliers_avg_price", ordered=True).collect()
    averages = [row.avg_product_price for row in rows]
    assert averages == sorted(averages, reverse=True)


def test_averages_keep_all_digits(staging_rows, workspace):
    tables = star.build(staging_rows(
        {"product_rating": "4.1234567", "product_price": "0.0000004"},
        {"id": "2", "product_name": "Bat", "product_rating": "4.1234567", "product_price": "9.5"},
    ), workspace)
    mart = reports.Mart(tables)
    ratings = rows_of(reports.report(mart, "products_avg_rating"), "avg_rating")
    assert ratings == [(4.1234567,), (4.1234567,)]
    prices = rows_of(reports.report(mart, "suppliers_avg_price"), "avg_product_price")
    assert prices == [(4.7500002,)]
