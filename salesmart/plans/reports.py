"""The eighteen reports on the star tables, in six marts of three.

Reports do not read the fact directly. They start from *rollups*: sums and counts per
surrogate key, combined on the map side. A hot customer or product is then a single row
before it meets its dimension, and all reports of a mart share one pass over the fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.workspace import Workspace

# Rollup -> surrogate keys it is grouped by.
ROLLUP_KEYS = {
    "product": ["product_id"],
    "customer": ["customer_id"],
    "store": ["store_id"],
    "supplier": ["supplier_id"],
    "supplier_product": ["supplier_id", "product_id"],
}

MONEY = "decimal(38,8)"


def _measures(prices: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sales"),
        F.count(prices).alias("priced"),
        F.sum("quantity").alias("quantity"),
        F.sum(prices).cast(MONEY).alias("revenue"),
    ]


def rollup(fact: DataFrame, name: str) -> DataFrame:
    """Sales, priced sales, quantity and revenue per key; sales without the key are left out."""
    prices = F.col("total_price")
    if name == "month":
        dated = fact.where(F.col("sale_date").isNotNull())
        keys = [F.year("sale_date").alias("year"), F.month("sale_date").alias("month")]
        return dated.groupBy(*keys).agg(*_measures(prices))
    keys = ROLLUP_KEYS[name]
    for key in keys:
        fact = fact.where(F.col(key).isNotNull())
    return fact.groupBy(*keys).agg(*_measures(prices))


class Mart:
    """The star tables and their rollups, as the reports see them."""

    def __init__(self, tables: Mapping[str, DataFrame], rollups: Mapping[str, DataFrame] = None):
        self.products = tables["product_dim"]
        self.customers = tables["customer_dim"]
        self.stores = tables["store_dim"]
        self.suppliers = tables["supplier_dim"]
        self._fact = tables["sales_fact"]
        self._rollups = rollups or {}

    def by(self, name: str) -> DataFrame:
        return self._rollups[name] if name in self._rollups else rollup(self._fact, name)

    def sold_products(self) -> DataFrame:
        return self.by("product").join(self.products.drop("quantity"), "product_id")

    def buying_customers(self) -> DataFrame:
        return self.by("customer").join(self.customers, "customer_id")

    def selling_stores(self) -> DataFrame:
        return self.by("store").join(self.stores, "store_id")

    def selling_suppliers(self) -> DataFrame:
        return self.by("supplier").join(self.suppliers, "supplier_id")


def _total(column: str, name: str) -> Column:
    total = F.sum(column)
    return (total.cast(MONEY) if column == "revenue" else total).alias(name)


def _average_price(name: str) -> Column:
    """Mean price of the priced sales. The sum is exact, so there is only one rounding."""
    return F.try_divide(F.sum("revenue").cast("double"), F.sum("priced")).alias(name)


def _average_per_sale(attribute: str, name: str) -> Column:
    """Mean of a dimension attribute over the sales, i.e. weighted by the number of sales.

    The attribute is a double, whose sum would depend on the order of the rows. It is summed as
    a decimal where that loses nothing: where every value of the group is the same as a decimal.
    """
    value, exact = F.col(attribute), F.col(attribute).try_cast("decimal(24,12)")
    same = F.coalesce(exact.cast("double") == value, F.lit(False))
    misfits = F.count_if(value.isNotNull() & ~same)
    # A factor without decimals keeps all twelve of the product.
    sales = F.col("sales").cast("decimal(12,0)")
    total = F.when(misfits == 0, F.sum(exact * sales).cast("double"))
    total = total.otherwise(F.sum(value * F.col("sales")))
    known = F.sum(F.when(value.isNotNull(), F.col("sales")))
    return F.try_divide(total, known).alias(name)


def products_top10(mart: Mart) -> DataFrame:
    return mart.sold_products().groupBy("name", "category").agg(
        _total("quantity", "total_quantity"), _total("revenue", "total_revenue")
    )


def products_revenue_by_category(mart: Mart) -> DataFrame:
    return mart.sold_products().groupBy("category").agg(_total("revenue", "total_revenue"))


def products_avg_rating(mart: Mart) -> DataFrame:
    return mart.sold_products().groupBy("name", "category").agg(
        _average_per_sale("rating", "avg_rating")
    )


def customers_top10(mart: Mart) -> DataFrame:
    return mart.buying_customers().groupBy("first_name", "last_name", "email").agg(
        _total("revenue", "total_spent")
    )


def customers_by_country(mart: Mart) -> DataFrame:
    # The rollup has one row per customer, so counting its rows counts distinct customers.
    return mart.buying_customers().groupBy("country").agg(
        F.count("customer_id").alias("num_customers"), _total("revenue", "total_revenue")
    )


def customers_avg_check(mart: Mart) -> DataFrame:
    return mart.buying_customers().groupBy("first_name", "last_name", "email").agg(
        _average_price("avg_check")
    )


def time_monthly(mart: Mart) -> DataFrame:
    return mart.by("month").select(
        "year", "month", F.col("revenue").alias("total_revenue"), F.col("sales").alias("num_orders")
    )


def time_yearly(mart: Mart) -> DataFrame:
    return mart.by("month").groupBy("year").agg(
        _total("revenue", "total_revenue"), _total("sales", "num_orders")
    )


def time_avg_by_month(mart: Mart) -> DataFrame:
    return mart.by("month").groupBy("year", "month").agg(_average_price("avg_order_size"))


def stores_top5(mart: Mart) -> DataFrame:
    return mart.selling_stores().groupBy("name", "city", "country").agg(
        _total("revenue", "total_revenue")
    )


def stores_by_location(mart: Mart) -> DataFrame:
    return mart.selling_stores().groupBy("city", "country").agg(
        _total("sales", "sales_count"), _total("revenue", "total_revenue")
    )


def stores_avg_check(mart: Mart) -> DataFrame:
    return mart.selling_stores().groupBy("name", "city").agg(_average_price("avg_check"))


def suppliers_top5(mart: Mart) -> DataFrame:
    return mart.selling_suppliers().groupBy("name", "country").agg(
        _total("revenue", "total_revenue")
    )


def suppliers_avg_price(mart: Mart) -> DataFrame:
    prices = mart.products.select("product_id", "price")
    names = mart.suppliers.select("supplier_id", "name")
    pairs = mart.by("supplier_product").join(prices, "product_id").join(names, "supplier_id")
    return pairs.groupBy("name").agg(_average_per_sale("price", "avg_product_price"))


def suppliers_by_country(mart: Mart) -> DataFrame:
    # One row per supplier, as for customers.
    return mart.selling_suppliers().groupBy("country").agg(
        _total("revenue", "total_revenue"), F.count("supplier_id").alias("num_suppliers")
    )


def quality_top_rated(mart: Mart) -> DataFrame:
    return mart.products.where(F.col("rating").isNotNull()).select("name", "category", "rating")


def quality_rating_vs_sales(mart: Mart) -> DataFrame:
    return mart.sold_products().groupBy("name", "category", "rating").agg(
        _total("quantity", "total_quantity_sold"), _total("revenue", "total_revenue")
    )


def quality_most_reviewed(mart: Mart) -> DataFrame:
    return mart.products.where(F.col("reviews").isNotNull()).select("name", "category", "reviews")


@dataclass(frozen=True)
class Report:
    rows: Callable[[Mart], DataFrame]
    #: column the report is sorted by, largest first; None sorts by ``ties`` alone
    largest: str | None
    #: columns that make the order total, ascending
    ties: tuple[str, ...]
    limit: int | None = None


# The reports, their order and their limits.
REPORTS = {
    "products_top10": Report(products_top10, "total_quantity", ("name", "category"), 10),
    "products_revenue_by_category": Report(
        products_revenue_by_category, "total_revenue", ("category",)
    ),
    "products_avg_rating": Report(products_avg_rating, "avg_rating", ("name", "category")),
    "customers_top10": Report(
        customers_top10, "total_spent", ("first_name", "last_name", "email"), 10
    ),
    "customers_by_country": Report(customers_by_country, "num_customers", ("country",)),
    "customers_avg_check": Report(
        customers_avg_check, "avg_check", ("first_name", "last_name", "email")
    ),
    "time_monthly": Report(time_monthly, None, ("year", "month")),
    "time_yearly": Report(time_yearly, None, ("year",)),
    "time_avg_by_month": Report(time_avg_by_month, None, ("year", "month")),
    "stores_top5": Report(stores_top5, "total_revenue", ("name", "city", "country"), 5),
    "stores_by_location": Report(stores_by_location, "total_revenue", ("city", "country")),
    "stores_avg_check": Report(stores_avg_check, "avg_check", ("name", "city")),
    "suppliers_top5": Report(suppliers_top5, "total_revenue", ("name", "country"), 5),
    "suppliers_avg_price": Report(suppliers_avg_price, "avg_product_price", ("name",)),
    "suppliers_by_country": Report(suppliers_by_country, "total_revenue", ("country",)),
    "quality_top_rated": Report(quality_top_rated, "rating", ("name", "category"), 10),
    "quality_rating_vs_sales": Report(quality_rating_vs_sales, "rating", ("name", "category")),
    "quality_most_reviewed": Report(quality_most_reviewed, "reviews", ("name", "category"), 10),
}


def report(mart: Mart, name: str, ordered: bool = False) -> DataFrame:
    """One report. A limit always picks the first rows of the report's order, ties included;
    without a limit the rows are sorted only if ``ordered``, as a table has no order."""
    spec = REPORTS[name]
    rows = spec.rows(mart)
    if spec.limit is None and not ordered:
        return rows
    order = [F.col(spec.largest).desc_nulls_last()] if spec.largest else []
    rows = rows.orderBy(*order, *[F.col(column).asc_nulls_first() for column in spec.ties])
    return rows.limit(spec.limit) if spec.limit else rows


def build(
    tables: Mapping[str, DataFrame], workspace: Workspace, ordered: bool = False
) -> dict[str, DataFrame]:
    """All reports. Their rollups are stored first: six scans of the fact instead of sixteen."""
    rollups = workspace.child("by").store_all(
        [*ROLLUP_KEYS, "month"], lambda name: rollup(tables["sales_fact"], name)
    )
    mart = Mart(tables, rollups)
    return {name: report(mart, name, ordered) for name in REPORTS}
