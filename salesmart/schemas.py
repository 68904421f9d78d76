"""Fixed table layouts: the staging extract, both warehouse profiles, their keys and limits."""

from __future__ import annotations

from pyspark.sql import types as T

# The 50 staging columns. Files are loaded by position, so the order is the contract.
STAGING_COLUMNS = [
    "id",
    "customer_first_name", "customer_last_name", "customer_age", "customer_email",
    "customer_country", "customer_postal_code",
    "customer_pet_type", "customer_pet_name", "customer_pet_breed",
    "seller_first_name", "seller_last_name", "seller_email", "seller_country", "seller_postal_code",
    "product_name", "product_category", "product_price", "product_quantity",
    "sale_date", "sale_customer_id", "sale_seller_id", "sale_product_id",
    "sale_quantity", "sale_total_price",
    "store_name", "store_location", "store_city", "store_state", "store_country",
    "store_phone", "store_email",
    "pet_category",
    "product_weight", "product_color", "product_size", "product_brand", "product_material",
    "product_description", "product_rating", "product_reviews",
    "product_release_date", "product_expiry_date",
    "supplier_name", "supplier_contact", "supplier_email", "supplier_phone",
    "supplier_address", "supplier_city", "supplier_country",
]

#: Every staging column is nullable text; nothing is inferred or coerced at load.
STAGING = T.StructType([T.StructField(name, T.StringType(), True) for name in STAGING_COLUMNS])

# The snowflake tables as (column, SQL type). varchar limits and decimal
# precisions are enforced by `sinks.write_typed_table` and counted by `audits.length_violations`.
SNOWFLAKE_TABLES = {
    "dim_address_customer": [
        ("address_id", "bigint"), ("country", "varchar(200)"), ("postal_code", "varchar(50)"),
    ],
    "dim_pet_info": [
        ("pet_id", "bigint"), ("type", "varchar(100)"), ("name", "varchar(200)"),
        ("breed", "varchar(200)"), ("category", "varchar(100)"),
    ],
    "dim_address_seller": [
        ("address_id", "bigint"), ("country", "varchar(200)"), ("postal_code", "varchar(50)"),
    ],
    "dim_address_store": [
        ("address_id", "bigint"), ("city", "varchar(200)"), ("state", "varchar(200)"),
        ("country", "varchar(200)"),
    ],
    "dim_address_supplier": [
        ("address_id", "bigint"), ("address_line", "varchar(300)"), ("city", "varchar(200)"),
        ("country", "varchar(200)"),
    ],
    "dim_category_product": [("category_id", "bigint"), ("name", "varchar(200)")],
    "dim_customer": [
        ("id", "bigint"), ("first_name", "varchar(200)"), ("last_name", "varchar(200)"),
        ("age", "int"), ("email", "varchar(300)"), ("address_id", "bigint"), ("pet_id", "bigint"),
    ],
    "dim_seller": [
        ("id", "bigint"), ("first_name", "varchar(200)"), ("last_name", "varchar(200)"),
        ("email", "varchar(300)"), ("address_id", "bigint"),
    ],
    "dim_product": [
        ("id", "bigint"), ("name", "varchar(300)"), ("price", "decimal(10,2)"),
        ("quantity", "int"), ("brand", "varchar(200)"), ("weight", "decimal(10,2)"),
        ("color", "varchar(100)"), ("size", "varchar(50)"), ("material", "varchar(200)"),
        ("description", "string"), ("rating", "decimal(3,1)"), ("reviews_count", "int"),
        ("released_on", "date"), ("expires_on", "date"), ("category_id", "bigint"),
    ],
    "dim_store": [
        ("id", "bigint"), ("name", "varchar(300)"), ("location_detail", "varchar(300)"),
        ("phone", "varchar(50)"), ("email", "varchar(300)"), ("address_id", "bigint"),
    ],
    "dim_supplier": [
        ("id", "bigint"), ("name", "varchar(300)"), ("contact", "varchar(300)"),
        ("email", "varchar(300)"), ("phone", "varchar(50)"), ("address_id", "bigint"),
    ],
    "fact_sales": [
        ("id", "bigint"), ("sale_date", "date"), ("quantity", "int"),
        ("total_price", "decimal(12,2)"), ("customer_id", "bigint"), ("seller_id", "bigint"),
        ("product_id", "bigint"), ("store_id", "bigint"), ("supplier_id", "bigint"),
    ],
}

# Primary key column of each snowflake table.
SNOWFLAKE_KEYS = {name: columns[0][0] for name, columns in SNOWFLAKE_TABLES.items()}

# The 11 foreign-key edges as (child table, child column, parent table).
SNOWFLAKE_EDGES = [
    ("dim_customer", "address_id", "dim_address_customer"),
    ("dim_customer", "pet_id", "dim_pet_info"),
    ("dim_seller", "address_id", "dim_address_seller"),
    ("dim_product", "category_id", "dim_category_product"),
    ("dim_store", "address_id", "dim_address_store"),
    ("dim_supplier", "address_id", "dim_address_supplier"),
    ("fact_sales", "customer_id", "dim_customer"),
    ("fact_sales", "seller_id", "dim_seller"),
    ("fact_sales", "product_id", "dim_product"),
    ("fact_sales", "store_id", "dim_store"),
    ("fact_sales", "supplier_id", "dim_supplier"),
]

# The star tables as (column, SQL type).
STAR_TABLES = {
    "customer_dim": [
        ("first_name", "string"), ("last_name", "string"), ("age", "int"), ("email", "string"),
        ("country", "string"), ("postal_code", "string"), ("pet_type", "string"),
        ("pet_name", "string"), ("pet_breed", "string"), ("pet_category", "string"),
        ("customer_id", "bigint"),
    ],
    "seller_dim": [
        ("first_name", "string"), ("last_name", "string"), ("email", "string"),
        ("country", "string"), ("postal_code", "string"), ("seller_id", "bigint"),
    ],
    "product_dim": [
        ("name", "string"), ("category", "string"), ("price", "double"), ("quantity", "int"),
        ("weight", "double"), ("color", "string"), ("size", "string"), ("brand", "string"),
        ("material", "string"), ("description", "string"), ("rating", "double"),
        ("reviews", "int"), ("release_date", "string"), ("expiry_date", "string"),
        ("product_id", "bigint"),
    ],
    "store_dim": [
        ("name", "string"), ("location", "string"), ("city", "string"), ("state", "string"),
        ("country", "string"), ("phone", "string"), ("email", "string"), ("store_id", "bigint"),
    ],
    "supplier_dim": [
        ("name", "string"), ("contact", "string"), ("email", "string"), ("phone", "string"),
        ("address", "string"), ("city", "string"), ("country", "string"),
        ("supplier_id", "bigint"),
    ],
    "sales_fact": [
        ("customer_id", "bigint"), ("seller_id", "bigint"), ("product_id", "bigint"),
        ("store_id", "bigint"), ("supplier_id", "bigint"), ("sale_date", "date"),
        ("quantity", "int"), ("total_price", "decimal(28,8)"),
    ],
}

# Primary key and foreign-key edges of the star tables.
STAR_KEYS = {
    "customer_dim": "customer_id", "seller_dim": "seller_id", "product_dim": "product_id",
    "store_dim": "store_id", "supplier_dim": "supplier_id",
}
STAR_EDGES = [("sales_fact", key, table) for table, key in STAR_KEYS.items()]


def ddl(columns: list[tuple[str, str]]) -> str:
    """Column list for `CREATE TABLE`."""
    return ", ".join(f"`{name}` {sql_type}" for name, sql_type in columns)
