from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from salesmart.schemas import STAGING, STAGING_COLUMNS  # noqa: E402
from salesmart.workspace import Workspace  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(spark, str(tmp_path / "work"))


@pytest.fixture(scope="session")
def duck():
    def connect(folder):
        connection = duckdb.connect()
        for file in sorted(os.listdir(folder)):
            connection.execute(
                f"create view {file.removesuffix('.parquet')} as select * from '{folder}/{file}'"
            )
        return connection

    return connect


@pytest.fixture
def staging_rows(spark):
    """Build a staging DataFrame from dictionaries; columns left out get a usable default."""
    defaults = {
        "id": "1",
        "customer_first_name": "Ann", "customer_last_name": "Lee", "customer_age": "30",
        "customer_email": "ann@x.com", "customer_country": "FR", "customer_postal_code": "75001",
        "customer_pet_type": "cat", "customer_pet_name": "Tom", "customer_pet_breed": "mix",
        "seller_first_name": "Sam", "seller_last_name": "Roe", "seller_email": "sam@x.com",
        "seller_country": "DE", "seller_postal_code": "10115",
        "product_name": "Ball", "product_category": "Toy", "product_price": "9.50",
        "product_quantity": "5", "sale_date": "3/5/2021", "sale_customer_id": "1",
        "sale_seller_id": "1", "sale_product_id": "1", "sale_quantity": "2",
        "sale_total_price": "19.00", "store_name": "Main", "store_location": "Hall",
        "store_city": "Paris", "store_state": "IDF", "store_country": "FR",
        "store_phone": "1", "store_email": "st@x.com", "pet_category": "pets",
        "product_weight": "1.5", "product_color": "red", "product_size": "S",
        "product_brand": "Acme", "product_material": "wool", "product_description": "a ball",
        "product_rating": "4.5", "product_reviews": "10", "product_release_date": "1/2/2019",
        "product_expiry_date": "12/31/2030", "supplier_name": "Sup", "supplier_contact": "Al",
        "supplier_email": "sup@x.com", "supplier_phone": "2", "supplier_address": "1 Road",
        "supplier_city": "Rome", "supplier_country": "IT",
    }

    def build(*rows):
        complete = [{**defaults, **row} for row in rows]
        return spark.createDataFrame(
            [tuple(row[c] for c in STAGING_COLUMNS) for row in complete], STAGING
        )

    return build
