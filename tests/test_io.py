"""Sources, sinks and whole jobs."""

import json
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from salesmart import jobs, sinks, sources
from salesmart.plans import star
from salesmart.schemas import SNOWFLAKE_TABLES, STAGING_COLUMNS
from salesmart.workspace import Workspace


def csv_line(**values):
    return ",".join(values.get(name, "x") for name in STAGING_COLUMNS)


@pytest.fixture
def csv_folder(tmp_path):
    header = ",".join(f"any{i}" for i in range(len(STAGING_COLUMNS)))
    first = [
        csv_line(id="1", customer_email="", seller_email='""'),
        csv_line(id="2", product_name='"a, b"', product_description='"say ""hi"""'),
        csv_line(id="3", store_location='"two\nlines"', sale_quantity=" 7 "),
    ]
    second = [csv_line(id="1", customer_first_name="Zoë")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "MOCK_DATA.csv").write_text("\n".join([header, *first]) + "\n")
    (tmp_path / "in" / "MOCK_DATA (1).csv").write_text("\n".join([header, *second]) + "\n")
    return tmp_path / "in"


def test_read_csv(spark, csv_folder):
    rows = sources.read_staging_csv(spark, str(csv_folder), with_source=True).collect()
    assert len(rows) == 4
    by_key = {(row.id, row._source): row for row in rows}
    one = by_key["1", "MOCK_DATA.csv"]
    assert one.customer_email is None and one.seller_email == ""
    two = by_key["2", "MOCK_DATA.csv"]
    assert two.product_name == "a, b" and two.product_description == 'say "hi"'
    three = by_key["3", "MOCK_DATA.csv"]
    assert three.store_location == "two\nlines" and three.sale_quantity == " 7 "
    assert by_key["1", "MOCK_DATA%20(1).csv"].customer_first_name == "Zoë"


def test_read_listed_files_with_another_delimiter(spark, tmp_path):
    file = tmp_path / "semi.csv"
    file.write_text(";".join(STAGING_COLUMNS) + "\n" + csv_line(id="9").replace(",", ";") + "\n")
    rows = sources.read_staging_csv(spark, [str(file), str(file)], delimiter=";").collect()
    assert [row.id for row in rows] == ["9", "9"]


def test_rows_of_the_wrong_width_fail(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text(",".join(STAGING_COLUMNS) + "\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        sources.read_staging_csv(spark, str(file)).collect()


def test_csv_round_trip(spark, staging_rows, tmp_path):
    staging = staging_rows(
        {"id": "1", "product_description": 'a "quoted", text', "store_location": "two\nlines"},
        {"id": "2", "customer_email": "", "seller_email": None, "sale_quantity": " 7 "},
    )
    path = str(tmp_path / "csv")
    sinks.write_csv(staging, path)
    again = sources.read_staging_csv(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, staging.collect()))


def test_save_all_counts_rows_while_writing(spark, tmp_path):
    tables = {"a": spark.range(10), "b": spark.range(0)}
    assert sinks.save_all(tables, sinks.to_folder(str(tmp_path))) == {"a": 10, "b": 0}
    assert sinks.save_all(tables, sinks.to_folder(str(tmp_path))) == {"a": 10, "b": 0}
    again = sources.read_tables(spark, str(tmp_path), ["a", "b"])
    assert again["a"].count() == 10 and again["b"].count() == 0


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(10, numPartitions=5).selectExpr("id", "id % 3 AS year")
    sinks.write_parquet(rows, path, ["year"])
    assert len(list((tmp_path / "fact").glob("year=*/part-*"))) == 3
    year = spark.read.parquet(path).where("year = 1")
    assert "PartitionFilters: [isnotnull(year" in year._jdf.queryExecution().executedPlan().toString()
    assert year.count() == 3


def test_typed_table_enforces_limits(spark, tmp_path):
    columns = SNOWFLAKE_TABLES["dim_category_product"]
    good = spark.createDataFrame([(1, "a" * 200)], "category_id long, name string")
    sinks.write_typed_table(good, "typed_category", columns, str(tmp_path / "good"))
    assert spark.table("typed_category").count() == 1
    long = spark.createDataFrame([(1, "a" * 201)], "category_id long, name string")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        sinks.write_typed_table(long, "typed_category", columns, str(tmp_path / "long"))
    assert spark.table("typed_category").collect() == [(1, "a" * 200)]  # the old rows are there
    assert [t.name for t in spark.catalog.listTables() if "typed_category" in t.name] == [
        "typed_category"]
    sinks.write_typed_table(good.selectExpr("category_id + 1 AS category_id", "name"),
                            "typed_category", columns)
    assert spark.table("typed_category").first().category_id == 2
    wide = spark.sql("SELECT CAST(12345678901.5 AS decimal(20,2)) AS total")
    with pytest.raises(Exception, match="CAST_OVERFLOW|NUMERIC_VALUE_OUT_OF_RANGE"):
        sinks.write_typed_table(wide, "typed_total", [("total", "decimal(12,2)")],
                                str(tmp_path / "wide"))


def test_views_serve_sql(spark, staging_rows, workspace):
    sources.register_views(star.build(staging_rows({}, {"id": "2"}), workspace))
    total = spark.sql("SELECT sum(quantity) AS q FROM sf JOIN cd USING (customer_id)").first()
    assert total.q == 4


# The JDBC calls are checked without a database: what is asked of Spark, not what it answers.


def test_jdbc_read_options(spark, monkeypatch):
    calls = []

    def fake(self, url, table, **options):
        calls.append((url, table, options))
        return spark.range(1).selectExpr("id", "'x' AS email")

    monkeypatch.setattr(DataFrameReader, "jdbc", fake)
    database = sources.Database("jdbc:any", {"user": "u"})
    sources.read_table(spark, database, "staging_data")
    sources.read_table(spark, database, "staging_data", predicates=["id < 'm'", "id >= 'm'"])
    dim = sources.read_table(spark, database, "customer_dim", ["email"],
                             ranges=sources.Ranges("customer_id", 1, 100, 4))
    properties = {"fetchsize": "10000", "user": "u"}
    assert calls == [
        ("jdbc:any", "staging_data", {"properties": properties}),
        ("jdbc:any", "staging_data",
         {"predicates": ["id < 'm'", "id >= 'm'"], "properties": properties}),
        ("jdbc:any", "customer_dim",
         {"column": "customer_id", "lowerBound": 1, "upperBound": 100, "numPartitions": 4,
          "properties": properties}),
    ]
    assert dim.columns == ["email"]


def test_jdbc_write_options(spark, monkeypatch):
    calls, options = [], {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: options.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, name, mode, properties: calls.append(
        (url, name, mode, properties)))
    database = sources.Database("jdbc:any", {"user": "u"})
    write = sinks.to_database(database, "report_", connections=4, create_table_options="ENGINE = X")
    write("time_yearly", spark.range(1))
    assert calls == [("jdbc:any", "report_time_yearly", "overwrite", {"user": "u"})]
    assert options == {"batchsize": "10000", "numPartitions": "4", "createTableOptions": "ENGINE = X"}


def test_database_from_environment(monkeypatch):
    monkeypatch.setenv("SHOP_URL", "jdbc:any")
    monkeypatch.setenv("SHOP_USER", "u")
    assert sources.Database.from_environment("SHOP") == sources.Database("jdbc:any", {"user": "u"})
    with pytest.raises(KeyError):
        sources.Database.from_environment("OTHER")


def test_workspace_uses_the_shared_folder(spark):
    assert Workspace(spark).folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert Workspace(spark).folder != Workspace(spark).folder


def test_star_and_report_jobs(spark, staging_rows, tmp_path, capsys):
    staging = staging_rows({"id": "1"}, {"id": "2", "customer_email": None})
    sinks.write_csv(staging, str(tmp_path / "csv"))
    jobs.main([
        "star", "--csv", str(tmp_path / "csv"), "--out", str(tmp_path / "out"),
        "--audits-out", str(tmp_path / "audits"), "--work", str(tmp_path / "work"),
    ])
    rows = json.loads(capsys.readouterr().out)
    assert rows["staging_data"] == 2 and rows["sales_fact"] == 2 and rows["customer_dim"] == 2
    rejects = spark.read.parquet(str(tmp_path / "audits" / "audit_rejects")).collect()
    assert [(row.id, row.rule) for row in rejects] == [("2", "no_customer")]
    assert rejects[0]._source.endswith(".csv")
    jobs.main([
        "reports", "--star", str(tmp_path / "out"), "--reports-out", str(tmp_path / "reports"),
        "--work", str(tmp_path / "work"), "--ordered",
    ])
    rows = json.loads(capsys.readouterr().out)
    assert len(rows) == 18 and all(name.startswith("report_") for name in rows)
    yearly = spark.read.parquet(str(tmp_path / "reports" / "report_time_yearly"))
    assert [tuple(row) for row in yearly.collect()] == [(2021, Decimal("38.00"), 2)]


def test_jobs_with_databases(spark, staging_rows, tmp_path, monkeypatch, capsys):
    """Reports from and to a database that is faked: what is read, how it is split and written."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    tables = star.build(staging_rows({"id": "1"}, {"id": "2"}),
                        Workspace(spark, str(tmp_path / "star")))
    before = set(shared.glob("salesmart-*"))
    for prefix in ("SOURCE", "TARGET", "REPORTS"):
        monkeypatch.setenv(f"SALESMART_{prefix}_URL", f"jdbc:{prefix.lower()}")
    read, written = {}, []

    def fake_read(self, url, table, **options):
        assert url == "jdbc:source"
        read[table] = options
        return tables[table] if table in tables else staging_rows({"id": "1"})

    def fake_write(table, database, name, **options):
        written.append((database.url, name, table.count(), options))
        table.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_read)
    monkeypatch.setattr(sinks.writers, "write_jdbc", fake_write)
    jobs.main(["reports", "--star-jdbc", "--ranges", "sales_fact:sale_id:1:100:4",
               "customer_dim:customer_id:1:9:2", "--reports-jdbc", "--connections", "3",
               "--batch-size", "50", "--table-options", "ENGINE = X"])
    assert set(read) == {"customer_dim", "product_dim", "store_dim", "supplier_dim", "sales_fact"}
    assert read["sales_fact"]["numPartitions"] == 4 and read["customer_dim"]["upperBound"] == 9
    assert "numPartitions" not in read["store_dim"]
    assert len(written) == 18 and {url for url, *_ in written} == {"jdbc:reports"}
    assert written[0][-1] == {
        "connections": 3, "batch_size": 50, "create_table_options": "ENGINE = X"}
    written.clear()
    jobs.main(["star", "--jdbc-table", "staging_data", "--predicates", "id < 'm'", "id >= 'm'",
               "--out-jdbc"])
    assert read["staging_data"]["predicates"] == ["id < 'm'", "id >= 'm'"]
    assert {name: n for _, name, n, _ in written}["sales_fact"] == 1
    assert set(shared.glob("salesmart-*")) == before  # a job removes its intermediate tables


def test_snowflake_job(spark, staging_rows, tmp_path, capsys):
    staging = staging_rows({"id": "1"}, {"id": "2", "customer_email": None})
    staging.write.parquet(str(tmp_path / "staging"))
    jobs.main([
        "snowflake", "--parquet", str(tmp_path / "staging"), "--out", str(tmp_path / "out"),
        "--work", str(tmp_path / "work"), "--audits-out", str(tmp_path / "audits"),
    ])
    rows = json.loads(capsys.readouterr().out)
    assert rows["staging_raw"] == 2 and rows["fact_sales"] == 1
    assert rows["audit_fk"] == 11 and rows["audit_pk"] == 12 and rows["audit_lengths"] == 34
    fact = spark.read.parquet(str(tmp_path / "out" / "fact_sales"))
    assert fact.columns == [column for column, _ in SNOWFLAKE_TABLES["fact_sales"]]


def test_text_that_stood_for_an_empty_value_survives(spark, staging_rows, tmp_path):
    """'' and NULL are told apart by the reader, not by a comparison of each of the 50 columns."""
    staging = staging_rows(
        {"id": "1", "customer_email": "\u0001empty\u0001", "seller_email": "", "product_name": None},
        {"id": "2", "supplier_country": None}, {"id": "3", "supplier_country": ""},
    )
    sinks.write_csv(staging, str(tmp_path / "csv"), compression="gzip")
    again = sources.read_staging_csv(spark, str(tmp_path / "csv"))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, staging.collect()))
    assert "CASE WHEN" not in again._jdf.queryExecution().optimizedPlan().toString()


def test_csv_is_packed_at_the_level_set(spark, staging_rows, tmp_path, monkeypatch):
    staging = staging_rows(*[{"id": str(i)} for i in range(500)]).coalesce(1)
    size = {}
    for level in ("NO_COMPRESSION", sinks.writers.ZLIB_LEVEL):
        monkeypatch.setattr(sinks.writers, "ZLIB_LEVEL", level)
        sinks.write_csv(staging, str(tmp_path / level), compression="gzip")
        size[level] = sum(file.stat().st_size for file in (tmp_path / level).glob("*.csv.gz"))
    assert size["FOUR"] * 5 < size["NO_COMPRESSION"]
