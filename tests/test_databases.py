"""Reading and writing databases: splits that cover every row once, writes that keep the old table.
What is asked of the database is recorded; none is started."""

import datetime
import json

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from salesmart import jobs, sinks, sources
from salesmart.plans import star
from salesmart.workspace import Workspace

DATABASE = sources.Database("jdbc:any", {"user": "u"})


def conditions_met(spark, values, predicates):
    rows = spark.createDataFrame([(v,) for v in values], "k string")
    met = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    return [row.n for row in rows.select(met.alias("n")).collect()]


def test_text_predicates_cover_every_row_once(spark):
    values = [f"{c}{n}" for c in "aAzZé'\\ " for n in range(40)] + [None, "", " ", "~~", "\U0001f642"]
    cuts = sources.cut_points([v for v in values if v is not None], 8)
    assert 4 <= len(cuts) <= 7 and not any(set(c) & set("'\\é") for c in cuts)
    predicates = sources.text_predicates("k", cuts)
    assert conditions_met(spark, values * 2, predicates) == [1] * (2 * len(values))
    # In whatever order the database sorts: here cuts that are not sorted at all.
    assert set(conditions_met(spark, values, sources.text_predicates("k", cuts[::-1]))) == {1}
    assert sources.text_predicates("k", []) == ["1 = 1"]
    assert sources.cut_points(["é", "'", ""], 4) == [] and sources.cut_points(["a"], 4) == []


def test_parts_are_about_equal(spark):
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    predicates = sources.text_predicates("k", sources.cut_points(sources.key_sample(keys, 2000), 10))
    sizes = [keys.where(p).count() for p in predicates]
    assert len(sizes) == 10 and sum(sizes) == 20_000 and max(sizes) < 3000 and min(sizes) > 1000


def test_a_hot_key_does_not_fill_the_sample(spark):
    keys = spark.range(9000).select(
        F.when(F.col("id") < 6000, "m").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    sample = sources.key_sample(keys, 500)
    assert len(set(sample)) == 500


@pytest.fixture
def asked(spark, monkeypatch):
    """Answers of a database by what is asked for; returns the calls."""
    calls, answers = [], {}

    def fake(self, url, table, **options):
        calls.append((table, options))
        return next((rows for part, rows in answers.items() if part in table), spark.range(0))

    monkeypatch.setattr(DataFrameReader, "jdbc", fake)
    return calls, answers


def test_ranges_are_measured_by_one_query(spark, asked):
    calls, answers = asked
    answers["min(sale_date)"] = spark.sql("SELECT date'2021-01-05' AS low, date'2021-03-01' AS high")
    answers["min(price)"] = spark.sql("SELECT 1.5 AS low, 9.2 AS high")
    answers["min(none)"] = spark.sql("SELECT CAST(NULL AS int) AS low, CAST(NULL AS int) AS high")
    found = [sources.measured_ranges(spark, DATABASE, "sales_fact", c, 4) for c in ("sale_date", "price", "none")]
    assert found == [sources.Ranges("sale_date", "2021-01-05", "2021-03-01", 4), sources.Ranges("price", 1, 11, 4), None]
    assert calls[0] == ("(SELECT min(sale_date) AS low, max(sale_date) AS high FROM sales_fact) bounds",
                        {"properties": {"user": "u"}})
    assert len(calls) == 3


def test_text_splits_ask_for_the_key_alone(spark, asked):
    calls, answers = asked
    answers["DISTINCT id"] = spark.range(100).select(F.col("id").cast("string").alias("id"))
    predicates = sources.text_splits(spark, DATABASE, "staging", "id", 4)
    assert len(predicates) == 4 and calls[0][0] == "(SELECT DISTINCT id FROM staging) keys_of_id"
    ids = [str(i) for i in range(500)] + [None, "x"]
    rows = spark.createDataFrame([(v,) for v in ids], "id string")
    assert sum(rows.where(p).count() for p in predicates) == len(ids)


def test_jobs_measure_and_split(spark, staging_rows, tmp_path, monkeypatch, asked, capsys):
    """The commands of the README, on a faked database."""
    calls, answers = asked
    tables = star.build(staging_rows({"id": "1"}, {"id": "2"}), Workspace(spark, str(tmp_path / "star")))
    answers["min(sale_date)"] = tables["sales_fact"].select(
        F.min("sale_date").alias("low"), F.max("sale_date").alias("high"))
    answers["DISTINCT id"] = spark.range(100).select(F.col("id").cast("string").alias("id"))
    answers |= tables | {"staging_data": staging_rows({"id": "1"})}
    for prefix in ("SOURCE", "TARGET", "REPORTS"):
        monkeypatch.setenv(f"SALESMART_{prefix}_URL", f"jdbc:{prefix.lower()}")
    jobs.main(["reports", "--star-jdbc", "--ranges", "sales_fact:sale_date:32", "customer_dim:customer_id:1:9:2",
               "--reports-out", str(tmp_path / "reports")])
    assert len(json.loads(capsys.readouterr().out)) == 18
    read = dict(calls)
    assert read["sales_fact"]["column"] == "sale_date" and read["sales_fact"]["numPartitions"] == 32
    assert read["sales_fact"]["lowerBound"] == str(datetime.date(2021, 3, 5))
    assert read["customer_dim"]["upperBound"] == 9 and "column" not in read["store_dim"]
    jobs.main(["star", "--jdbc-table", "staging_data", "--split-by", "id:8", "--out", str(tmp_path / "out")])
    assert len(dict(calls)["staging_data"]["predicates"]) == 8
    assert jobs.table_ranges("a:b") == ("a", ("b", jobs.SCAN_TASKS))


@pytest.fixture
def written(monkeypatch):
    """Records of writes and statements; ``fail`` holds the tables whose write fails."""
    log, fail = [], set()

    def fake(self, url, name, mode, properties):
        log.append(("load", name, mode))
        if name in fail:
            raise RuntimeError("connection lost")

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake)
    monkeypatch.setattr(sinks.writers, "execute", lambda spark, database, statements: log.append(
        ("run", *statements)))
    return log, fail


def test_a_swap_loads_beside_the_old_table(spark, written):
    log, _ = written
    sinks.to_database(DATABASE, replace="swap")("t", spark.range(1))
    assert log == [
        ("load", "t__new", "overwrite"),
        ("run", "DROP TABLE IF EXISTS t__old"),
        ("run", "CREATE TABLE IF NOT EXISTS t AS SELECT * FROM t__new WHERE 1 = 0",
         "ALTER TABLE t RENAME TO t__old", "ALTER TABLE t__new RENAME TO t", "DROP TABLE t__old"),
    ]


def test_a_failed_write_leaves_the_old_table(spark, written):
    log, fail = written
    fail.add("t__new")
    with pytest.raises(RuntimeError, match="connection lost"):
        sinks.write_jdbc(spark.range(1), DATABASE, "t", replace="swap")
    assert log == [("load", "t__new", "overwrite"), ("run", "DROP TABLE IF EXISTS t__new")]


def test_other_ways_to_replace(spark, written, monkeypatch):
    log, _ = written
    options = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: options.update(o) or self)
    sinks.write_jdbc(spark.range(1), DATABASE, "t", replace="truncate")
    assert options["truncate"] == "true" and log == [("load", "t", "overwrite")]
    sinks.write_jdbc(spark.range(1), DATABASE, "t", replace="swap", swap=["EXCHANGE TABLES {side} AND {name}"])
    assert log[-1][-1] == "EXCHANGE TABLES t__new AND t"
    with pytest.raises(ValueError):
        sinks.write_jdbc(spark.range(1), DATABASE, "t", replace="append")
