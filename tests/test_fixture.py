"""Staging made from the test tables, in slices."""

import time
from collections import Counter

import pytest

from salesmart import fixture


@pytest.fixture
def folder(spark, tmp_path):
    tables = {
        "region": "SELECT 0 r_regionkey, 'ASIA' r_name",
        "nation": "SELECT int(id) n_nationkey, 'N' || id n_name, 0 n_regionkey FROM range(3)",
        "customer": "SELECT id c_custkey, 'C' || id c_name, int(id % 3) c_nationkey, 1D c_acctbal, 'M' c_mktsegment"
                    " FROM range(20)",
        "supplier": "SELECT id s_suppkey, 'S' || id s_name, int(id % 3) s_nationkey, 1D s_acctbal FROM range(5)",
        "part": "SELECT id p_partkey, 'P' || id p_name, 'B' p_brand, 'T' p_type, int(id) p_size, 9.5D p_retailprice"
                " FROM range(10)",
        # an order that comes twice, and one without a key
        "orders": "SELECT if(id = 60, 7, if(id = 61, null, id)) o_orderkey, id % 20 o_custkey, 'O' o_orderstatus,"
                  " 1D o_totalprice, timestamp'2020-01-01' o_orderdate, '1-URGENT' o_orderpriority FROM range(62)",
        "lineitem": "SELECT if(id = 200, null, id % 70) l_orderkey, id % 10 l_partkey, id % 5 l_suppkey,"
                    " int(id) l_linenumber, 2D l_quantity, 19D l_extendedprice, 0D l_discount, 0D l_tax,"
                    " 'R' l_returnflag, 'F' l_linestatus, timestamp'2021-03-05' l_shipdate FROM range(201)",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().mkString(" ").split()
    return {file for file in files if "/shuffle_" in file}


def test_slices_of_staging_are_the_whole(spark, folder, workspace, monkeypatch):
    whole = fixture.store_staging(spark, folder, workspace.child("whole"))
    expected = Counter(map(tuple, whole.collect()))
    assert sum(expected.values()) == 180 + 3  # three line items of the order that comes twice
    monkeypatch.setattr(fixture, "SLICE_ROWS", 50)
    monkeypatch.setattr(fixture, "staging", calls := Calls(fixture.staging))
    for _ in range(2):  # again: the first slice replaces what was there
        sliced = fixture.store_staging(spark, folder, workspace.child("sliced"))
        assert Counter(map(tuple, sliced.collect())) == expected
    assert [number for _, _, slices, number in calls.seen] == [0, 1, 2, 3, 4] * 2
    parts = [Counter(map(tuple, fixture.staging(spark, folder, 5, i).collect())) for i in range(5)]
    assert all(part and part != expected for part in parts)


class Calls:
    def __init__(self, function):
        self.function, self.seen = function, []

    def __call__(self, *values):
        self.seen.append(values)
        return self.function(*values)


def test_staging_leaves_no_shuffle_files(spark, folder, workspace, monkeypatch):
    monkeypatch.setattr(fixture, "SLICE_ROWS", 50)
    before, setting = shuffle_files(spark), spark.conf.get(SETTING, "false")
    rows = fixture.store_staging(spark, folder, workspace)
    for _ in range(50):  # Spark deletes them a little later
        if left := shuffle_files(spark) - before:
            time.sleep(0.1)
    assert not left
    assert spark.conf.get(SETTING) == setting
    assert rows.count() == 183 and all(".zstd." in file for file in rows.inputFiles())


SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
