"""Where tables go. Every writer replaces what was there, so a job can be run again."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import ddl
from salesmart.sources.jdbc import Database
from salesmart.workspace import CONCURRENT_WRITES

Writer = Callable[[str, DataFrame], None]

#: Statements by which a side table takes over a name. Other databases have their own, e.g.
#: ``EXCHANGE TABLES {side} AND {name}``.
SWAP = (
    "ALTER TABLE {name} RENAME TO {old}",
    "ALTER TABLE {side} RENAME TO {name}",
    "DROP TABLE {old}",
)
DROP = "DROP TABLE IF EXISTS {table}"
#: So that the swap finds a table under the name at the first run too.
CREATE_LIKE = "CREATE TABLE IF NOT EXISTS {name} AS SELECT * FROM {side} WHERE 1 = 0"


def write_parquet(table: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One folder per value of ``partition_by``. Its rows meet before the write, so that not every
    task writes a file to every folder; adaptive execution splits a large folder's share."""
    if partition_by:
        table = table.hint("rebalance", *map(F.col, partition_by))
    table.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


#: Level of gzip and deflate: half the CPU time of the default, six, for files a tenth larger.
ZLIB_LEVEL = "FOUR"


def write_csv(
    table: DataFrame, path: str, delimiter: str = ",", compression: str = "none"
) -> None:
    """CSV that `read_staging_csv` reads back unchanged: NULL is nothing, '' is ``""``."""
    table.write.mode("overwrite").option("zlib.compress.level", ZLIB_LEVEL).csv(
        path, header=True, sep=delimiter, quote='"', escape='"', nullValue="", emptyValue='""',
        compression=compression,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_typed_table(
    table: DataFrame, name: str, columns: Sequence[tuple[str, str]], location: str | None = None
) -> None:
    """Catalog table with declared types. A value that exceeds its varchar limit or decimal
    precision fails the write.

    The rows go to a new table, in a folder of its own under ``location``, that takes over the
    name once all are written: after a failed write the old table is still there. Files of an
    old table with a location stay until they are removed by hand.
    """
    spark = table.sparkSession
    unique = uuid.uuid4().hex
    fresh = f"{name}_{unique}"
    where = f" LOCATION '{location.rstrip('/')}/{unique}'" if location else ""
    spark.sql(f"CREATE TABLE {fresh} ({ddl(list(columns))}) USING parquet{where}")
    try:
        table.select(*[column for column, _ in columns]).write.insertInto(fresh)
    except Exception:
        spark.sql(f"DROP TABLE {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def write_jdbc(
    table: DataFrame,
    database: Database,
    name: str,
    connections: int = 8,
    batch_size: int = 10_000,
    create_table_options: str | None = None,
    replace: str = "drop",
    swap: Sequence[str] = SWAP,
) -> None:
    """Database table, written over at most ``connections`` connections.

    ``create_table_options`` is appended to ``CREATE TABLE``, e.g. a table engine. ``replace`` says
    what becomes of an old table: with "drop" it is dropped first and created anew; with
    "truncate" it is emptied first and keeps its definition; with "swap" the rows go to a side
    table, which takes over the name by the statements ``swap`` once all rows are there, so after a
    failed write the old table is untouched.
    """
    if replace not in ("drop", "truncate", "swap"):
        raise ValueError(f"no way to replace a table: {replace}")
    options = {"batchsize": str(batch_size), "numPartitions": str(connections)}
    if create_table_options:
        options["createTableOptions"] = create_table_options
    if replace == "truncate":
        options["truncate"] = "true"

    def load(into: str) -> None:
        table.write.options(**options).jdbc(
            database.url, into, mode="overwrite", properties=database.properties
        )

    if replace != "swap":
        return load(name)
    names = {"name": name, "side": f"{name}__new", "old": f"{name}__old"}
    spark = table.sparkSession
    try:
        load(names["side"])
    except Exception:
        execute(spark, database, [DROP.format(table=names["side"])])
        raise
    # What an earlier run may have left goes first; then all in one transaction, if there is one.
    execute(spark, database, [DROP.format(table=names["old"])])
    execute(spark, database, [CREATE_LIKE.format(**names), *(s.format(**names) for s in swap)])


def execute(spark: SparkSession, database: Database, statements: Sequence[str]) -> None:
    """Run statements in one transaction over a connection of the driver."""
    if "driver" in database.properties:
        spark._jvm.org.apache.spark.util.Utils.classForName(database.properties["driver"], True, True)
    properties = spark._jvm.java.util.Properties()
    for key, value in database.properties.items():
        properties.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(database.url, properties)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            try:
                statement.execute(text)
            finally:
                statement.close()
        connection.commit()
    finally:
        connection.close()  # rolls back what is not committed


def to_folder(folder: str) -> Writer:
    return lambda name, table: write_parquet(table, f"{folder}/{name}")


def to_database(database: Database, prefix: str = "", **options) -> Writer:
    return lambda name, table: write_jdbc(table, database, prefix + name, **options)


def save_all(tables: Mapping[str, DataFrame], write: Writer) -> dict[str, int]:
    """Write each table and return its number of rows, counted while it is written."""

    def save(item: tuple[str, DataFrame]) -> int:
        name, table = item
        seen = Observation(f"rows of {name}")
        write(name, table.observe(seen, F.count(F.lit(1)).alias("rows")))
        return seen.get["rows"]

    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        return dict(zip(tables, pool.map(save, tables.items())))
