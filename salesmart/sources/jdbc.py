"""Tables of a database, read in parallel."""

from __future__ import annotations

import datetime
import math
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Key values that `text_splits` takes to the driver at most, to cut the keys at their quantiles.
SAMPLE = 100_000


@dataclass(frozen=True)
class Database:
    """Where a database is and how to log in. Nothing is hard-coded."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_environment(cls, prefix: str) -> Database:
        """From ``<prefix>_URL`` and, if set, ``<prefix>_USER``, ``_PASSWORD``, ``_DRIVER``."""
        names = {"user": "USER", "password": "PASSWORD", "driver": "DRIVER"}
        found = {key: os.environ.get(f"{prefix}_{name}") for key, name in names.items()}
        properties = {key: value for key, value in found.items() if value is not None}
        return cls(os.environ[f"{prefix}_URL"], properties)


@dataclass(frozen=True)
class Ranges:
    """Split a scan by ranges of a number, date or timestamp column, e.g. a surrogate key."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    columns: Sequence[str] = (),
    ranges: Ranges | None = None,
    predicates: Sequence[str] = (),
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, projected to ``columns`` in the database.

    With neither ``ranges`` nor ``predicates`` a single task reads everything, which only suits
    small tables. ``predicates`` are SQL conditions, one task each, that together must cover
    every row exactly once, e.g. those of `text_splits`, as all columns of staging are text.
    """
    properties = {"fetchsize": str(fetch_size), **database.properties}
    if predicates:
        rows = spark.read.jdbc(
            database.url, table, predicates=list(predicates), properties=properties
        )
    elif ranges:
        rows = spark.read.jdbc(
            database.url, table, column=ranges.column, lowerBound=ranges.lower,
            upperBound=ranges.upper, numPartitions=ranges.partitions, properties=properties,
        )
    else:
        rows = spark.read.jdbc(database.url, table, properties=properties)
    return rows.select(*columns) if columns else rows


def measured_ranges(
    spark: SparkSession, database: Database, table: str, column: str, partitions: int
) -> Ranges | None:
    """Ranges between the smallest and the largest value of a number, date or timestamp column,
    asked of the database in one query; None for a table without such a value.

    Spark puts NULLs and whatever is added meanwhile beyond the ends into the outer ranges.
    """
    query = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds"
    found = spark.read.jdbc(database.url, query, properties=database.properties).first()
    low, high = (found["low"], found["high"]) if found else (None, None)
    if low is None:
        return None
    if isinstance(low, (datetime.date, datetime.datetime)):
        return Ranges(column, str(low), str(high), partitions)
    # Bounds are whole numbers; the outer ranges are open, so rounding loses no row.
    return Ranges(column, math.floor(low), math.ceil(high) + 1, partitions)


def cut_points(values: Sequence[str], partitions: int) -> list[str]:
    """At most ``partitions - 1`` of the values, between about equally many of them.

    Only values that every database writes alike between quotes are taken.
    """
    plain = sorted({v for v in values if v and v.isascii() and v.isprintable() and not set(v) & set("'\\")})
    places = [len(plain) * i // partitions for i in range(1, partitions)]
    return sorted({plain[place] for place in places if place})


def text_predicates(column: str, cuts: Sequence[str]) -> list[str]:
    """Conditions that each row meets exactly one of: `column` lies below a cut and below none before.

    That holds for any order of text, also one that ignores case or that sorts other than
    the cuts are sorted; NULL belongs to the first condition.
    """
    if not cuts:
        return ["1 = 1"]
    from_here = [f"{column} >= '{cut}'" for cut in cuts]
    parts = [" AND ".join([*from_here[:i], f"{column} < '{cut}'"]) for i, cut in enumerate(cuts)]
    return [f"{parts[0]} OR {column} IS NULL", *parts[1:], " AND ".join(from_here)]


def key_sample(keys: DataFrame, size: int = SAMPLE) -> list[str]:
    """Distinct values of the only column of ``keys``, at most ``size``, picked by their hash."""
    column = F.col(keys.columns[0]).cast("string")
    values = keys.select(column.alias("v")).where("v IS NOT NULL").distinct()
    return [row.v for row in values.orderBy(F.xxhash64("v"), "v").limit(size).collect()]


def text_splits(
    spark: SparkSession, database: Database, table: str, column: str, partitions: int
) -> list[str]:
    """Predicates that split the scan of a table by a text column into about equal parts.

    The database is asked for the distinct values of that column alone, read by one task: a small
    part of what the scan itself reads.
    """
    query = f"(SELECT DISTINCT {column} FROM {table}) keys_of_{column}"
    keys = spark.read.jdbc(database.url, query, properties=database.properties)
    return text_predicates(column, cut_points(key_sample(keys), partitions))
