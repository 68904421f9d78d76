"""The sales extract as CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import STAGING, STAGING_COLUMNS

# What the reader takes for an absent value, so that "" can be told from it.
_ABSENT = "\u0001absent\u0001"


def read_staging_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    multi_line: bool = True,
    with_source: bool = False,
) -> DataFrame:
    """All files as one bag of text rows; columns go by position and the header is skipped.

    An unquoted empty field is NULL and ``""`` is the empty string. Quotes inside quotes are
    doubled. A row with too few or too many fields fails the read. ``multi_line`` allows line
    breaks inside quotes, at the price of one task per file: turn it off for large files that
    have none. ``with_source`` adds the (URL-encoded) file name as ``_source``.
    """
    rows = spark.read.csv(
        paths if isinstance(paths, str) else list(paths),
        schema=STAGING,
        header=True,
        sep=delimiter,
        quote='"',
        escape='"',
        multiLine=multi_line,
        nullValue=_ABSENT,
        emptyValue="",
        mode="FAILFAST",
    )
    columns = [F.col(name) for name in STAGING_COLUMNS]
    if with_source:
        columns.append(F.col("_metadata.file_name").alias("_source"))
    return rows.select(*columns)
