"""Dense surrogate keys 1..n without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.workspace import Workspace

#: Leading hex digits of the key's md5 that name its bucket: 16**3 = 4,096 buckets at most.
BUCKET_DIGITS = 3


def dense_id(
    rows: DataFrame, keys: Sequence[str], name: str, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add a bigint ``name`` = rank of the row by md5 of its key text, then by the key itself.

    ``keys`` must be unique and text. ``rows`` is read twice, so it should be a stored table.
    The id depends on the data alone: neither on the
    partitioning nor on ``bucket_digits``, which only sets how finely the ranking is split.
    Rows are ranked inside buckets that share a hash prefix, all buckets being about equally
    large, and each bucket is shifted by the number of rows in the buckets before it.
    The shifts are at most ``16 ** bucket_digits`` rows, a fixed bound, hence the broadcast.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    hashed = rows.withColumn("_hash", F.md5(F.concat_ws("|", *keys)))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, bucket_digits))

    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *order))
    return (
        hashed.withColumn("_rank", rank)
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(name, F.col("_shift") + F.col("_rank"))
        .select(*rows.columns, name)
    )


def position_id(stored: DataFrame, name: str) -> DataFrame:
    """Add a bigint ``name`` = position of the row in a stored parquet table, 1..n.

    For tables too large to rank: files are numbered by the hash of their name and rows by their place in the
    file, so nothing is shuffled but one count per file. The table must have been written
    before, which also freezes the result: reading it again gives the same ids.
    What is broadcast is a hash and a shift per file, 16 bytes: files hold up to a million rows
    each (`Workspace.store`), so a fact of 10**12 rows sends 16 MB. The plan is the same at any
    size, and no row of the fact is shuffled.
    """
    file = F.xxhash64(F.col("_metadata.file_path"))
    placed = stored.select(
        "*",
        file.alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stored.groupBy(file.alias("_file"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    # A left join, although every file has a shift: Spark leaves it out where the id is not used.
    return placed.join(F.broadcast(shifts), "_file", "left").select(
        (F.col("_shift") + F.col("_row") + 1).alias(name), *stored.columns
    )


def ranked_id(rows: DataFrame, keys: Sequence[str], name: str, workspace: Workspace) -> DataFrame:
    """Add a bigint ``name`` = rank of the row by its natural key, NULL first.

    ``keys`` must be unique. Rows are dealt by ranges of the key and sorted in their range, so a
    row's place is the number of rows in the ranges before plus its place in its own. Both are
    stored with the rows, which is the only shuffle; then only a count per range is summed up.
    The ids are those of a ``row_number`` over all rows, without their global sort in one task.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    # Bits from 33 on of this id count the range, those below the row in it; the sort is stored.
    place = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = workspace.store(f"ranked_{name}", sorted_rows.select("*", place.alias("_place")))
    part = F.shiftright("_place", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        stored.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )  # a row per range, of which there are at most `spark.sql.shuffle.partitions`
    within = F.col("_place").bitwiseAND(2**33 - 1) + 1
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .select(*rows.columns, (F.col("_shift") + within).alias(name))
    )
