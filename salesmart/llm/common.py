"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: the six ASCII characters that are not in ``[^\x20\x09-\x0D]``.
GAP = r"[\x20\x09-\x0D]+"


def or_empty(text: Column) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, unchanged and in order; NULL has none."""
    return F.array_remove(F.split(or_empty(text), GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    """64-bit hash of each word of a text."""
    return F.transform(words_of(text), lambda word: F.xxhash64(word))


def row_key(*columns: str) -> list[Column]:
    """Two hashes, 128 bits together, that stand for a row. Never NULL, so they can be joined on.

    Rows that are equal in ``columns`` share the key and are treated alike.
    """
    return [
        F.xxhash64(*columns).alias("_key"),
        F.xxhash64(F.lit("second"), *columns).alias("_key2"),
    ]


def with_columns(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that an operator works on, missing ones as NULL, and no others."""
    found = {name.lower(): name for name in rows.columns}
    return rows.select(*[
        (rows[found[name]] if name in found else F.lit(None)).cast(kind).alias(name)
        for name, kind in names.items()
    ])


def by_weight(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the lists (or texts) in ``column`` hold about ``most`` items a piece.

    Bounds the memory of a task, whatever the length of the rows: a row longer than ``most``
    comes alone.
    """
    for batch in batches:
        lengths = _lengths(batch.column(column))
        start, filled = 0, 0
        for row, length in enumerate(lengths.tolist()):
            if filled and filled + length > most:
                yield batch.slice(start, row - start)
                start, filled = row, 0
            filled += length
        if start < batch.num_rows:
            yield batch.slice(start)


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    size = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return pc.fill_null(size(column), 0).to_numpy(zero_copy_only=False)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column of numbers, and the offsets of its rows (a NULL row is empty)."""
    offsets = np.concatenate([[0], np.cumsum(_lengths(column))]).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists numbered ``rows``, one after the other, and where each begins."""
    sizes = (offsets[1:] - offsets[:-1])[rows]
    ends = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    places = np.repeat(offsets[rows] - ends[:-1], sizes)
    places += np.arange(ends[-1])
    return values[places], ends


def quoted(name: str) -> str:
    """The name of a column for Spark, also where it has dots or ticks in it."""
    return "`" + name.replace("`", "``") + "`"


def apart(
    docs: DataFrame, used: Sequence[str], work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``work`` done on rows with the ``used`` columns of ``docs``, which it may change, and its other
    columns in a struct ``others``, which it must keep.

    So no column of the caller has the name of a column that ``work`` makes on its way. Columns
    that ``work`` adds come last; a column of the caller with the name of one gives way to it.
    """
    own = [name for name in docs.columns if name.lower() in used]
    others = [name for name in docs.columns if name not in own]
    rows = docs.select(
        *map(quoted, own), F.struct(F.lit(0).alias("_"), *map(quoted, others)).alias("others"))
    result = work(rows)
    new = [name for name in result.columns if name not in rows.columns]
    given = {name.lower() for name in new}
    return result.select(
        *[F.col(quoted(name) if name in own else f"others.{quoted(name)}").alias(name)
          for name in docs.columns if name.lower() not in given],
        *map(quoted, new),
    )


def mix64(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers one to one (the finalizer of splitmix64)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def let_workers_import(spark) -> None:
    """Put this checkout on the path of the Python workers, as ``--py-files`` does on a cluster.

    Does nothing harmful where the package is installed: a missing folder is skipped.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


#: Values that `maybe_among` broadcasts at most: 16 MB, whatever the tables.
HASH_BUCKETS = 2**20


def maybe_among(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` may be among ``keys``; with ``left_anti`` those whose is surely not.

    What is broadcast are bucket numbers of hashed keys, so it has a fixed bound. The answer is
    inexact: it saves a shuffle of the rows that surely have no partner, and an exact join of the
    others has to follow.
    """
    bucket = F.pmod(F.col(key), F.lit(HASH_BUCKETS)).cast("int").alias("_bucket")
    found = F.broadcast(keys.select(bucket).distinct())
    return rows.withColumn("_bucket", bucket).join(found, "_bucket", how).drop("_bucket")
