"""One repeatable row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.lookup import BROADCAST_ROWS
from salesmart.workspace import Workspace

#: Leading bytes of a text that a bigint holds in the order of the text, none of them as a sign.
HEAD_BYTES = 7

#: Words of 64 bits that are broadcast where keys are many, some 60 MB at most.
BIT_WORDS = 2**20


def _head(text: Column) -> Column:
    """The first bytes of a text as a bigint that never orders two texts otherwise than the texts; NULL first."""
    padded = F.rpad(text.cast("binary"), HEAD_BYTES, F.lit(b"\0"))
    number = F.conv(F.hex(F.substring(padded, 1, HEAD_BYTES)), 16, 10).cast("bigint")
    return F.coalesce(number, F.lit(-1))


def _near_first(
    rows: DataFrame, keys: Sequence[str], first_by: str, workspace: Workspace, hashed: bool
) -> DataFrame:
    """The rows whose ``first_by`` begins like the smallest of their key: the first row is one of them.

    The smallest beginnings are bigints, so they are found by hashing, from keys and ``first_by``
    alone, and stored. Too many keys to broadcast leave all rows or, if ``hashed``, those for which
    the bit of their key and beginning is set: besides the rows looked for some others.
    """
    head = _head(F.col(first_by))
    least = rows.groupBy(*keys).agg(F.min(head).alias("_least"))
    least = workspace.store("least", least)
    if least.count() > BROADCAST_ROWS:
        return _maybe_among(rows, [*keys, head], least, [*keys, "_least"]) if hashed else rows
    side = least.select(*[F.col(key).alias(f"_key_{i}") for i, key in enumerate(keys)], "_least")
    matches = [rows[key].eqNullSafe(side[f"_key_{i}"]) for i, key in enumerate(keys)]
    return rows.join(F.broadcast(side), [*matches, head == side["_least"]], "left_semi")


def _maybe_among(
    rows: DataFrame, values: Sequence[str | Column], others: DataFrame, theirs: Sequence[str]
) -> DataFrame:
    """The rows whose ``values`` may stand among ``theirs`` of ``others``. None that do is left out; of
    those that do not, about one in 64 * `BIT_WORDS` stays for each row of ``others``."""
    def word(mark: Column) -> Column:
        return F.pmod(F.shiftright(mark, 6), F.lit(BIT_WORDS))

    def bit(mark: Column) -> Column:
        return mark.bitwiseAND(63).cast("int")

    mark = F.xxhash64(*theirs)
    places = others.select(word(mark).alias("_word"), bit(mark).alias("_bit"))
    bits = places.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    marked = rows.withColumn("_mark", F.xxhash64(*values))
    found = marked.join(F.broadcast(bits), word(marked["_mark"]) == bits["_word"])
    return found.where(F.getbit("_bits", bit(F.col("_mark"))) == 1).select(*rows.columns)


def representative(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], first_by: str,
    few_keys: Workspace | None = None, many_keys: Workspace | None = None,
) -> DataFrame:
    """The first row of each key: smallest ``first_by``, then smallest ``columns``, nulls first.

    NULL keys form one group, as in ``dropDuplicates``. The order covers every column that is
    kept, so rows that still tie are equal and the pick does not depend on the partitioning.

    Written as an aggregate: the minimum is combined on the map side, so each task sends at most
    one row per key, however hot the key is. That aggregate sorts the rows it reads. Where keys
    are few against the rows, a workspace to work in as ``few_keys`` spares most of the sort: the
    rows, ``first_by`` being text, are first narrowed to those that can be the first of their key.
    Where they are many, a workspace as ``many_keys`` does nearly as well: by hash bits of a fixed
    size some rows remain that cannot be the first.
    """
    if few_keys or many_keys:
        rows = _near_first(rows, keys, first_by, few_keys or many_keys, hashed=not few_keys)
    rest = [name for name in columns if name not in keys]
    # Spark sorts strings by their first bytes and compares the rest only on a tie. Keys of
    # several columns tend to share those bytes; their hash does not.
    grouping = [F.xxhash64(*keys).alias("_hash"), *keys] if len(keys) > 1 else list(keys)
    first = F.min(F.struct(first_by, *rest)).alias("_first")
    kept = [F.col(name) if name in keys else F.col(f"_first.{name}") for name in columns]
    return rows.groupBy(*grouping).agg(first).select(*kept)
