"""Natural key -> surrogate key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key and an id that every executor can hold, some 50 MB.
BROADCAST_ROWS = 500_000


def attach_key(
    rows: DataFrame, lookup: DataFrame, on: Mapping[str, str], id_column: str, how: str, name: str,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Replace the natural-key columns of ``rows`` by the matching ``id_column`` of ``lookup``.

    ``on`` maps columns of ``rows`` to columns of ``lookup``, whose values are unique. A NULL in
    any part never matches: ``how="inner"`` drops such a row, ``how="left"`` keeps it with a
    NULL id. The natural-key text is dropped here, so a later shuffle carries only the id.

    No broadcast is forced but of up to ``broadcast_rows``, counted from the files' footers.
    ``lookup`` should be a stored table: its size on disk is then known when the join is planned,
    and Spark broadcasts a larger one only below
    ``spark.sql.autoBroadcastJoinThreshold``. Above that it is a sort-merge join, in which
    adaptive execution splits the partitions of hot keys and of NULL keys.
    """
    side = lookup.select(
        *[F.col(theirs).alias(f"_key_{i}") for i, theirs in enumerate(on.values())],
        F.col(id_column).alias(name),
    )
    if broadcast_rows and lookup.count() <= broadcast_rows:
        side = F.broadcast(side)
    matches = [rows[ours] == side[f"_key_{i}"] for i, ours in enumerate(on)]
    kept = [column for column in rows.columns if column not in on]
    return rows.join(side, matches, how).select(*kept, name)
