"""Checks on the built tables: sizes, keys, declared limits, and what was dropped on the way."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import broken_rules
from salesmart.operators import BROADCAST_ROWS
from salesmart.plans import snowflake, star

Tables = Mapping[str, DataFrame]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: Tables) -> DataFrame:
    """(table, n). On stored parquet this reads footers only."""
    return _union(
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        for name, table in tables.items()
    )


def _id_words(ids: DataFrame) -> DataFrame:
    """(word, bits): the ids of the column ``id`` in words of 64 neighbours, a bit for each. Dense ids
    take a row per 64 of them, others at most a row each."""
    places = ids.where(F.col("id").isNotNull()).select(
        F.shiftright("id", 6).alias("word"), F.col("id").bitwiseAND(63).cast("int").alias("place")
    )
    return places.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))


def _few_words(ids: DataFrame) -> DataFrame | None:
    """Their `_id_words` if these are at most `BROADCAST_ROWS`."""
    words = _id_words(ids)
    few = ids.count() <= BROADCAST_ROWS or words.count() <= BROADCAST_ROWS
    return words if few else None


def _orphans_by_words(child: DataFrame, links: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """(edge, n) for links of edge -> (column, `_id_words` of the parent), which are broadcast: one scan
    of the child, of which no row is moved."""
    rows = child.select(*[
        F.col(column).cast("bigint").alias(f"key_{i}") for i, (column, _) in enumerate(links.values())
    ])
    orphans = []
    for i, (_, words) in enumerate(links.values()):
        side = words.select(F.col("word").alias(f"word_{i}"), F.col("bits").alias(f"bits_{i}"))
        key, bits = F.col(f"key_{i}"), F.col(f"bits_{i}")
        rows = rows.join(F.broadcast(side), F.shiftright(key, 6) == F.col(f"word_{i}"), "left")
        known = F.getbit(bits, key.bitwiseAND(63).cast("int")) == 1
        orphans.append(F.count_if(key.isNotNull() & ~F.coalesce(known, F.lit(False))).alias(f"n_{i}"))
    counts = F.array(*[
        F.struct(F.lit(edge).alias("edge"), F.col(f"n_{i}").alias("n")) for i, edge in enumerate(links)
    ])
    return rows.agg(*orphans).select(F.inline(counts))


def _orphans_by_pairs(child: DataFrame, links: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """(edge, n) for links of edge -> (column, ids of the parent): one scan of the child, whose keys
    become (edge, key) pairs. They are reduced to one row per pair before the join, so neither
    the size of a fact nor a hot key reaches it."""
    pairs = F.inline(F.array(*[
        F.struct(F.lit(edge).alias("edge"), F.col(column).cast("bigint").alias("key"))
        for edge, (column, _) in links.items()
    ]))
    used = child.select(pairs).groupBy("edge", "key").agg(F.count("key").alias("rows"))
    known = _union(
        ids.select(F.lit(edge).alias("edge"), F.col("id").alias("key"), F.lit(True).alias("known"))
        for edge, (_, ids) in links.items()
    )
    orphans = F.when(F.col("known").isNull(), F.col("rows")).otherwise(0)
    found = used.join(known, ["edge", "key"], "left").groupBy("edge").agg(F.sum(orphans).alias("n"))
    # An edge of an empty child has no rows; it still is in the report.
    every = child.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, links))).alias("edge"))
    return every.join(F.broadcast(found), "edge", "left").select(
        "edge", F.coalesce("n", F.lit(0)).alias("n")
    )


def fk_violations(
    tables: Tables, edges: Iterable[tuple[str, str, str]], keys: Mapping[str, str]
) -> DataFrame:
    """(edge, n): rows whose non-null foreign key has no parent.

    A parent's ids are broadcast as words of 64 neighbours, so a child is scanned once for all its
    edges and its rows stay where they are. Only the edges to parents of more than
    `BROADCAST_ROWS` words are joined, in another scan of the child.
    """
    by_child: dict[str, list[tuple[str, str]]] = {}
    for child, column, parent in edges:
        by_child.setdefault(child, []).append((column, parent))
    ids = {
        parent: tables[parent].select(F.col(keys[parent]).cast("bigint").alias("id"))
        for links in by_child.values() for _, parent in links
    }
    words = {parent: _few_words(rows) for parent, rows in ids.items()}
    parts = []
    for child, links in by_child.items():
        few = {f"{child}.{c}": (c, words[p]) for c, p in links if words[p] is not None}
        many = {f"{child}.{c}": (c, ids[p]) for c, p in links if words[p] is None}
        if few:
            parts.append(_orphans_by_words(tables[child], few))
        if many:
            parts.append(_orphans_by_pairs(tables[child], many))
    return _union(parts)


def pk_violations(tables: Tables, keys: Mapping[str, str]) -> DataFrame:
    """(table, surplus_ids, null_ids): rows that repeat an id, rows without one.

    Distinct ids are counted in bitmaps of 32,768 neighbours: for dense ids that shuffles
    about one bit per row instead of one row per row.
    """
    parts = []
    for name, key in keys.items():
        bitmaps = (
            tables[name]
            .groupBy(F.bitmap_bucket_number(key).alias("bucket"))
            .agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"),
                F.count(F.lit(1)).alias("rows"),
                F.count(key).alias("ids"),
            )
        )
        distinct = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))
        parts.append(
            bitmaps.agg(
                F.coalesce(F.sum("ids") - F.sum(distinct), F.lit(0)).alias("surplus_ids"),
                F.coalesce(F.sum(F.col("rows") - F.col("ids")), F.lit(0)).alias("null_ids"),
            ).select(F.lit(name).alias("table"), "surplus_ids", "null_ids")
        )
    return _union(parts)


def length_violations(
    tables: Tables, layouts: Mapping[str, list[tuple[str, str]]]
) -> DataFrame:
    """(table, column, max_length, n): values longer than their varchar, one scan per table."""
    parts = []
    for name, columns in layouts.items():
        limits = {c: int(t[8:-1]) for c, t in columns if t.startswith("varchar(")}
        if not limits:
            continue
        longer = [F.count_if(F.length(c) > limit).alias(c) for c, limit in limits.items()]
        counts = F.array(*[
            F.struct(
                F.lit(c).alias("column"), F.lit(limit).alias("max_length"), F.col(c).alias("n")
            )
            for c, limit in limits.items()
        ])
        parts.append(
            tables[name].agg(*longer)
            .select(F.inline(counts)).select(F.lit(name).alias("table"), "*")
        )
    return _union(parts)


def _rejects(linked: DataFrame, ids: Mapping[str, str], kept: tuple[str, ...]) -> DataFrame:
    missing = broken_rules({f"no_{name}": F.col(column).isNull() for name, column in ids.items()})
    return linked.select(
        *[F.col(f"_{name}").alias(name) for name in kept],
        F.explode(F.concat(missing, "broken")).alias("rule"),
    )


def snowflake_rejects(linked: DataFrame, kept: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per staging row and broken rule.

    ``no_<dimension>`` is why the row is not in the fact; ``bad_<column>`` is a text that was
    turned into NULL. ``linked`` is the result of `snowflake.linked`; its ``kept`` columns
    identify the staging row, e.g. ``id`` and ``_source``.
    """
    ids = {t.removeprefix("dim_"): snowflake.foreign_key(t) for t in snowflake.FACT_LINKS}
    return _rejects(linked, ids, kept)


def star_rejects(linked: DataFrame, kept: tuple[str, ...] = ("id",)) -> DataFrame:
    """Like `snowflake_rejects`, of the result of `star.linked`; here ``no_<dimension>`` is a
    NULL id in a row that was kept."""
    ids = {spec.id.removesuffix("_id"): spec.id for spec in star.DIMENSIONS.values()}
    return _rejects(linked, ids, kept)


def reject_counts(rejects: Mapping[str, DataFrame]) -> DataFrame:
    """(profile, rule, n)."""
    return _union(
        rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(profile).alias("profile"), "rule", "n")
        for profile, rows in rejects.items()
    )
