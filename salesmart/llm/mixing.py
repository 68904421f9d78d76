"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Every source is a stream: its documents in hashed order, as often over as its target needs, cut
into blocks of `BLOCK` words. Slots 0, 1, 2, ... of the mix carry the points of the golden-ratio
sequence, which are mapped through the cumulative weights to sources; the n-th slot of a source
takes the n-th block of its stream. Any stretch of the schedule is thereby close to the weights,
and each source gives exactly as many words as its target, rounded down.

Only counts move, never texts. Ranks and positions are sums over hashed buckets and chunks of
slots, so no task orders a whole source, however large.

Defined results: a NULL text has 0 words; a NULL source is a source of its own, last in order;
rows that are equal in doc_id, source and text are interchangeable; an empty table gives an empty
mix. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import apart, row_key, with_columns, words_of
from salesmart.workspace import Workspace

#: Words in a block, the last block of a source may be shorter.
BLOCK = 1024

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)

#: A source gives at most this many times its own words.
MOST_REPEATS = 3

#: Bits of the hash that name a bucket of a source's stream: at most 4,096 rows per source.
BUCKET_BITS = 12

#: Slots that are ranked together.
CHUNK = 65_536

# 2**32 over the golden ratio; the points repeat after 2**31 slots, and products
# stay below 2**63.
GOLDEN, PERIOD, TURN = 2_654_435_769, 2**31, 2**32

#: Cells of the unit interval by which slots meet the sources.
CELLS = 65_536

DOCUMENT = {"doc_id": "bigint", "text": "string", "source": "string"}


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key columns) per document."""
    return with_columns(docs, DOCUMENT).select(
        "doc_id", "source", F.size(words_of(F.col("text"))).cast("bigint").alias("size"),
        *row_key("doc_id", "source", "text"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_no, source_size, target) per source, numbered in code-point order.

    The weights share the words of all sources. A source whose share exceeds ``most`` times its
    words gets just that, and the excess is shared again by weight. Sources in the order of
    ``limit / weight`` are limited from the front, so one pass over them finds the final share.
    One row per source, so a single task ranks them.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(weight)) for weight in weights])
    rows = per_source.withColumn("source_no", number).withColumn(
        "_weight", F.get(table, F.pmod("source_no", F.lit(len(weights))))
    ).withColumn("_limit", most * F.col("source_size"))

    order = Window.orderBy(F.col("_limit") / F.col("_weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    share = left / F.sum("_weight").over(onward)
    rows = rows.withColumn("_share", share)
    rows = rows.withColumn("_limited", F.col("_share") * F.col("_weight") >= F.col("_limit"))
    final = F.first(F.when(~F.col("_limited"), F.col("_share")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("_limited"), F.col("_limit").cast("double")).otherwise(
        F.least(final * F.col("_weight"), F.col("_limit").cast("double"))
    )
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def _numbered(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])


def streams(sizes: DataFrame) -> DataFrame:
    """Add ``begin``: words of the source before the document, in hashed order.

    ``sizes`` has source_no. Documents are summed inside hashed buckets of their source, and
    buckets are shifted by the words of those before.
    """
    placed = sizes.withColumn("_order", F.xxhash64(F.lit("mix"), "_key", "_key2")).withColumn(
        "_bucket", F.shiftrightunsigned("_order", 64 - BUCKET_BITS)
    )
    by_bucket = Window.partitionBy("source_no").orderBy("_bucket")
    shifts = placed.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_words")).select(
        "source_no", "_bucket",
        F.coalesce(
            F.sum("_words").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_shift"),
    )
    inside = Window.partitionBy("source_no", "_bucket").orderBy("_order", "_key", "_key2")
    earlier = F.coalesce(
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        placed.withColumn("_earlier", earlier)
        .join(shifts, ["source_no", "_bucket"])
        .withColumn("begin", F.col("_shift") + F.col("_earlier"))
        .drop("_order", "_bucket", "_earlier", "_shift")
    )


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source_no, block_no, words): which block each slot of the mix takes, in order.

    Points of the sequence may miss a source by a few slots; its last blocks then follow in
    slots after all others, and slots of a source beyond its target are left out.
    """
    spark = sources.sparkSession
    quota = F.floor("target").cast("bigint")
    wanted = sources.select(
        "source_no", quota.alias("quota"),
        F.ceil(quota / F.lit(block)).cast("bigint").alias("blocks"), "target",
    )
    slots = wanted.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]

    sums = Window.orderBy("source_no")
    total = F.sum("target").over(Window.partitionBy())
    high = F.try_divide(F.sum("target").over(sums), total)
    low = F.try_divide(F.coalesce(
        F.sum("target").over(sums.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    ), total)
    spans = wanted.where("target > 0").select("source_no", low.alias("_low"), high.alias("_high"))
    cells = spans.withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("_low") * CELLS).cast("bigint"),
        F.least(F.floor(F.col("_high") * CELLS).cast("bigint"), F.lit(CELLS - 1)),
    )))
    point = F.pmod(F.pmod("id", F.lit(PERIOD)) * GOLDEN, F.lit(TURN)) / F.lit(float(TURN))
    points = spark.range(slots).withColumn("_point", point).withColumn(
        "_cell", F.floor(F.col("_point") * CELLS).cast("bigint")
    )
    drawn = points.join(cells, "_cell").where(
        (F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high"))
    ).select("id", "source_no", F.floor(F.col("id") / CHUNK).alias("_chunk"))

    by_chunk = Window.partitionBy("source_no").orderBy("_chunk")
    shifts = drawn.groupBy("source_no", "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        "source_no", "_chunk", "_n",
        F.coalesce(
            F.sum("_n").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_shift"),
    )
    inside = Window.partitionBy("source_no", "_chunk").orderBy("id")
    ranked = drawn.withColumn("_rank", F.row_number().over(inside) - 1).join(
        shifts, ["source_no", "_chunk"]
    ).select("id", "source_no", (F.col("_shift") + F.col("_rank")).alias("block_no"))

    given = shifts.groupBy("source_no").agg(F.sum("_n").alias("_given"))
    missing = wanted.join(given, "source_no", "left").withColumn(
        "_given", F.coalesce("_given", F.lit(0))
    ).where("_given < blocks").select(
        "source_no", F.explode(F.expr("sequence(_given, blocks - 1)")).alias("block_no")
    ).select(
        (F.lit(slots) + F.xxhash64("source_no", "block_no") % 2**20 + 2**20).alias("id"),
        "source_no", "block_no",
    )
    words = F.least(F.lit(block), F.col("quota") - F.col("block_no") * block)
    return ranked.unionByName(missing).join(wanted, "source_no").where("block_no < blocks").select(
        F.col("id").alias("slot"), "source_no", "block_no", words.cast("bigint").alias("words")
    )


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source_no, begin, block_no, place, first, words): the parts of each document that lie in
    each block. ``place`` counts the words of the stream before the part, ``first`` the document's.

    A source's stream repeats until its target is filled, at most `MOST_REPEATS` times.
    """
    quota = F.floor("target").cast("bigint")
    # A source without words has no quota; its documents are left out, in whatever order.
    rounds = F.ceil(F.try_divide(quota, F.col("source_size"))).cast("int")
    over = placed.where("size > 0 AND target >= 1").withColumn(
        "_round", F.explode(F.sequence(F.lit(0), rounds - 1))
    ).withColumn("_from", F.col("_round") * F.col("source_size") + F.col("begin"))
    over = over.withColumn("_to", F.least(F.col("_from") + F.col("size"), quota))
    over = over.where("_from < _to").withColumn("block_no", F.explode(F.sequence(
        F.floor(F.col("_from") / block).cast("bigint"),
        F.floor((F.col("_to") - 1) / block).cast("bigint"),
    )))
    inside = F.least("_to", (F.col("block_no") + 1) * block) - F.greatest(
        "_from", F.col("block_no") * block
    )
    place = F.greatest("_from", F.col("block_no") * block)
    return over.select(
        "source_no", "begin", "block_no", place.cast("bigint").alias("place"),
        (place - F.col("_from")).cast("bigint").alias("first"),
        inside.cast("bigint").alias("words"),
    )


def sequence(placed: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: (slot, place, doc_id, source, first, words), and the document's source_no and begin.

    In the order of ``slot``, source_no (slots after all others may be shared) and ``place``, the
    place of the part in its source's stream, it gives ``words`` words of the document from its
    word number ``first`` on.
    """
    parts = pieces(placed, block).join(
        schedule(sources, block).select("slot", "source_no", "block_no"), ["source_no", "block_no"]
    )
    documents = placed.where("size > 0").select("source_no", "begin", "doc_id", "source")
    return parts.join(documents, ["source_no", "begin"]).select(
        "slot", "place", "doc_id", "source", "first", "words", "source_no", "begin"
    )


def mixed(docs: DataFrame, workspace: Workspace, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words in the mix), the
    first and last slot of the schedule that holds some of it (NULL: none), n_parts (its parts in
    slots) and key columns."""
    sizes = workspace.store("sizes", sized(docs))
    sources = workspace.store("sources", targets(sizes))
    placed = workspace.store("placed", streams(_numbered(sizes, sources)))
    taken = sequence(placed, sources, block).groupBy("source_no", "begin").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"), F.count(F.lit(1)).alias("n_parts"),
    )
    # Documents without words share their place with the next one, and take nothing.
    at = F.when(F.col("size") > 0, F.col("begin"))
    return placed.withColumn("_at", at).join(
        taken.withColumnRenamed("begin", "_at"), ["source_no", "_at"], "left"
    ).select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot", "last_slot",
        F.coalesce("n_parts", F.lit(0)).alias("n_parts"), "_key", "_key2",
    )


def in_order(docs: DataFrame, workspace: Workspace, block: int = BLOCK) -> DataFrame:
    """The mix itself, as `sequence` gives it: rows that sort by slot, source_no and place."""
    sizes = workspace.store("sizes", sized(docs))
    sources = workspace.store("sources", targets(sizes))
    placed = workspace.store("placed", streams(_numbered(sizes, sources)))
    return sequence(placed, sources, block)


def repeated(
    docs: DataFrame, workspace: Workspace, block: int = BLOCK, length: str | None = None
) -> DataFrame:
    """The mix as documents: a row for each time that the schedule takes a row of ``docs``, sorted by
    the slot in which it begins.

    A source's stream ends where its target is filled, so one document of a source may be taken in
    part: its text is then the words taken, joined by spaces, and the column ``length``, if given,
    their length. Together the texts hold exactly the words that `mixed` says. Documents without
    words are not in the mix.
    """
    sizes = workspace.store("sizes", sized(docs))
    sources = workspace.store("sources", targets(sizes))
    placed = workspace.store("placed", streams(_numbered(sizes, sources)))
    # One row per time: parts of one round through the stream.
    begins = placed.where("size > 0").select("source_no", "begin", "size", "source_size", "_key", "_key2")
    turn = F.floor((F.col("place") - F.col("begin")) / F.col("source_size"))
    times = sequence(placed, sources, block).join(begins, ["source_no", "begin"]).groupBy(
        "_key", "_key2", "source_no", "begin", turn.alias("turn")
    ).agg(F.min("slot").alias("slot"), F.sum("words").alias("words"), F.first("size").alias("size"))
    # Rows that are equal in doc_id, source and text share a key: each gets the times of one place.
    copy = Window.partitionBy("_key", "_key2")
    times = times.withColumn("copy", F.dense_rank().over(copy.orderBy("begin"))).select(
        "_key", "_key2", "copy", "slot", "source_no", "words", "size")

    def chosen(docs: DataFrame) -> DataFrame:
        rows = docs.withColumns(_keys(docs))
        rows = rows.withColumn("copy", F.row_number().over(copy.orderBy(F.lit(0))))
        taken = rows.join(times, ["_key", "_key2", "copy"])
        cut = F.array_join(F.slice(words_of(F.col("text")), 1, F.col("words").cast("int")), " ")
        text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text"))
        whole = taken.withColumn("text", text).withColumn("_cut", F.col("words") < F.col("size"))
        if length:
            new = F.length("text").cast(docs.schema[length].dataType)
            whole = whole.withColumn(length, F.when(F.col("_cut"), new).otherwise(F.col(length)))
        whole = whole.repartitionByRange("slot", "source_no").sortWithinPartitions("slot", "source_no")
        return whole.select(*docs.columns)

    return apart(docs, [*DOCUMENT, *([length.lower()] if length else [])], chosen)


def _keys(docs: DataFrame) -> dict[str, Column]:
    kinds = {name: docs[name].cast(kind) for name, kind in DOCUMENT.items()}
    return {
        "_key": F.xxhash64(kinds["doc_id"], kinds["source"], kinds["text"]),
        "_key2": F.xxhash64(
            F.lit("second"), kinds["doc_id"], kinds["source"], kinds["text"]
        ),
    }


def op10_mixing(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    mix = mixed(docs, Workspace(spark))
    return mix.select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot", "last_slot", "n_parts")
