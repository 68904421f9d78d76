"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of `SHINGLE` words; the weight is the count times
the inverse document frequency. Improved consistent weighted sampling draws `BANDS` x `ROWS`
samples from it such that two documents draw the same one with a probability equal to their
weighted Jaccard similarity. Documents that agree on a whole band are candidates; candidates are
verified on their texts, and classes are the connected components of the verified links.

Copies (texts with the same words) are one node from the start. In a bucket of a band with up to
`SMALL` nodes all pairs are candidates. In a larger one every node is compared with the bucket's
hub, the node with most company over all bands. The nodes of large buckets that are still in
several components get a complete search: two texts of similarity s share a shingle within the
rarest ones that make up 1 - s of either's weight, so all pairs of different components that share
one are candidates, but for those whose weight from the first shared one on cannot reach s. That
finds every pair, wherever in a bucket it is, and does not compare what only a template joins.

Document frequencies are counted per hash of the shingle in `DF_BUCKETS` buckets, a table of fixed
size that is broadcast: sharing a bucket lowers the weight of rare shingles alike.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a text with fewer words than a shingle is alike
only to texts with the same words; a NULL text has no words. A class is named by its smallest
doc_id, NULL only if all its ids are. Extra columns are ignored by `classes`, kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.block import Block
from salesmart.llm.common import apart, by_weight, flat, maybe_among, mix64, with_columns, words_of
from salesmart.workspace import Workspace

SHINGLE = 5
SIMILAR = 0.8

#: A pair of similarity 0.8 shares a band with probability 0.999, one of 0.3 with 0.24.
BANDS, ROWS = 10, 3

#: Buckets of this many nodes at most are compared pair by pair.
SMALL = 16

#: Hashed document frequencies: 2**18 numbers, 2 MB.
DF_BUCKETS = 2**18

#: Nodes of a hot shingle that are compared with the others in a task.
SLICE = 512

#: What sums of weights may differ by, as a part of a text's weight.
ROUNDING = 1e-6

#: Words that a task works on at a time, but for a longer single text.
BLOCK_WORDS = 400_000

#: Entries of the tables that random numbers are drawn from.
TABLE = 2**16

NODE = ["_node", "_node2"]
DOCUMENT = {"doc_id": "bigint", "text": "string", "source": "string"}


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, the node (hashes of the word sequence) and the word hashes of each document."""
    rows = with_columns(docs, DOCUMENT).withColumn("_list", words_of(F.col("text")))
    return rows.select(
        "doc_id", F.xxhash64("_list").alias("_node"),
        F.xxhash64(F.lit("second"), "_list").alias("_node2"),
        F.transform("_list", lambda word: F.xxhash64(word)).alias("words"),
    )


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of a block, sorted by document."""
    block = Block(words, offsets)
    starts = block.windows(SHINGLE)
    name = block.fingerprint(starts, starts + SHINGLE)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    order = np.argsort(name, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    name, doc = name[order], doc[order]
    head = np.ones(len(name), bool)
    head[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    return doc[first], name[first], np.diff(np.append(first, len(name)))


def _df_bucket(name: np.ndarray) -> np.ndarray:
    return (name >> np.uint64(64 - 18)).astype(np.int64)


def document_frequencies(nodes: DataFrame) -> np.ndarray:
    """Weight of each bucket of shingles: 1 + ln((1 + documents) / (1 + documents with it))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = np.zeros(DF_BUCKETS, np.int64), 0
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            _, name, _ = shingles(*flat(batch.column("words")))
            counts += np.bincount(_df_bucket(name), minlength=DF_BUCKETS)
            documents += batch.num_rows
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(counts[found], documents))],
            names=["bucket", "n"],
        )

    rows = nodes.select("words").mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(DF_BUCKETS + 1, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # of fixed size
        counts[bucket] = n
    return (1 + np.log((1 + counts[-1]) / (1 + np.minimum(counts[:-1], counts[-1])))).astype(
        np.float32
    )


def _gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, by bisection."""
    wanted = (np.arange(TABLE) + 0.5) / TABLE
    low, high = np.zeros(TABLE), np.full(TABLE, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - np.exp(-middle) * (1 + middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def sample(
    doc: np.ndarray, name: np.ndarray, weight: np.ndarray, number: int, gamma: np.ndarray
) -> np.ndarray:
    """The ``number``-th consistent weighted sample of every document of a block."""
    with np.errstate(over="ignore"):
        z = mix64(name + mix64(np.array([number + 1], np.uint64)))
    r = gamma[(z & np.uint64(TABLE - 1)).astype(np.int64)]
    c = gamma[((z >> np.uint64(16)) & np.uint64(TABLE - 1)).astype(np.int64)]
    shift = (z >> np.uint64(32)).astype(np.float64) / 2.0**32
    t = np.floor(np.log(weight) / r + shift)
    score = np.log(c) - r * (t - shift) - r
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    best = np.minimum.reduceat(score, first)
    at = np.flatnonzero(score == np.repeat(best, np.diff(np.append(first, len(doc)))))
    at = at[np.append(True, doc[at[1:]] != doc[at[:-1]])]
    return mix64(name[at] + mix64(t[at].astype(np.int64).view(np.uint64)))


def bands(nodes: DataFrame, idf) -> DataFrame:
    """(node, band, bucket) of all nodes with a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gamma = _gamma_table()
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            doc, name, count = shingles(*flat(batch.column("words")))
            if not len(doc):
                continue
            weight = count * idf.value[_df_bucket(name)].astype(np.float64)
            which = np.unique(doc)
            keys = []
            for band in range(BANDS):
                key = np.zeros(len(which), np.uint64)
                for row in range(ROWS):
                    drawn = sample(doc, name, weight, band * ROWS + row, gamma)
                    key = mix64(key * np.uint64(3) + drawn)
                keys.append(key)
            rows = pa.array(which)
            flat_keys = np.stack(keys, axis=1).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(column).take(rows) for column in NODE),
                    pa.FixedSizeListArray.from_arrays(pa.array(flat_keys), BANDS)
                    .cast(pa.list_(pa.int64())),
                ],
                names=[*NODE, "keys"],
            )

    drawn = nodes.select(*NODE, "words").mapInArrow(
        run, "_node bigint, _node2 bigint, keys array<bigint>"
    )
    return drawn.dropDuplicates(NODE).select(
        F.struct(*NODE).alias("node"), F.posexplode("keys").alias("band", "key")
    )


def _members(buckets: DataFrame, by: list[str]) -> DataFrame:
    """Nodes of buckets of two or more, with the bucket's size."""
    size = buckets.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return buckets.join(size, by)


def _pairs(members: DataFrame, by: list[str]) -> DataFrame:
    """Candidate pairs (a, b) of nodes in different components: all of a small bucket, and in a
    large one those of the hub and those of the hub among what is not in the hub's component.

    ``members`` has node, company, component and size beside the bucket.
    """
    small = members.where(F.col("size") <= SMALL)
    left = small.select(*by, F.col("node").alias("a"), F.col("component").alias("ca"))
    right = small.select(*by, F.col("node").alias("b"), F.col("component").alias("cb"))
    close = left.join(right, by).where("a < b AND ca != cb").select("a", "b")

    large = members.where(F.col("size") > SMALL)
    hub = large.groupBy(*by).agg(
        F.max_by(F.struct("node", "component"), F.struct("company", "node")).alias("hub")
    )
    others = large.join(hub, by).where(F.col("component") != F.col("hub.component"))
    second = others.groupBy(*by).agg(
        F.max_by(F.struct("node", "component"), F.struct("company", "node")).alias("second")
    )
    to_hub = others.select(F.col("node").alias("a"), F.col("hub.node").alias("b"))
    to_second = large.join(second, by).where(F.col("component") != F.col("second.component"))
    to_second = to_second.select(F.col("node").alias("a"), F.col("second.node").alias("b"))
    return close.unionByName(to_hub).unionByName(to_second).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def _rarest(texts: DataFrame, idf, rarity, similar: float) -> DataFrame:
    """(node, component, total, shingle, rest): the rarest shingles of each node, as many as a
    similar text must share one of. ``total`` is the node's weight, ``rest`` that of the shingle
    and all that come after it. ``rarity`` gives the order, hashes break ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            doc, name, count = shingles(*flat(batch.column("words")))
            weight = count * idf.value[_df_bucket(name)].astype(np.float64)
            order = np.lexsort((name, -rarity.value[_df_bucket(name)], doc))
            name, weight = name[order], weight[order]
            total = np.bincount(doc, weight, minlength=batch.num_rows)
            ahead = np.cumsum(weight) - weight
            first = np.searchsorted(doc, doc)
            rest = total[doc] - (ahead - ahead[first])
            kept = np.flatnonzero(rest >= (similar - ROUNDING) * total[doc])
            at = pa.array(doc[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(at), batch.column("component").take(at),
                    pa.array(total[doc[kept]]), pa.array(name[kept].view(np.int64)),
                    pa.array(rest[kept]),
                ],
                names=["node", "component", "total", "shingle", "rest"],
            )

    node = "struct<_node:bigint,_node2:bigint>"
    return texts.select("node", "component", "words").mapInArrow(
        run, f"node {node}, component {node}, total double, shingle bigint, rest double"
    )


def _sharing(rare: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of different components that share one of their rarest shingles and have
    weight enough from there on. The nodes of a hot shingle meet in slices.

    At the first shingle that a similar pair shares, the rest of both holds all that they share,
    which is at least ``similar / (1 + similar)`` of their weights' sum.
    """
    groups = rare.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("component").alias("least"), F.max("component").alias("most"),
    ).where("least != most").select(
        "shingle", F.ceil(F.col("size") / SLICE).cast("int").alias("slices")
    )
    rows = rare.join(groups, "shingle")
    left = rows.select(
        "shingle", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice"),
        F.col("node").alias("a"), F.col("component").alias("ca"),
        F.col("total").alias("ta"), F.col("rest").alias("ra"),
    )
    right = rows.select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.col("node").alias("b"), F.col("component").alias("cb"),
        F.col("total").alias("tb"), F.col("rest").alias("rb"),
    )
    least = (similar / (1 + similar) - ROUNDING) * (F.col("ta") + F.col("tb"))
    return left.join(right, ["shingle", "slice"]).where(
        (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
        & (F.least("ra", "rb") >= least)
    ).select("a", "b").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, idf, similar: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose weighted Jaccard similarity reaches ``similar``."""
    left = texts.select(F.col("node").alias("a"), F.col("words").alias("wa"))
    right = texts.select(F.col("node").alias("b"), F.col("words").alias("wb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_weight([whole], "wa", BLOCK_WORDS // 4):
                score = [
                    weighted_jaccard(a, b, idf.value)
                    for a, b in zip(_rows(batch.column("wa")), _rows(batch.column("wb")))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(score, pa.float64())],
                    names=["a", "b", "similarity"],
                )

    node = "struct<_node:bigint,_node2:bigint>"
    return both.mapInArrow(run, f"a {node}, b {node}, similarity double").where(
        F.col("similarity") >= similar
    )


def _rows(column: pa.Array) -> Iterator[np.ndarray]:
    values, offsets = flat(column)
    return (values[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist()))


def weighted_jaccard(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Sum of the smaller weights over the sum of the larger, of two texts' shingles."""
    name, tf = [], []
    for words in (a, b):
        _, found, count = shingles(words, np.array([0, len(words)], np.int64))
        name.append(found)
        tf.append(count)
    every, place = np.unique(np.concatenate(name), return_inverse=True)
    counts = np.zeros((2, len(every)))
    counts[0, place[: len(name[0])]] = tf[0]
    counts[1, place[len(name[0]):]] = tf[1]
    weight = idf[_df_bucket(every)].astype(np.float64)
    most = (counts.max(axis=0) * weight).sum()
    return float((counts.min(axis=0) * weight).sum() / most) if most else 0.0


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, component) of all linked nodes: the smallest node that links lead to.

    Each round takes the smallest label among the neighbours and then that label's own label, so
    rounds grow with the logarithm of a chain's length. Every round is a stored table.
    """
    edges = workspace.store("edges", links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    ).distinct())
    labels = workspace.store("labels_0", edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("component")
    ))
    number = 0
    while True:
        number += 1
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(
            F.min("component").alias("near")
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("before"),
            F.least("component", "near").alias("component"),
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = lower.join(jump, "component", "left").select(
            "node", "before", F.least("component", F.coalesce("next", "component")).alias("component")
        )
        labels = workspace.store(f"labels_{number}", moved)
        changed = labels.where("component != before").limit(1).count()
        labels = labels.drop("before")
        if not changed:
            return labels


def node_classes(
    nodes: DataFrame, workspace: Workspace, similar: float = SIMILAR
) -> DataFrame | None:
    """(node, component) of the nodes that are linked to others; None if no candidates exist."""
    session = nodes.sparkSession.sparkContext
    idf = session.broadcast(document_frequencies(nodes))
    shared = workspace.store("shared", _members(bands(nodes, idf), ["band", "key"]))
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    members = workspace.store("members", shared.join(company, "node"))
    wanted = members.select("node").distinct().select("node.*")
    texts = maybe_among(nodes.select(*NODE, "words"), wanted, "_node")
    texts = texts.join(wanted, NODE, "left_semi").dropDuplicates(NODE).select(
        F.struct(*NODE).alias("node"), "words"
    )
    texts = workspace.store("texts", texts)

    space = workspace.child("hubs")
    labelled = members.withColumn("component", F.col("node"))
    pairs = space.store("pairs", _pairs(labelled, ["band", "key"]))
    if not pairs.limit(1).count():
        return None
    links = space.store("links", _verified(pairs, texts, idf, similar))
    labels = components(links, space)

    # All pairs of the large buckets that still hold several components.
    known = members.where(F.col("size") > SMALL).join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed = known.groupBy("band", "key").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).where("least != most").select("band", "key")
    space = workspace.child("complete")
    open_nodes = space.store("open", known.join(mixed, ["band", "key"]).select(
        "node", "component").distinct())
    if not open_nodes.limit(1).count():
        return labels
    open_texts = space.store("texts", texts.join(open_nodes, "node"))
    rarity = session.broadcast(document_frequencies(open_texts))
    rare = space.store("rare", _rarest(open_texts, idf, rarity, similar))
    more = _sharing(rare, similar).join(pairs, ["a", "b"], "left_anti")
    more = space.store("pairs", more)
    found = space.store("links", _verified(more, open_texts, idf, similar))
    return components(links.unionByName(found), space) if found.limit(1).count() else labels


def classes(docs: DataFrame, workspace: Workspace, similar: float = SIMILAR) -> DataFrame:
    """One row per document: doc_id, class_id, and the node columns."""
    nodes = _nodes(docs)
    labels = node_classes(nodes, workspace, similar)
    ids = workspace.store("ids", nodes.select("doc_id", *NODE))
    named = ids.groupBy(*NODE).agg(F.min("doc_id").alias("least")).withColumn(
        "node", F.struct(*NODE)
    )
    named = named.withColumn("component", F.col("node")) if labels is None else (
        named.join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("class_id"))
    found = workspace.store(
        "classes", named.join(smallest, "component").select(*NODE, "component", "class_id")
    )
    return ids.join(found, NODE).select("doc_id", "class_id", "component", *NODE)


def keep_one(docs: DataFrame, workspace: Workspace, similar: float = SIMILAR) -> DataFrame:
    """The documents of ``docs``, of each class only the first by doc_id, NULL last."""
    return apart(docs, ["doc_id", "text"], lambda docs: _keep_one(docs, workspace, similar))


def _keep_one(docs: DataFrame, workspace: Workspace, similar: float) -> DataFrame:
    found = workspace.store("rows", classes(docs, workspace, similar))
    order = Window.partitionBy("component").orderBy(F.col("doc_id").asc_nulls_last(), *NODE)
    size = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = found.join(size, "component")
    first = shared.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    first = workspace.store("first", first.select("doc_id", *NODE))
    copies = workspace.store("copies", shared.select(*NODE).distinct())
    words = words_of(docs["text"].cast("string"))
    keyed = docs.withColumn("_list", words).withColumns({
        "_node": F.xxhash64("_list"), "_node2": F.xxhash64(F.lit("second"), "_list"),
    }).drop("_list")
    alone = maybe_among(keyed, copies, "_node", "left_anti")
    maybe = maybe_among(keyed, copies, "_node")
    also_alone = maybe.join(copies, NODE, "left_anti")
    kinds = maybe["doc_id"].cast("bigint").eqNullSafe(first["doc_id"])
    same = kinds & (maybe["_node"] == first["_node"]) & (maybe["_node2"] == first["_node2"])
    chosen = maybe.join(first, same, "left_semi").dropDuplicates(NODE)
    return alone.unionByName(also_alone).unionByName(chosen).select(*docs.columns)


def op7_near_dedup(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return classes(docs, Workspace(spark)).select("doc_id", "class_id")
