"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Distinct vectors are dealt to shards by hash. Each shard builds a hierarchical navigable small
world: nodes enter in hashed order, in batches that at most double the graph; a batch searches
the graph as it is for candidates, and links are chosen by the usual rule that a neighbour must be
closer to the node than to the neighbours before it. The graph is stored as one row per node with
its neighbours of all levels in one flat array of fixed widths. Queries, in blocks, search every
shard by beam search; the shards' results are merged by score.

For the graph the vectors are scaled to norms of at most 1 in single precision and get one more
component that makes all norms equal, so that the largest inner product is also the nearest.
Scores are computed anew in double precision from the vectors as they are stored.

A shard holds about `SHARD_BYTES` of graph, some 10^5 vectors of 64 components, so that the
number of shards, each of which every query searches, grows slowly. Tables that would fill less than
`SHARDS` of these are cut into up to `SHARDS` shards of `SHARD_ROWS` rows or more, to be built in
parallel.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components take no
part, nor do rows without vec_id; only vectors of a query's own length are candidates; repeated
rows count once; of different vectors under one id the better counts. Equal vectors are one node
with their `KEPT` smallest ids: no more can be among the nearest. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import flat, lists
from salesmart.workspace import Workspace

NEAREST = 20

#: Bytes of a shard's graph in single precision, on average; bounds the memory of a task.
SHARD_BYTES = 40 * 2**20

#: Shards that a smaller table is cut into, and the rows from which on a shard is cut.
SHARDS, SHARD_ROWS = 64, 8192

#: Queries that search a shard in one task.
QUERY_ROWS = 8192

#: Links of a node on level 0 and on each level above; beam widths while building and searching.
WIDTH, UPPER = 32, 16
BUILD_BEAM, SEARCH_BEAM = 64, 96

#: Nodes that enter, or queries that search, together.
BATCH = 256

#: Nodes of a beam that are expanded in one step.
STEP = 4

#: One more than the nearest, as the query's own id is left out.
KEPT = NEAREST + 1

GRAPH = ("shard int, node int, level int, ids array<bigint>, vector array<{kind}>, "
         "neighbours array<int>")
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, each once. Components stay float where they
    are, else they become double."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(
        vectors["vec_id"].cast("bigint").alias("vec_id"),
        vectors["embedding"].cast(kind).alias("embedding"),
    )
    return rows.where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    ).dropDuplicates(["vec_id", "embedding"])


class Graph:
    """The graph of a shard while it is built and searched; all nodes in a few flat arrays."""

    def __init__(self, vectors: np.ndarray, level: np.ndarray):
        # One factor for all nodes keeps the order of their scores.
        scaled = vectors.astype(np.float64) / np.abs(vectors).max(initial=0)
        scaled /= np.sqrt((scaled**2).sum(axis=1).max(initial=0))
        more = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
        self.x = np.concatenate([scaled, more[:, None]], axis=1).astype(np.float32)
        self.level = level
        self.entry = int(np.argmax(level)) if len(level) else 0
        self.links = [
            np.full((len(vectors), WIDTH if depth == 0 else UPPER), -1, np.int32)
            for depth in range(int(level.max(initial=0)) + 1)
        ]

    def search(self, queries: np.ndarray, start: np.ndarray, depth: int, beam: int):
        """Best nodes found for each query from its start nodes on, best first, and scores."""
        links, n = self.links[depth], len(queries)
        rows = np.arange(n)
        seen = np.zeros((n, len(self.x) + 1), bool)  # the last place stands for no node
        ids = np.full((n, beam), -1, np.int64)
        scores = np.full((n, beam), -np.inf, np.float32)
        width = min(start.shape[1], beam)
        ids[:, :width] = start[:, :width]
        scores[:, :width] = np.where(
            ids[:, :width] >= 0, self._scores(queries, ids[:, :width]), -np.inf
        )
        seen[rows[:, None], ids[:, :width]] = True
        open_ = ids >= 0
        live = rows
        while len(live):
            waiting = np.where(open_[live], scores[live], -np.inf)
            step = min(STEP, beam)
            pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            some = np.take_along_axis(waiting, pick, 1) > -np.inf
            has = some.any(axis=1)
            live, pick, some = live[has], pick[has], some[has]
            if not len(live):
                break
            chosen = np.where(some, ids[live[:, None], pick], -1)
            open_[live[:, None], pick] = False
            near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[live[:, None], near]] = -1
            seen[live[:, None], near] = True
            seen[live, -1] = True
            found = np.where(near >= 0, self._scores(queries[live], near), -np.inf)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_scores = np.concatenate([scores[live], found], axis=1)
            all_open = np.concatenate([open_[live], near >= 0], axis=1)
            best = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            scores[live] = np.take_along_axis(all_scores, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1) & np.isfinite(scores[live])
        order = np.argsort(-scores, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)

    def _scores(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.einsum("qd,qnd->qn", queries, self.x[ids], optimize=True)

    def choose(self, nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray, width: int):
        """Neighbours of each node from candidates sorted by score: those that are closer to the
        node than to any chosen before, then the best of the others."""
        ids, scores = ids[:, : 3 * width], scores[:, : 3 * width]
        x = self.x[ids]
        between = np.matmul(x, x.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        real = (ids >= 0) & (ids != nodes[:, None])
        for rank in range(ids.shape[1]):
            hidden = (taken & (between[:, rank, :] > scores[:, rank, None])).any(axis=1)
            taken[:, rank] = real[:, rank] & ~hidden & (taken.sum(axis=1) < width)
        # Chosen ones first, then the others, each in the order of their scores.
        order = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")
        order = order[:, :width]
        kept = np.take_along_axis(np.where(real, ids, -1), order, 1)
        if kept.shape[1] < width:
            kept = np.pad(kept, ((0, 0), (0, width - kept.shape[1])), constant_values=-1)
        return kept.astype(np.int32)

    def build(self) -> None:
        n = len(self.x)
        order = np.concatenate([[self.entry], np.delete(np.arange(n), self.entry)])
        done = 1
        while done < n:
            batch = order[done:done + min(BATCH, max(done, 1))]
            self._enter(batch)
            done += len(batch)

    def _enter(self, batch: np.ndarray) -> None:
        queries, top = self.x[batch], len(self.links) - 1
        start = np.full((len(batch), 1), self.entry, np.int64)
        mates = queries @ queries.T
        for depth in range(top, -1, -1):
            start, scores = self.search(queries, start, depth, BUILD_BEAM if depth == 0 else 8)
            here = np.flatnonzero(self.level[batch] >= depth)
            if not len(here):
                continue
            # Nodes that enter together are candidates for each other.
            other = np.where(self.level[batch] >= depth, batch, -1)
            ids = np.concatenate([start[here], np.tile(other, (len(here), 1))], axis=1)
            both = np.concatenate([scores[here], mates[here]], axis=1)
            both[(ids < 0) | (ids == batch[here][:, None])] = -np.inf
            width = self.links[depth].shape[1]
            best = np.argsort(-both, axis=1, kind="stable")[:, : 3 * width]
            ids = np.where(np.isfinite(np.take_along_axis(both, best, 1)),
                           np.take_along_axis(ids, best, 1), -1)
            chosen = self.choose(batch[here], ids, np.take_along_axis(both, best, 1), width)
            self.links[depth][batch[here]] = chosen
            self._link_back(batch[here], chosen, depth)

    def _link_back(self, nodes: np.ndarray, chosen: np.ndarray, depth: int) -> None:
        links = self.links[depth]
        width = links.shape[1]
        source = np.repeat(nodes, width)[chosen.ravel() >= 0]
        target = chosen.ravel()[chosen.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        owner, first, count = np.unique(target, return_index=True, return_counts=True)
        for begin in range(0, len(owner), BATCH):
            own, at, n = (v[begin:begin + BATCH] for v in (owner, first, count))
            place = np.arange(n.max())
            more = np.where(place < n[:, None], source[np.minimum(at[:, None] + place,
                                                                  len(source) - 1)], -1)
            ids = np.sort(np.concatenate([links[own], more], axis=1), axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            scores = np.where(ids >= 0, self._scores(self.x[own], ids), -np.inf)
            best = np.argsort(-scores, axis=1, kind="stable")
            links[own] = self.choose(
                own, np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1), width
            )

    def nearest(self, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
        """Nodes found for plain query vectors, best first; -1 where there are no more."""
        out = []
        for begin in range(0, len(queries), BATCH):
            part = _unit(queries[begin:begin + BATCH])
            part = np.concatenate([part, np.zeros((len(part), 1), np.float32)], axis=1)
            start = np.full((len(part), 1), self.entry, np.int64)
            for depth in range(len(self.links) - 1, -1, -1):
                start, _ = self.search(part, start, depth, beam if depth == 0 else 8)
            out.append(start)
        return np.concatenate(out)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Each vector by its norm, which changes no order of a query's scores."""
    vectors = vectors.astype(np.float64) / np.abs(vectors).max(axis=1, keepdims=True)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column) -> np.ndarray:
    """Vectors as they are stored, one a row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, offsets = flat(column)
    return np.asarray(values).reshape(len(offsets) - 1, -1)


def graph(vectors: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """One row per distinct vector: its shard, its ids, and its neighbours as places in the shard:
    `WIDTH` of level 0, then `UPPER` for each level above, -1 where there are fewer."""
    kind = vectors.schema["embedding"].dataType.elementType
    component = pa.float32() if kind.simpleString() == "float" else pa.float64()
    per_vector = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = vectors.withColumn("_rank", F.row_number().over(per_vector)).where(
        F.col("_rank") <= KEPT
    ).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    shards = _shards(vectors, shard_rows)
    hashed = F.xxhash64("embedding")
    shard = F.pmod(hashed, F.lit(shards)) + F.size("embedding") * shards

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("hash").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        share = (table.column("hash").to_numpy().view(np.uint64) >> np.uint64(11)) / 2.0**53
        level = np.floor(-np.log(np.maximum(share, 1e-18)) / np.log(UPPER)).astype(np.int64)
        built = Graph(_matrix(table.column("embedding")), level)
        built.build()
        size = WIDTH + UPPER * level
        offsets = np.concatenate([[0], np.cumsum(size)])
        links = np.full(offsets[-1], -1, np.int32)
        for depth, rows in enumerate(built.links):
            own = np.flatnonzero(level >= depth)
            begin = offsets[own] + (0 if depth == 0 else WIDTH + UPPER * (depth - 1))
            links[begin[:, None] + np.arange(rows.shape[1])] = rows[own]
        return pa.table({
            "shard": table.column("shard"), "node": pa.array(np.arange(len(level)), pa.int32()),
            "level": pa.array(level, pa.int32()),
            "ids": table.column("ids").cast(pa.list_(pa.int64())),
            "vector": table.column("embedding").cast(pa.list_(component)),
            "neighbours": lists(links, offsets),
        })

    rows = distinct.select(shard.cast("int").alias("shard"), hashed.alias("hash"), "ids",
                           "embedding")
    return rows.groupBy("shard").applyInArrow(run, GRAPH.format(kind=kind.simpleString()))


def shards_of(rows: int, components: int, shard_rows: int | None = None) -> int:
    """Shards for so many rows of so many components in all, or by ``shard_rows``."""
    if shard_rows:
        return max(1, -(-rows // shard_rows))
    small = min(-(-rows // SHARD_ROWS), SHARDS)
    return max(1, small, -(-4 * (components + (1 + WIDTH) * rows) // SHARD_BYTES))


def _shards(vectors: DataFrame, shard_rows: int | None) -> int:
    rows, components = vectors.agg(F.count("*"), F.sum(F.size("embedding").cast("bigint"))).first()
    return shards_of(rows, components or 0, shard_rows)


def _load(table: pa.Table) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph of a shard, its vectors as stored, and the ids of all nodes with their offsets."""
    table = table.take(pa.array(np.argsort(table.column("node").to_numpy())))
    level = table.column("level").to_numpy().astype(np.int64)
    vectors = _matrix(table.column("vector"))
    loaded = Graph(vectors, level)
    links, offsets = flat(table.column("neighbours").combine_chunks())
    for depth, rows in enumerate(loaded.links):
        own = np.flatnonzero(level >= depth)
        begin = offsets[own] + (0 if depth == 0 else WIDTH + UPPER * (depth - 1))
        rows[own] = links[begin[:, None] + np.arange(rows.shape[1])]
    ids, offsets = flat(table.column("ids").combine_chunks())
    return loaded, vectors, ids, offsets


def search(
    graphs: DataFrame, queries: DataFrame, query_rows: int = QUERY_ROWS, nearest: int = NEAREST
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` candidates found for each query."""
    blocks = max(1, -(-queries.count() // query_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    shards = graphs.groupBy(F.col("shard").alias("to_shard")).agg(
        F.first(F.size("vector")).alias("width")
    )
    asked = queries.select("vec_id", "embedding", block, F.size("embedding").alias("width"))
    asked = asked.join(shards, "width").select("to_shard", "block", "vec_id", "embedding")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    stored = graphs.select("*", every)

    def run(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(nodes) or not len(asked):
            return pa.table({"query_id": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        loaded, vectors, ids, offsets = _load(nodes)
        matrix, own = _matrix(asked.column("embedding")), asked.column("vec_id").to_numpy()
        found = loaded.nearest(matrix)
        row, rank = np.nonzero(found >= 0)
        node = found[row, rank]
        score = np.concatenate([
            (vectors[node[a:a + 100_000]].astype(np.float64)
             * matrix[row[a:a + 100_000]].astype(np.float64)).sum(axis=1)
            for a in range(0, len(node), 100_000)
        ])
        copies = (offsets[1:] - offsets[:-1])[node]
        inside = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        vec = ids[np.repeat(offsets[node], copies) + inside]
        row, score = np.repeat(row, copies), np.repeat(score, copies)
        other = vec != own[row]
        row, vec, score = row[other], vec[other], score[other]
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        first = np.searchsorted(row, row)
        best = np.arange(len(row)) - first < nearest
        return pa.table({"query_id": own[row[best]], "vec_id": vec[best], "score": score[best]})

    pairs = stored.groupBy("shard", "block").cogroup(asked.groupBy("to_shard", "block"))
    merged = pairs.applyInArrow(run, FOUND).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark, folder: str) -> DataFrame:
    workspace = Workspace(spark)
    vectors = workspace.store("vectors", usable(spark.read.parquet(f"{folder}/embeddings.parquet")))
    graphs = workspace.store("graph", graph(vectors))
    return search(graphs, vectors.where("vec_id % 20 = 0"))
