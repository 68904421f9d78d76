"""Substring dedup by recompression: removal of passages that occur earlier in the corpus.

Every text is a sequence of word hashes that is shortened in rounds. The first round names runs of
equal words; each round names pairs of neighbours, one that a bit of its name makes a left half
followed by a right half. A name is a 64-bit fingerprint of what it stands for, so all tasks give
the same names without a dictionary or exchange, and equal substrings get the same symbols inside.
With each symbol goes the stretch of words that fixes it: wherever these words occur, so does the
symbol, whatever stands around them.

A window's *anchor* is a symbol of the highest level that the window's own words fix, the one
with the smallest fingerprint. Equal windows therefore have equal anchors, and a window whose
anchor occurs once in the corpus has no equal. Anchors are far fewer than words, and Spark counts
them. Windows with an anchor that occurs again are named whole, sent to one place by name, and all
but the first are claimed to repeat the first.

Claims are verified on the words. Those of one document that follow each other at one distance
from their first place are one run, cut at every `CELL` words of the first place, so that a hot text is asked
for few different stretches, whoever repeats it. Each stretch asked for is digested once in its own document
(SHA-256 of its words). A document loses words only where stretches with the same digest as its own
words follow each other for a window or more.

The anchors that occur again are kept as a bit filter of fixed size (`FILTER_BITS`), which is what
is broadcast. A hash clash or a full filter only sends more windows on, it changes no result. Of
equal windows within a block only the first is sent, so a hot passage is one row per block.

Defined results: documents are ordered by doc_id, NULL last, then by a hash of their text; rows
equal in both are treated alike (as one document); a NULL text is empty; texts shorter than a
window lose nothing; extra columns are ignored. Where different windows share a 64-bit name, the
claims of those that differ from the first fail, and they remove nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.block import BASE, ODD, Block
from salesmart.llm.common import (
    by_weight,
    flat,
    maybe_among,
    mix64,
    or_empty,
    with_columns,
    word_hashes,
)
from salesmart.workspace import Workspace

#: Words in a window.
WINDOW = 20

#: Rounds of naming; a symbol of the last level stands for about three words.
ROUNDS = 4

#: Bits of the filter of anchors that occur again: 16 MB, whatever the corpus.
FILTER_BITS = 27

#: Words that a task works on at a time, but for a longer single text.
BLOCK_WORDS = 400_000

#: Words of the first place between two cuts of a claim.
CELL = 64

#: Bits of a window's name; fewer make different windows meet, which tests use.
NAME_BITS = 64

DOCUMENT = {"doc_id": "bigint", "text": "string"}
DOC = ["doc_id", "_text_key"]


class Symbols:
    """One level: names, the words each symbol covers, and the words that fix it."""

    def __init__(self, name, start, end, low, high, doc):
        self.name, self.start, self.end = name, start, end
        self.low, self.high, self.doc = low, high, doc


def _runs(s: Symbols, first: np.ndarray, last: np.ndarray) -> Symbols:
    """Name maximal runs of a symbol. A run is fixed by itself and its neighbours."""
    n = len(s.name)
    heads = np.ones(n, bool)
    heads[1:] = (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])
    head = np.flatnonzero(heads)
    tail = np.append(head[1:], n) - 1
    size = (tail - head + 1).astype(np.uint64)
    name = np.where(size > 1, mix64(s.name[head] + size * ODD), s.name[head])
    doc = s.doc[head]
    low, high = first[doc] - 1, last[doc] + 1  # beyond the text, unless there is a neighbour
    left = (head > 0) & (s.doc[head - 1] == doc)
    low[left] = s.low[head[left] - 1]
    after = np.minimum(tail + 1, n - 1)
    right = (tail + 1 < n) & (s.doc[after] == doc)
    high[right] = s.high[after[right]]
    return Symbols(name, s.start[head], s.end[tail], low, high, doc)


def _pairs(s: Symbols, first: np.ndarray, last: np.ndarray, level: int) -> Symbols:
    """Name pairs of a left half and a right half. A pair is fixed by its halves, a left half
    left over also by what follows, a right half left over by what comes before."""
    n = len(s.name)
    salt = np.array([level], np.uint64) * ODD
    is_left = (mix64(s.name + salt) >> np.uint64(63)).astype(bool)
    same_doc = s.doc[1:] == s.doc[:-1]
    joined = np.zeros(n, bool)  # with the next one
    joined[:-1] = is_left[:-1] & ~is_left[1:] & same_doc
    low, high = s.low.copy(), s.high.copy()
    alone = ~joined
    alone[1:] &= ~joined[:-1]
    follows = np.zeros(n, bool)
    follows[:-1] = same_doc
    comes = np.zeros(n, bool)
    comes[1:] = same_doc
    at = np.flatnonzero(alone & is_left & follows)
    high[at] = s.high[at + 1]
    at = np.flatnonzero(alone & is_left & ~follows)
    high[at] = last[s.doc[at]] + 1
    at = np.flatnonzero(alone & ~is_left & comes)
    low[at] = s.low[at - 1]
    at = np.flatnonzero(alone & ~is_left & ~comes)
    low[at] = first[s.doc[at]] - 1
    head = np.ones(n, bool)
    head[1:] = ~joined[:-1]
    head = np.flatnonzero(head)
    pair = joined[head]
    tail = head + pair
    name = np.where(pair, mix64(s.name[head] * BASE + s.name[tail] + ODD), s.name[head])
    return Symbols(name, s.start[head], s.end[tail], low[head], high[tail], s.doc[head])


def levels(words: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The levels of all texts of a block, words first."""
    n = len(words)
    place = np.arange(n, dtype=np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    first, last = offsets[:-1], offsets[1:]
    name = mix64(words.view(np.uint64))
    found = [Symbols(name, place, place + 1, place, place + 1, doc)]
    symbols = _runs(found[0], first, last)
    for level in range(1, rounds + 1):
        symbols = _pairs(symbols, first, last, level)
        found.append(symbols)
    return found


def _smallest(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Index of the smallest value in each range, the first of equal ones."""
    best = np.arange(len(values))
    tables, width = [best], 1
    while 2 * width <= count.max(initial=1):
        left, right = best[:-width], best[width:]
        best = np.where(values[right] < values[left], right, left)
        tables.append(best)
        width *= 2
    result = np.empty(len(first), np.int64)
    step = np.frexp(count.astype(np.float64))[1] - 1
    for number, table in enumerate(tables):
        at = np.flatnonzero(step == number)
        left, right = table[first[at]], table[first[at] + count[at] - 2**number]
        result[at] = np.where(values[right] < values[left], right, left)
    return result


def anchors(block: Block, size: int = WINDOW, rounds: int = ROUNDS):
    """(starts of the windows, anchor key per window, keys of the distinct anchors)."""
    starts = block.windows(size)
    keys = np.zeros(len(starts), np.uint64)
    open_ = np.arange(len(starts))
    distinct = []
    if len(starts):
        found = levels(block.words, block.offsets, rounds)
        for level in range(rounds, -1, -1):
            s = found[level]
            fixed = (s.low >= block.offsets[s.doc]) & (s.high <= block.offsets[s.doc + 1])
            low, high, name = s.low[fixed], s.high[fixed], s.name[fixed]
            value = mix64(block.fingerprint(low, high) ^ (name * BASE + np.uint64(level)))
            begun = np.concatenate([[0], np.cumsum(np.bincount(low, minlength=len(block.words)))])
            done = np.cumsum(np.bincount(high, minlength=len(block.words) + 1))
            at = starts[open_]
            first = begun[at]
            count = done[at + size] - first
            has = count > 0
            chosen = _smallest(value, first[has], count[has])
            keys[open_[has]] = value[chosen]
            distinct.append(value[np.unique(chosen)])
            open_ = open_[~has]
            if not len(open_):
                break
    return starts, keys, np.concatenate(distinct) if distinct else keys


def _hashed(docs: DataFrame) -> DataFrame:
    rows = with_columns(docs, DOCUMENT).withColumn("text", or_empty(F.col("text")))
    key = F.xxhash64(F.lit("text"), "text").alias("_text_key")
    return rows.select("doc_id", key, word_hashes(F.col("text")).alias("words"))


def repeated_anchors(docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(key) of the anchors that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            keys = anchors(Block(*flat(batch.column("words"))), size, rounds)[2]
            found, counts = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(np.minimum(counts, 2))],
                names=["key", "n"],
            )

    counted = _hashed(docs).select("words").mapInArrow(run, "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


def _filter(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit filter of the keys: one bit for each value of their first ``bits`` bits."""
    place = F.shiftrightunsigned("key", 64 - bits) + 1  # Spark's bitmaps begin at 1
    rows = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = np.zeros(max(2**bits // 8, 4096), np.uint8)
    for part, data in rows.collect():  # at most 2**bits / 8 bytes: the filter itself
        begin = 4096 * (part - 1)
        data = np.frombuffer(bytes(data), np.uint8)
        whole[begin:begin + len(data)] |= data[: len(whole) - begin]
    return whole


def _passes(whole: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    place = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return (whole[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def claims(
    docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS, name_bits: int = NAME_BITS
) -> DataFrame:
    """(doc_id, _text_key, start, end, to_id, to_key, to_start): stretches of words of a document
    that by their windows' names are the same as those from ``to_start`` on, which come earlier."""
    bits = FILTER_BITS
    anchored = docs.sparkSession.sparkContext.broadcast(
        _filter(repeated_anchors(docs, size, rounds), bits)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            yield _sent(batch, size, rounds, anchored.value, bits, name_bits)

    sent = _hashed(docs).mapInArrow(
        run, "name bigint, doc_id bigint, _text_key bigint, start int, end int, sure boolean, "
        "to_id bigint, to_key bigint, to_start int",
    )
    order = Window.partitionBy("name").orderBy(
        F.col("doc_id").asc_nulls_last(), "_text_key", "start"
    )
    # Identical rows are one document: their equal windows are peers, none is after the other, and
    # one of them is enough.
    # Window functions of plain columns, as a struct would be shuffled beside its columns.
    columns = [*DOC, "start", "end", "to_id", "to_key", "to_start"]
    again = [F.col(name).eqNullSafe(F.lag(name).over(order)) for name in columns]
    later = sent.withColumns({
        "_rank": F.rank().over(order),
        "_again": reduce(and_, again),
        **{f"_first_{name}": F.first(name).over(order) for name in (*DOC, "start")},
    }).where("(sure OR _rank > 1) AND NOT _again")

    def source(own: str, given: str):
        return F.when(F.col("sure"), F.col(given)).otherwise(F.col(f"_first_{own}")).alias(given)

    rows = later.select(*DOC, "start", "end", source("doc_id", "to_id"),
                        source("_text_key", "to_key"), source("start", "to_start"))
    # Where a batch ends within a document a run becomes two, which overlap.
    sorted_ = rows.repartition(*DOC).sortWithinPartitions(*DOC, "start")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(_cut, batches)

    return sorted_.mapInArrow(cut, rows.schema)


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Claims of sorted documents joined to runs and cut at the cells of their first place."""
    ids, keys, to_id, to_key = (batch.column(n) for n in ("doc_id", "_text_key", "to_id", "to_key"))
    start, end, to_start = (
        batch.column(name).to_numpy().astype(np.int64) for name in ("start", "end", "to_start"))
    documents = np.stack([ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(),
                          keys.to_numpy()])
    row = np.cumsum(np.any(documents != np.roll(documents, 1, axis=1), axis=0))
    missing = to_id.is_null().to_numpy(zero_copy_only=False)
    shift = to_start - start
    order = np.lexsort((start, shift, to_key.to_numpy(), to_id.fill_null(0).to_numpy(), missing, row))
    start, end, shift = start[order], end[order], shift[order]
    same = np.stack([row, missing, to_id.fill_null(0).to_numpy(), to_key.to_numpy()])[:, order]
    head = np.ones(len(order), bool)
    head[1:] = (same[:, 1:] != same[:, :-1]).any(axis=0) | (shift[1:] != shift[:-1])
    head[1:] |= start[1:] > end[:-1]
    head = np.flatnonzero(head)
    end = np.maximum.reduceat(end, head) if len(head) else end
    start, shift, order = start[head], shift[head], order[head]
    low, high = start + shift, end + shift
    cells = (high - 1) // CELL - low // CELL + 1
    run = np.repeat(np.arange(len(head)), cells)
    cell = low[run] // CELL + np.arange(len(run)) - np.repeat(np.cumsum(cells) - cells, cells)
    begin = np.maximum(low[run], cell * CELL)
    stop = np.minimum(high[run], (cell + 1) * CELL)
    order = pa.array(order[run])
    return pa.RecordBatch.from_arrays(
        [
            ids.take(order), keys.take(order),
            pa.array((begin - shift[run]).astype(np.int32)),
            pa.array((stop - shift[run]).astype(np.int32)),
            to_id.take(order), to_key.take(order), pa.array(begin.astype(np.int32)),
        ],
        names=["doc_id", "_text_key", "start", "end", "to_id", "to_key", "to_start"],
    )


def _digest(words: list[bytes], start: int, end: int) -> bytes:
    return hashlib.sha256(b" ".join(words[start:end])).digest()


def _words(text: pa.StringScalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().split()  # at ASCII white space only


def _texts(docs: DataFrame) -> DataFrame:
    rows = with_columns(docs, DOCUMENT).withColumn("text", or_empty(F.col("text")))
    return rows.withColumn("_text_key", F.xxhash64(F.lit("text"), "text"))


def digests(docs: DataFrame, claimed: DataFrame) -> DataFrame:
    """(to_id, to_key, to_start, size, digest) of the stretches that ``claimed`` refers to.

    A document's list holds a stretch once, whoever claims it, and all lie in cells, so its length
    is bounded by that of the document.
    """
    stretch = F.struct("to_start", (F.col("end") - F.col("start")).alias("size"))
    asked = claimed.groupBy("to_id", "to_key").agg(F.collect_set(stretch).alias("asked"))
    rows = maybe_among(_texts(docs), claimed.select(F.col("to_key").alias("_text_key")), "_text_key")
    same = rows["doc_id"].eqNullSafe(asked["to_id"]) & (rows["_text_key"] == asked["to_key"])
    joined = rows.join(asked, same).select("to_id", "to_key", "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked")
            stretches = asked.flatten()
            starts, sizes = (stretches.field(i).to_pylist() for i in (0, 1))
            ends = np.cumsum(asked.value_lengths().to_numpy()).tolist()
            found, at = [], 0
            for text, stop in zip(batch.column("text"), ends):
                words = _words(text)
                found += [_digest(words, a, a + n) for a, n in zip(starts[at:stop], sizes[at:stop])]
                at = stop
            row = pa.array(np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)))
            yield pa.RecordBatch.from_arrays([
                batch.column("to_id").take(row), batch.column("to_key").take(row),
                stretches.field(0), stretches.field(1), pa.array(found, pa.binary()),
            ], names=["to_id", "to_key", "to_start", "size", "digest"])

    schema = "to_id bigint, to_key bigint, to_start int, size int, digest binary"
    # Rows of one document give each stretch once.
    found = joined.mapInArrow(run, schema)
    return found.groupBy("to_id", "to_key", "to_start", "size").agg(F.min("digest").alias("digest"))


def with_digests(docs: DataFrame, claimed: DataFrame) -> DataFrame:
    """(doc_id, _text_key, spans): the claims of each document, as list of (run, start, end, digest
    that the words must have). Claims of one run have the same distance from their first place."""
    asked = digests(docs, claimed).withColumnsRenamed({"to_id": "_id", "to_key": "_key",
                                                      "to_start": "_start"})
    same = (
        claimed["to_id"].eqNullSafe(asked["_id"]) & (claimed["to_key"] == asked["_key"])
        & (claimed["to_start"] == asked["_start"])
        & (claimed["end"] - claimed["start"] == asked["size"])
    )
    run = F.xxhash64("to_id", "to_key", F.col("to_start") - F.col("start")).alias("run")
    spans = F.sort_array(F.collect_list(F.struct(run, "start", "end", "digest"))).alias("spans")
    return claimed.join(asked, same).groupBy(*DOC).agg(spans)


def _sent(
    batch: pa.RecordBatch, size: int, rounds: int, again: np.ndarray, bits: int, name_bits: int
) -> pa.RecordBatch:
    """Windows of a block that may occur again: the first of equal ones by name, the others, whose
    first place may be taken to be that one, as spans."""
    words, offsets = flat(batch.column("words"))
    block = Block(words, offsets)
    starts, keys, _ = anchors(block, size, rounds)
    starts = starts[_passes(again, bits, keys)]
    name = block.fingerprint(starts, starts + size) >> np.uint64(64 - name_bits)
    ids, text_keys = batch.column("doc_id"), batch.column("_text_key").to_numpy()
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy()
    # Rank of each document; identical ones share it.
    order = np.lexsort((text_keys, numbers, missing))
    column = np.stack([missing[order].astype(np.int64), numbers[order], text_keys[order]])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(
        np.append(0, np.any(column[:, 1:] != column[:, :-1], axis=0)) if len(order) else []
    )
    doc = np.searchsorted(offsets, starts, side="right") - 1
    place = starts - offsets[doc]
    order = np.lexsort((place, rank[doc], name))
    name, doc, place = name[order], doc[order], place[order]
    head = np.ones(len(name), bool)
    head[1:] = name[1:] != name[:-1]
    group = np.cumsum(head) - 1
    lead = np.flatnonzero(head)
    to_doc, to_place = doc[lead][group], place[lead][group]
    sure = (rank[doc] != rank[to_doc]) | (place != to_place)
    # Windows that are peers of the first, in identical rows, are the same window.
    extra = ~head & ~sure
    name, doc, place, sure = name[~extra], doc[~extra], place[~extra], sure[~extra]
    to_doc, to_place = to_doc[~extra][sure], to_place[~extra][sure]
    # Repeats in one piece of text at one distance from their first place become one span each.
    d, p = doc[sure], place[sure]
    at = np.lexsort((p, to_place - p, to_doc, d))
    d, p, to_doc, to_place = d[at], p[at], to_doc[at], to_place[at]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (to_doc[1:] != to_doc[:-1]) | (p[1:] > p[:-1] + size)
    new[1:] |= (to_place - p)[1:] != (to_place - p)[:-1]
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(d)) - 1 if len(d) else begin
    all_doc = np.concatenate([doc[~sure], d[begin]])
    all_start = np.concatenate([place[~sure], p[begin]])
    all_end = np.concatenate([place[~sure] + size, p[stop] + size])
    open_ = int((~sure).sum())
    certain = np.concatenate([np.zeros(open_, bool), np.ones(len(begin), bool)])
    scatter = mix64(text_keys[d[begin]].view(np.uint64) + p[begin].astype(np.uint64) * ODD)
    names = np.concatenate([name[~sure], scatter])
    source = pa.array(np.concatenate([np.zeros(open_, np.int64), to_doc[begin]]), mask=~certain)
    to_start = np.concatenate([np.zeros(open_, np.int64), to_place[begin]]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names.view(np.int64)),
            ids.take(pa.array(all_doc)),
            pa.array(text_keys[all_doc]),
            pa.array(all_start.astype(np.int32)),
            pa.array(all_end.astype(np.int32)),
            pa.array(certain),
            ids.take(source),
            batch.column("_text_key").take(source),
            pa.array(to_start, mask=~certain),
        ],
        names=["name", "doc_id", "_text_key", "start", "end", "sure", "to_id", "to_key", "to_start"],
    )


def _verified(words: list[bytes], spans: pa.ListScalar) -> Iterator[tuple[int, int]]:
    """The longest stretches whose claims hold, from spans sorted by run and start."""
    last, low, high = None, 0, 0
    for run, start, end, digest in zip(*(spans.values.field(i).to_pylist() for i in range(4))):
        if _digest(words, start, end) != digest:
            continue
        if run == last and start <= high:
            high = max(high, end)
            continue
        yield low, high
        last, low, high = run, start, end
    yield low, high


def without_repeats(
    docs: DataFrame, workspace: Workspace | None = None, size: int = WINDOW, rounds: int = ROUNDS,
    name_bits: int = NAME_BITS,
) -> DataFrame:
    """(doc_id, n_words, n_removed, text): the words that are left, joined by one space.

    Only texts that may lose words are shuffled to meet their spans.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    rows = _texts(docs)
    claimed = workspace.store("claims", claims(docs, size, rounds, name_bits))
    found = workspace.store("spans", with_digests(docs, claimed))
    whole = maybe_among(rows, found, "_text_key", "left_anti").select(
        "doc_id", "text", F.lit(None).cast(found.schema["spans"].dataType).alias("spans")
    )
    some = maybe_among(rows, found, "_text_key")
    same = some["doc_id"].eqNullSafe(found["doc_id"]) & (some["_text_key"] == found["_text_key"])
    joined = some.join(found, same, "left").select(some["doc_id"], some["text"], "spans")
    joined = joined.unionByName(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                words = _words(text)
                counts.append(len(words))
                left = words
                if spans.is_valid:
                    keep = np.ones(len(words), bool)
                    for start, end in _verified(words, spans):
                        if end - start >= size:
                            keep[start:end] = False
                    left = [word for word, stays in zip(words, keep.tolist()) if stays]
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n_words", "n_removed", "text"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, text string")


def op5_substring_dedup(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )
