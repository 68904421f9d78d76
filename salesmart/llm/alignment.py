"""Alignment of the tokens that two tokenizers make of the same texts.

Both tokenizers write a text, with a space before it, as a run of byte stretches. Places where a
token of both ends cut the text into groups. They are found by diagonal run skipping: as long as
the end arrays agree at the current index shift, windows of doubling length are compared at once,
so one-to-one stretches are jumped; where they differ, the irregular group is walked token by token
until both end at the same byte, which updates the shift. The tokens of many texts lie in one pair of
arrays; walks start in parallel at places between words, where both tokenizers have an end.
Each step of a walk is a pair of tokens that overlap, a *link*.

Spark counts, for each pair of token ids, the documents that hold it linked. A task sends one row
per distinct pair of a block of texts, however often the block holds it, and gets the counts back
the same way; the texts themselves are tokenized once and never shuffled. What a block needs of its
texts (their distinct pairs, as numbers within the block) is stored between the two steps.

Defined results: a text that is NULL, empty, or not given back byte by byte by both tokenizers has
no tokens; all its counts are 0. Repeated rows and ids count as documents of their own. Strings of
special tokens are ordinary text. Columns of the caller are kept; one that has the name of a result
gives way to it. An empty table gives an empty table. A text's written groups must stay below 2 GB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm import bpe
from salesmart.llm.common import by_weight, flat, gather, lists, or_empty, quoted, with_columns
from salesmart.workspace import Workspace

#: Bytes of text that a task aligns at a time, but for a longer single text.
BLOCK_BYTES = 4_000_000

#: Tokens that a walk of its own has to go through, about.
WALK_TOKENS = 256

#: Characters of a word from which on it does not go to the library.
LONG_WORD = 1000

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
RESULTS = [*COUNTS, "groups", "n_best", "count_sum"]


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A sentence-piece model, whose pieces have the mark of a space only in front."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(n) for n in number]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(n)
            else name.replace("▁", " ").encode()
            for n, name in zip(number, names)
        ]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("a piece goes across the start of a word")
        self.space = self.model.piece_to_id("▁")
        self.table = pa.array(self.bytes, pa.binary())

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of stretches that begin with a space, where each begins, and whether it comes back."""
        rows = self.model.encode([unit[1:] for unit in units], num_threads=1)  # it adds the space
        rows = [ids or [self.space] for ids in rows]
        ids, ends = _flattened(rows)
        made, wanted = self.table.take(pa.array(ids)), pa.array(units, pa.string())
        made_ends = np.frombuffer(made.buffers()[1], np.int32, count=len(ids) + 1)[ends]
        wanted_ends = np.frombuffer(wanted.buffers()[1], np.int32, count=len(units) + 1)
        if (made_ends == wanted_ends).all() and made.buffers()[2].equals(wanted.buffers()[2]):
            return ids, ends, np.ones(len(units), bool)
        back = [b"".join([self.bytes[n] for n in row]) == unit.encode()
                for row, unit in zip(rows, units)]
        return ids, ends, np.array(back, bool)


class RankedWords:
    """A byte-level vocabulary whose token ids are the order of its merges, by the public library.

    That one needs a deep stack for a very long word, so such words go through `bpe`.
    """

    def __init__(self, path: str):
        import tiktoken

        self.words = bpe.vocabulary(path, added=False)
        made = [self.words.bytes[a] + self.words.bytes[b] for a, b in self.words.merges]
        ranks = [self.words.ids[token] for token in made]
        self.ranked = ranks == sorted(ranks)
        encoding = tiktoken.Encoding(
            "ranked", pat_str=bpe.PATTERN, mergeable_ranks=self.words.ids, special_tokens={})
        self.encode = encoding.encode_ordinary

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.ranked:
            return self.words.encode_units(units)
        encode, long = self.encode, self.words.encode_units
        return _flattened([
            encode(unit) if len(unit) <= LONG_WORD else long([unit])[0].tolist() for unit in units
        ])


def _flattened(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, rows), np.int64, count=len(rows)), out=ends[1:])
    return np.fromiter(chain.from_iterable(rows), np.int32, count=int(ends[-1])), ends


def walk(
    a_ends: np.ndarray, b_ends: np.ndarray, a_from: np.ndarray, b_from: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links (index in a, index in b) of two rising arrays of ends, in order.

    ``a_from`` and ``b_from`` give common boundaries at which walks start, and the ends of all.
    """
    # A link of a step stands at the sum of its indices, which rises along every walk.
    path = np.full(len(a_ends) + len(b_ends), -1, np.int64)
    i, j = a_from[:-1].copy(), b_from[:-1].copy()
    a_stop, b_stop = a_from[1:], b_from[1:]
    window = np.ones(len(i), np.int64)
    live = np.flatnonzero(i < a_stop)
    while len(live):
        x, y = i[live], j[live]
        size = np.minimum(window[live], np.minimum(a_stop[live] - x, b_stop[live] - y))
        begin = np.cumsum(size) - size
        step = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
        at = np.repeat(x, size) + step
        other = at + np.repeat(y - x, size)
        differ = np.where(a_ends[at] == b_ends[other], len(path), step)
        run = np.minimum(np.minimum.reduceat(differ, begin), size)
        same = step < np.repeat(run, size)
        path[(at + other)[same]] = at[same]
        i[live] += run
        j[live] += run
        whole = run == size
        window[live] = np.where(whole, 2 * window[live], 1)
        odd = live[~whole]
        while len(odd):  # the irregular group, token by token
            x, y = i[odd], j[odd]
            path[x + y] = x
            ahead = a_ends[x] - b_ends[y]
            i[odd] += ahead <= 0
            j[odd] += ahead >= 0
            odd = odd[ahead != 0]
        live = live[i[live] < a_stop[live]]
    step = np.flatnonzero(path >= 0)
    return path[step], step - path[step]


class Aligner:
    """Two tokenizers, with tables of their tokens' sizes and written ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = RankedWords(a_path), Pieces(b_path)
        self.a_sizes = np.array([len(t) for t in self.a.words.table.to_pylist()], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b.bytes], np.int64)
        written = [f"{n}{mark}" for n in range(len(self.a_sizes)) for mark in ",|"]
        written += [f"{n}{mark}" for n in range(len(self.b_sizes)) for mark in (",", ";", "")]
        self.written = pa.array(written, pa.binary())

    def align(self, texts: pa.Array) -> Block:
        """``texts`` have a space in front; just a space stands for no text."""
        units, places, begins = bpe.spaced(texts)
        a_units, a_ends = self.a.encode_units(units)
        b_units, b_ends, back = self.b.encode_units(units)
        n = len(texts)
        good = np.add.reduceat(~back[places], begins[:-1]) == 0 if n else np.zeros(0, bool)
        good &= pc.binary_length(texts).to_numpy(zero_copy_only=False) > 1
        sizes = np.diff(begins)
        places = places[np.repeat(good, sizes)]
        begins = np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])
        a, a_at = gather(a_units, a_ends, places)
        b, b_at = gather(b_units, b_ends, places)
        walks = max(1, len(a) // WALK_TOKENS)
        starts = np.arange(walks + 1) * len(places) // walks
        links = walk(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), a_at[starts], b_at[starts])
        return Block(self, a, b, a_at[begins], b_at[begins], *links)


class Block:
    """Tokens and links of several texts."""

    def __init__(self, aligner, a, b, a_from, b_from, link_a, link_b):
        self.aligner, self.a, self.b, self.a_from, self.b_from = aligner, a, b, a_from, b_from
        self.link_a, self.link_b = link_a, link_b
        self.link_from = np.searchsorted(link_a, a_from)
        # A link closes a group if its two tokens are the last of theirs before the next link.
        last_a = np.append(link_a[1:], len(a)) != link_a
        last_b = np.append(link_b[1:], len(b)) != link_b
        self.closes = last_a & last_b

    def counts(self) -> list[pa.Array]:
        groups = np.concatenate([[0], np.cumsum(self.closes)])[self.link_from]
        return [pa.array(np.diff(x)) for x in (self.a_from, self.b_from, groups, self.link_from)]

    def groups(self) -> pa.Array:
        """The groups of each text, written ``a1,a2|b1;a3|b2,b3`` in token ids."""
        a_end, b_end = self.link_a[self.closes] + 1, self.link_b[self.closes] + 1
        a_sizes, b_sizes = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        mark = np.zeros(len(self.a), np.int64)
        mark[a_end - 1] = 1
        order[np.arange(len(self.a)) + np.repeat(b_end - b_sizes, a_sizes)] = 2 * self.a + mark
        mark = np.zeros(len(self.b), np.int64)
        mark[b_end - 1] = 1
        mark[self.b_from[1:][np.diff(self.b_from) > 0] - 1] = 2
        codes = 2 * len(self.aligner.a_sizes) + 3 * self.b.astype(np.int64) + mark
        order[np.arange(len(self.b)) + np.repeat(a_end, b_sizes)] = codes
        data = self.aligner.written.take(pa.array(order))
        ends = np.frombuffer(data.buffers()[1], np.int32, count=len(data) + 1)
        ends = np.ascontiguousarray(ends[self.a_from + self.b_from])
        buffers = [None, pa.py_buffer(ends), data.buffers()[2]]
        return pa.StringArray.from_buffers(len(ends) - 1, *buffers[1:])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
        """Distinct linked pairs of the block, the texts that hold each; and for each text its
        pairs, as steps between their rising numbers, with how often it holds each."""
        pair = self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b]
        found, number = np.unique(pair, return_inverse=True)
        n = len(self.link_from) - 1
        text = np.repeat(np.arange(n), np.diff(self.link_from))
        held, times = np.unique(text * max(len(found), 1) + number, return_counts=True)
        text, number = np.divmod(held, max(len(found), 1))
        offsets = np.searchsorted(text, np.arange(n + 1))
        steps = np.diff(number, prepend=0)
        first = offsets[:-1][np.diff(offsets) > 0]
        steps[first] = number[first]
        docs = np.bincount(number, minlength=len(found))
        return (found, docs, lists(steps.astype(np.int32), offsets),
                lists(times.astype(np.int32), offsets))


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _blocks(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """From (kept, text): a row per text, and a row per block with its distinct pairs."""
    schema = T.StructType([
        T.StructField("kept", rows.schema["kept"].dataType),
        *(T.StructField(name, T.LongType()) for name in COUNTS),
        T.StructField("groups", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("steps", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
        T.StructField("pairs", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in by_weight(batches, "text", BLOCK_BYTES):
            block = both.align(batch.column("text"))
            found, docs, steps, times = block.pairs()
            n = batch.num_rows
            columns = [batch.column("kept"), *block.counts(), block.groups(),
                       pa.array([number] * n, pa.int64()), steps, times,
                       pa.nulls(n, pa.list_(pa.int64()))]
            out = pa.RecordBatch.from_arrays(columns, names=schema.names)
            yield out
            offsets = np.array([0, len(found)])
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, field.type) for field in out.schema if field.name not in
                  ("block", "steps", "times", "pairs")),
                pa.array([number], pa.int64()), pa.nulls(1, pa.list_(pa.int32())),
                lists(docs.astype(np.int32), offsets), lists(found, offsets),
            ], names=schema.names)
            number += 1

    return rows.mapInArrow(run, schema)


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold a pair of ids linked, and whether no other pair of
    the same first id has more."""
    counts = blocks.groupBy("pair").agg(F.sum("held").alias("docs"))
    # An id has at most as many partners as the other vocabulary has tokens.
    first = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(first))


def _score(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of a block's texts."""
    at = counts.column("number").to_numpy()
    docs, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    docs[at] = counts.column("docs").to_numpy()
    best[at] = counts.column("best").to_numpy(zero_copy_only=False)
    steps, offsets = flat(texts.column("steps").combine_chunks())
    times, _ = flat(texts.column("times").combine_chunks())
    number = np.cumsum(steps, dtype=np.int64)  # rises within a text; a text starts anew
    before = np.concatenate([[0], number])[offsets]
    number -= np.repeat(before[:-1], np.diff(offsets))
    sums = [np.concatenate([[0], np.cumsum(x[number] * times)])[offsets] for x in (best, docs)]
    names = ["kept", *COUNTS, "groups"]
    columns = [*(texts.column(name) for name in names), *(pa.array(np.diff(x)) for x in sums)]
    return pa.table(columns, names=[*names, "n_best", "count_sum"])


def align(
    docs: DataFrame, space: Workspace, text: str = "text", keep: list[str] | None = None,
    groups: Callable[[Column], Column] = lambda written: written,
    a_path: str | None = None, b_path: str | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all of them) with the alignment of ``text``.

    n_a, n_b: tokens; n_groups; n_links; groups: ``groups`` of the written groups, which are several
    times as long as the text (so keep a digest if that does); n_best: links whose count no other
    link of the same first id passes; count_sum: over links, the documents that hold that pair.
    """
    names = docs.columns if keep is None else keep
    names = [name for name in names if name.lower() not in RESULTS]
    kept = F.struct(F.lit(0).alias("_"), *map(quoted, names)).alias("kept")
    spaced = F.concat(F.lit(" "), or_empty(docs[quoted(text)].cast("string"))).alias("text")
    rows = _blocks(docs.select(kept, spaced), a_path or bpe.default_vocabulary(), b_path or default_pieces())
    stored = space.store("blocks", rows.withColumn("groups", groups(F.col("groups"))))

    listed = F.posexplode(F.arrays_zip("pairs", "times")).alias("number", "held")
    pairs = stored.where("pairs IS NOT NULL").select("block", listed).select(
        "block", "number", F.col("held.pairs").alias("pair"), F.col("held.times").alias("held"))
    counts = pairs.join(link_counts(pairs), "pair").select(
        F.col("block").alias("of"), "number", "docs", "best")
    texts = stored.where("pairs IS NULL").drop("pairs")
    schema = T.StructType([
        *(field for field in texts.schema if field.name not in ("block", "steps", "times")),
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
    ])
    scored = texts.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(_score, schema)
    back = [F.col(f"kept.{quoted(name)}").alias(name) for name in names]
    return scored.select(*back, *RESULTS)


def op12_alignment(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = with_columns(docs, {"doc_id": "bigint", "text": "string"})
    found = align(docs, Workspace(spark), keep=["doc_id"],
                  groups=lambda written: F.when(written != "", F.sha2(written, 256)).otherwise(""))
    return found.withColumnRenamed("groups", "groups_sha256").select(
        "doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
