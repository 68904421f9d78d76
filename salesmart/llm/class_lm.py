"""Scoring by a Brown class-based bigram model.

Words are counted over the training documents. The most frequent ones, the vocabulary, are dealt
to classes by exchange clustering: every round each word of one half moves to the class that gains
most mutual information between neighbouring classes. Every other word then goes to the class with
the same gain against these, from its neighbours in all training documents. The end of a text has a
class of its own and also stands before a text. A text's probability is the product of the class
transitions, smoothed by interpolation with the classes' frequencies, and the emissions of its
words, by relative frequency in their class. A word never seen has a class of its own, as likely as
half an occurrence after any other. It adds up to one over all texts.

Counts and classes of the words grow with the corpus and stay a table; what is broadcast has a fixed
bound: those of at most `FREQUENT` words, the first by count and then by hash. Texts are read once
and stored in blocks of documents, in which each distinct word stands once and tokens are places
among these, packed; counts, neighbours and classes are taken from the blocks. A task sums up the
neighbours of several blocks, a row per word, before they are moved, once. For its other words a block
asks by a join, once for each, and the answers come back to it; the documents with all their classes
are then stored, and both the transitions and the scores are read off them.

Defined results: a NULL text is empty, its only token is the end; a NULL doc_id counts as training;
repeated rows are scored each; extra columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import (
    by_weight,
    flat,
    gather,
    lists,
    or_empty,
    with_columns,
    word_hashes,
)
from salesmart.workspace import Workspace

#: Most words whose counts are broadcast: 4 MB. And most words that are clustered.
FREQUENT, VOCABULARY = 2**18, 2**13

#: Classes of the vocabulary, rounds of exchange.
CLASSES, ROUNDS = 64, 8

#: Weight of the classes' frequencies in the transitions, as a number of occurrences.
SMOOTHING = 20.0

#: Words that a task works on at a time, but for a longer single text.
BLOCK_WORDS = 400_000

#: Neighbours of words that a task sums up before it passes them on.
SUMMED = 1_000_000

#: Bins of the histogram by which thresholds are found, per doubling of the count.
BINS = 8

DOCUMENT = {"doc_id": "bigint", "text": "string"}


def lowered(text: Column) -> Column:
    """A-Z in lower case, no other letter changed."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and word hashes of every document."""
    rows = with_columns(docs, DOCUMENT).withColumn("text", or_empty(F.col("text")))
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0))
    return rows.select(
        "doc_id", (fold == 1).alias("held_out"),
        word_hashes(lowered(F.col("text"))).alias("words"),
    )


def packed(values: np.ndarray) -> bytes:
    """Numbers of 32 bits, compressed: their number, then all first bytes, all second ones and so on."""
    parts = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(parts.tobytes(), "zstd", asbytes=True)


def unpacked(content: bytes) -> np.ndarray:
    size = int.from_bytes(content[:8], "little")
    parts = pa.decompress(content[8:], 4 * size, "zstd", asbytes=True)
    return np.frombuffer(parts, np.uint8).reshape(4, size).T.copy().view("<i4").ravel()


def binned(counts: DataFrame) -> DataFrame:
    """Adds the ``bin`` of the count ``n``."""
    return counts.withColumn("bin", F.floor(F.log2("n") * BINS).cast("int"))


def _threshold_bin(counts: DataFrame, most: int) -> int:
    """Smallest bin of the count such that at most ``most`` words lie in it or above."""
    sizes = dict(map(tuple, counts.groupBy("bin").count().collect()))  # a few hundred rows
    total = 0
    for number in sorted(sizes, reverse=True):
        total += sizes[number]
        if total > most:
            return number + 1
    return 0


def most_frequent(counts: DataFrame, most: int) -> Column:
    """Condition on the first ``most`` words by count, then by parts of the hash; a last part that
    would not fit stays out."""
    start = _threshold_bin(counts, most)
    chosen = F.col("bin") >= start
    left = most - counts.where(chosen).count()
    edge = counts.where(F.col("bin") < start)
    last = edge.agg(F.max("bin")).first()[0]
    if last is None:
        return chosen
    edge = edge.where(F.col("bin") == last)
    sizes = dict(map(tuple, edge.groupBy("n").count().collect()))  # counts within a bin
    for n in sorted(sizes, reverse=True):
        if sizes[n] > left:
            break
        left -= sizes[n]
    part = F.shiftrightunsigned("word", 48)  # 65,536 parts
    parts = dict(map(tuple, edge.where(F.col("n") == n).groupBy(part).count().collect()))
    until = 0
    for until in sorted(parts):
        left -= parts[until]
        if left < 0:
            break
    tied = (F.col("n") == n) & (part < until)
    return chosen | ((F.col("bin") == last) & ((F.col("n") > n) | tied))


class Words:
    """Frequent words by hash: their count, their number in the vocabulary and their class."""

    def __init__(self, counts: DataFrame, frequent: Column, vocabulary: Column):
        clustered = vocabulary.alias("clustered")
        rows = counts.where(frequent).select("word", "n", clustered).toArrow()
        order = np.argsort(rows.column("word").to_numpy())
        self.hash = rows.column("word").to_numpy()[order]
        self.count = rows.column("n").to_numpy()[order]
        known = rows.column("clustered").to_numpy()[order].astype(bool)
        self.size = int(known.sum())
        self.rest, self.end = self.size, self.size + 1  # numbers of the shared class and the end
        self.number = np.full(len(order), self.rest, np.int32)
        # Numbers by falling count, so that the first classes are dealt alike in every run.
        rank = np.lexsort((self.hash[known], -self.count[known]))
        self.number[np.flatnonzero(known)[rank]] = np.arange(self.size)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the frequent words, and whether the word is there."""
        if not len(self.hash):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        place = np.minimum(np.searchsorted(self.hash, words), len(self.hash) - 1)
        return place, self.hash[place] == words


BLOCK = ("block bigint, doc_id array<bigint>, held_out array<boolean>, offsets array<int>, "
         "codes binary, word array<bigint>, n array<bigint>")


def blocked(rows: DataFrame) -> DataFrame:
    """Documents in blocks of about `BLOCK_WORDS` words, a row each. A block holds each of its distinct
    words once, the most frequent first, with its count in training documents; ``codes`` are the
    places of the tokens there, `packed`."""
    names = [part.split()[0] for part in BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in by_weight(batches, "words", BLOCK_WORDS):
            hashes, offsets = flat(batch.column("words"))
            word, codes, often = np.unique(hashes, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")  # small codes take fewer bytes
            word, codes = word[order], np.argsort(order)[codes]
            held = batch.column("held_out")
            training = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets))
            n = np.bincount(codes[training], minlength=len(word)).astype(np.int64)
            doc_id, held, offsets, word, n = [
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                for x in (batch.column("doc_id"), held, *map(pa.array, (offsets.astype(np.int32), word, n)))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), doc_id, held, offsets, pa.array([packed(codes)]), word, n], names=names)
            number += 1

    return rows.select("doc_id", "held_out", "words").mapInArrow(run, BLOCK)


#: Columns of a block that `Block` reads.
TRAINING = ["held_out", "offsets", "codes", "word"]


class Block:
    """A row of `blocked`: all documents or only those for training."""

    def __init__(self, rows, row: int, training: bool = False):
        def values(name: str) -> np.ndarray:
            return rows.column(name)[row].values.to_numpy(zero_copy_only=False)

        self.word, self.codes = values("word"), unpacked(rows.column("codes")[row].as_py())
        self.offsets = values("offsets").astype(np.int64)
        if training:
            chosen = np.flatnonzero(~values("held_out").astype(bool))
            self.codes, self.offsets = gather(self.codes, self.offsets, chosen)

    def neighbours(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each token and of the one before; a text is followed by its end token."""
        place, there = words.find(self.word)
        number = np.full(len(self.word), words.rest, np.int32)
        number[there] = words.number[place[there]]
        current = np.insert(number[self.codes], self.offsets[1:], words.end)
        before = np.roll(current, 1)  # the end of the text before stands for the beginning
        return before, current


def training_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Block(batch, row, training=True)


def bigrams(blocks: DataFrame, words) -> DataFrame:
    """(a, b, n): how often vocabulary number b follows a in the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        width = known.size + 2
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def add(code, n):
            every, place = np.unique(np.concatenate([codes, code]), return_inverse=True)
            return every, np.bincount(place, np.concatenate([counts, n])).astype(np.int64)

        for block in training_blocks(batches):
            before, current = block.neighbours(known)
            codes, counts = add(*np.unique(before * np.int64(width) + current, return_counts=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array((codes // width).astype(np.int32)),
             pa.array((codes % width).astype(np.int32)), pa.array(counts)],
            names=["a", "b", "n"],
        )

    counted = blocks.select(*TRAINING).mapInArrow(run, "a int, b int, n bigint")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_classes(
    right: np.ndarray, left: np.ndarray, own: np.ndarray, table: np.ndarray, classes: int
) -> np.ndarray:
    """The class among the first ``classes`` in which each word gains most.

    ``right`` and ``left`` count the classes after and before each word, ``own`` is its class,
    ``table`` counts the transitions. The objective is the sum of x log x over the table, less
    that over the sums of its rows and columns.
    """
    result = np.empty(len(own), np.int64)
    for i, now in enumerate(own):
        r, l = right[i], left[i]
        rest = table.copy()  # without the word
        rest[now] -= r
        rest[:, now] -= l
        np.maximum(rest, 0, out=rest)
        rows, columns = rest.sum(axis=1)[:classes], rest.sum(axis=0)[:classes]
        out, into = rest[:classes], rest[:, :classes]
        gain = (_xlogx(out + r) - _xlogx(out)).sum(axis=1)
        gain += (_xlogx(into + l[:, None]) - _xlogx(into)).sum(axis=0)
        gain -= _xlogx(rows + r.sum()) - _xlogx(rows) + _xlogx(columns + l.sum()) - _xlogx(columns)
        best = int(np.argmax(gain))
        result[i] = best if gain[best] > gain[now] + 1e-9 else now
    return result


def cluster(pairs: DataFrame, size: int, classes: int, rounds: int) -> np.ndarray:
    """Class of each vocabulary number by exchange; then the shared class and the end.

    A round is a Spark job over the bigrams; the driver holds the classes only.
    """
    spark = pairs.sparkSession
    assigned = np.append(np.arange(size) % classes, [classes, classes + 1])
    width, best, best_value = classes + 2, assigned, -np.inf

    def classed() -> DataFrame:
        """Bigrams with the classes of both words."""
        numbers = spark.createDataFrame(
            [(i, int(c)) for i, c in enumerate(assigned)], "w int, c int"
        )
        first = F.broadcast(numbers.select(F.col("w").alias("a"), F.col("c").alias("ca")))
        second = F.broadcast(numbers.select(F.col("w").alias("b"), F.col("c").alias("cb")))
        return pairs.join(first, "a").join(second, "b")

    for number in range(rounds + 1):
        rows = classed()
        table = np.zeros((width, width))
        for ca, cb, n in rows.groupBy("ca", "cb").agg(F.sum("n")).collect():
            table[ca, cb] = n
        value = _xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum()
        if value > best_value:
            best, best_value = assigned, value
        if number == rounds:
            return best
        sides = F.explode(F.array(
            F.struct(F.col("a").alias("w"), F.col("cb").alias("c"), F.lit(0).alias("side")),
            F.struct(F.col("b").alias("w"), F.col("ca").alias("c"), F.lit(1).alias("side")),
        )).alias("s")
        half = (F.col("w") < size) & (F.pmod(F.xxhash64("w"), F.lit(2)) == number % 2)
        per_word = rows.select(sides, "n").select("s.*", "n").where(half).groupBy(
            "w", "c", "side").agg(F.sum("n").alias("n"))
        per_word = per_word.groupBy("w").agg(
            F.collect_list(F.col("side") * width + F.col("c")).alias("at"),
            F.collect_list("n").alias("n"),
        )
        now = assigned

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts = np.zeros((batch.num_rows, 2 * width))
                at, offsets = flat(batch.column("at"))
                row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
                counts[row, at] = flat(batch.column("n"))[0]
                w = batch.column("w").to_numpy()
                chosen = best_classes(
                    counts[:, :width], counts[:, width:], now[w], table, classes
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("w"), pa.array(chosen, pa.int32())], names=["w", "c"]
                )

        moves = per_word.mapInArrow(run, "w int, c int").collect()  # one per vocabulary word
        assigned = assigned.copy()
        for w, c in moves:
            assigned[w] = c
    return best


def gains(
    word: np.ndarray, at: np.ndarray, n: np.ndarray, table: np.ndarray, classes: int, size: int
) -> np.ndarray:
    """What each of ``size`` words of the shared class gains in each class, as in `best_classes`.

    ``n`` counts the class ``at`` after a word, or before it from the table's width on; ``word``
    is sorted.
    """
    width = len(table)
    counts = np.zeros((size, 2 * width))
    counts[word, at] = n
    right, left = counts[:, :width], counts[:, width:]
    beside = np.concatenate([table.T, table])[at][:, :classes]  # of each class with the neighbour
    for side, other in ((classes, left), (width + classes, right)):
        shared = np.flatnonzero(at == side)  # without the word itself
        beside[shared] -= other[word[shared], :classes]
    np.maximum(beside, 0, out=beside)
    more = _xlogx(beside + n[:, None]) - _xlogx(beside)
    result = np.add.reduceat(more, np.searchsorted(word, np.arange(size)), axis=0)
    for sums, own, other in ((table.sum(1), right, left), (table.sum(0), left, right)):
        without = np.maximum(sums[:classes] - other[:, :classes], 0)
        result -= _xlogx(without + own.sum(axis=1, keepdims=True)) - _xlogx(without)
    return result


def _beside(width: int) -> np.dtype:
    """What stands beside a word and how often, at most 255 times; several of a kind add up."""
    return np.dtype([("at", "u1" if width <= 256 else "<u4"), ("n", "u1")])


class Sums:
    """Counts of what stands beside words, from several blocks."""

    def __init__(self, width: int):
        self.width, self.parts, self.size = width, [], 0

    def add(self, word: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((word, at, n))
        self.size += len(word)

    def rows(self) -> pa.RecordBatch:
        """(word, beside), a row per word, and starts anew."""
        word, at, n = map(np.concatenate, zip(*self.parts))
        self.parts, self.size = [], 0
        word, place = np.unique(word, return_inverse=True)
        code, place = np.unique(place * self.width + at, return_inverse=True)
        n = np.bincount(place, n, len(code)).astype(np.int64)
        times = (n + 254) // 255
        code, last = np.repeat(code, times), np.cumsum(times) - 1
        beside = np.empty(len(code), _beside(self.width))
        beside["at"], beside["n"] = code % self.width, 255
        beside["n"][last] = n - 255 * (times - 1)
        ends = np.searchsorted(code // self.width, np.arange(len(word) + 1)) * beside.itemsize
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(beside.tobytes())]
        return pa.RecordBatch.from_arrays(
            [pa.array(word, pa.int64()), pa.Array.from_buffers(pa.binary(), len(word), buffers)],
            names=["word", "beside"])


def summed_up(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and a row of counts for each, out of rows of `Sums` that are sorted by word."""
    word, counts, kind = np.zeros(0, np.int64), np.zeros((0, width)), _beside(width)
    for batch in by_weight(batches, "beside", BLOCK_WORDS // 10):
        content = batch.column("beside").to_pylist()
        sizes = np.fromiter(map(len, content), np.int64, len(content)) // kind.itemsize
        beside = np.frombuffer(b"".join(content), kind)
        more = np.repeat(batch.column("word").to_numpy(), sizes)
        held = np.flatnonzero(counts)  # the last word of the rows before may go on in these
        word, place = np.unique(np.concatenate([word[held // width], more]), return_inverse=True)
        code = place * width + np.concatenate([held % width, beside["at"]])
        n = np.concatenate([counts.ravel()[held], beside["n"]])
        counts = np.bincount(code, n, len(word) * width).reshape(-1, width)
        if len(word) > 1:
            yield word[:-1], counts[:-1]
            word, counts = word[-1:], counts[-1:].copy()
    if len(word):
        yield word, counts


def rest_classes(blocks: DataFrame, words, assigned, table: np.ndarray, classes: int) -> DataFrame:
    """(word, n, c): the count and the class of every training word outside the vocabulary."""
    width = classes + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = words.value, Sums(2 * width)
        for block in training_blocks(batches):
            before, current = block.neighbours(known)
            rest = np.flatnonzero(current == known.rest)
            place = np.insert(block.codes, block.offsets[1:], 0)[rest].astype(np.int64)
            code = np.concatenate([
                place * 2 * width + assigned[current[rest + 1]],
                place * 2 * width + width + assigned[before[rest]],
            ])
            code, n = np.unique(code, return_counts=True)
            sums.add(block.word[code // (2 * width)], code % (2 * width), n)
            if sums.size > SUMMED:
                yield sums.rows()
        if sums.size:
            yield sums.rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for word, counts in summed_up(batches, 2 * width):
            row, at = np.nonzero(counts)
            best = gains(row, at, counts[row, at], table, classes, len(word)).argmax(axis=1)
            n = counts[:, :width].sum(axis=1).astype(np.int64)  # one token follows each
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(n), pa.array(best, pa.int32())], names=["word", "n", "c"])

    counted = blocks.select(*TRAINING).mapInArrow(count, "word bigint, beside binary")
    by_word = counted.repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(run, "word bigint, n bigint, c int")


CLASSED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
           "emission double, classes array<smallint>")


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])[offsets]
    return sums[1:] - sums[:-1]


def asked(blocks: DataFrame, words) -> DataFrame:
    """(of, number, word): the words of each block whose class is not broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in enumerate(batch.column("block").to_pylist()):
                word = batch.column("word")[row].values.to_numpy()
                rare = np.flatnonzero(~words.value.find(word)[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rare), block)), pa.array(rare), pa.array(word[rare])],
                    names=["of", "number", "word"])

    return blocks.select("block", "word").mapInArrow(run, "of bigint, number bigint, word bigint")


def placed(blocks: DataFrame, words) -> DataFrame:
    """The blocks with the places of their words among the frequent ones, -1 for those that are `asked`
    for, instead of the words."""
    kept = ["block", "doc_id", "held_out", "offsets", "codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words.value.find(word.values.to_numpy()) for word in batch.column("word")]
            places = [packed(np.where(there, place, -1)) for place, there in found]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(places, pa.binary())], names=[*kept, "places"])

    types = [part for part in BLOCK.split(", ") if part.split()[0] in kept]
    return blocks.select(*kept, "word").mapInArrow(run, ", ".join([*types, "places binary"]))


def classed(blocks: DataFrame, words, lexicon: DataFrame, classes: int, base_total: float) -> DataFrame:
    """Documents with the classes of all their words. A block asks for each of its rare words once,
    and the answers come back to the block; a word never seen has the class ``classes``."""
    answers = asked(blocks, words).join(lexicon, "word").select("of", "number", "c", "n")

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        known = words.value
        codes, place = [unpacked(rows.column(name)[0].as_py()) for name in ("codes", "places")]
        offsets = rows.column("offsets")[0].values.to_numpy().astype(np.int64)
        there = place >= 0
        c, n = np.full(len(there), classes, np.int16), np.zeros(len(there), np.int64)
        c[there], n[there] = known.cls[place[there]], known.count[place[there]]
        at = found.column("number").to_numpy()
        c[at], n[at] = found.column("c").to_numpy(), found.column("n").to_numpy()

        def summed(values: np.ndarray) -> np.ndarray:
            return _per_text(values[codes], offsets)

        return pa.table([
            rows.column("doc_id")[0].values, rows.column("held_out")[0].values,
            pa.array(np.diff(offsets) + 1), summed((n > 0).astype(np.int64)),
            summed(np.log10((n + 0.5) / base_total)), summed(np.log10(np.maximum(n, 1))),
            lists(c[codes], offsets),
        ], names=[part.split()[0] for part in CLASSED.split(", ")])

    return placed(blocks, words).groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(run, CLASSED)


def _steps(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each token and of the one before, end tokens included, and where texts begin."""
    classes, offsets = flat(column)
    current = np.insert(classes.astype(np.int64), offsets[1:], end)
    before = np.roll(current, 1)  # the end of the text before stands for the beginning
    return before, current, offsets + np.arange(len(offsets))


def transitions(training: DataFrame, classes: int) -> np.ndarray:
    """How often a class follows another in the classed training documents."""
    width = classes + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width * width, np.int64)
        for batch in by_weight(batches, "classes", BLOCK_WORDS):
            before, current, _ = _steps(batch.column("classes"), classes + 1)
            counts += np.bincount(before * width + current, minlength=width * width)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array((found // width).astype(np.int32)), pa.array((found % width).astype(np.int32)),
             pa.array(counts[found])], names=["ca", "cb", "n"])

    rows = training.select("classes").mapInArrow(run, "ca int, cb int, n bigint")
    table = np.zeros((width, width))
    for ca, cb, n in rows.groupBy("ca", "cb").agg(F.sum("n")).collect():
        table[ca, cb] = n
    return table


class Model:
    """Logarithms that score a token: transitions, and how often its class is seen."""

    def __init__(self, table: np.ndarray, base_total: float):
        classes = table.shape[0]
        never = classes - 2
        seen = table.sum(axis=0)
        usual = (seen + 1) / (seen.sum() + classes)
        chance = (table + SMOOTHING * usual) / (table.sum(axis=1, keepdims=True) + SMOOTHING)
        unseen = min(0.5 / base_total, 0.5)
        chance *= (1 - unseen) / (1 - chance[:, never:never + 1])
        chance[:, never] = unseen
        self.transition = np.log10(chance)
        self.seen = np.log10(np.maximum(seen, 1))
        self.seen[never:] = 0  # a word never seen and the end have a class of their own
        self.end = classes - 1


def scored(documents: DataFrame, model) -> DataFrame:
    """The score of each of the `classed` documents."""
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
              "score double")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in by_weight(batches, "classes", BLOCK_WORDS):
            before, current, begins = _steps(batch.column("classes"), m.end)
            steps = _per_text(m.transition[before, current] - m.seen[current], begins)
            score = pa.array(batch.column("emission").to_numpy() + steps)
            kept = [batch.column(name) for name in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, score], names=names)

    return documents.mapInArrow(run, schema)


def scores(
    docs: DataFrame, workspace: Workspace, frequent: int = FREQUENT, vocabulary: int = VOCABULARY,
    classes: int = CLASSES, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (a
    word's own frequency) and score (the class model), both as log10 of the probability."""
    spark = docs.sparkSession.sparkContext
    rows = prepared(docs)
    blocks = workspace.store("blocks", blocked(rows))
    found = blocks.select(F.explode(F.arrays_zip("word", "n")).alias("w")).select("w.word", "w.n")
    counts = found.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    counts = workspace.store("counts", binned(counts))
    texts = F.sum(F.size(F.filter("held_out", lambda held: ~held)))
    texts = blocks.agg(F.coalesce(texts, F.lit(0))).first()[0]
    sure = most_frequent(counts, frequent)
    known = Words(counts, sure, most_frequent(counts, min(vocabulary, frequent)))
    shared = spark.broadcast(known)
    pairs = workspace.store("bigrams", bigrams(blocks, shared))
    assigned = cluster(pairs, known.size, classes, rounds)

    numbers = docs.sparkSession.createDataFrame(
        [(i, int(c)) for i, c in enumerate(assigned)], "w int, c int"
    )
    table = np.zeros((classes + 2, classes + 2))
    by_class = pairs.join(
        F.broadcast(numbers.toDF("a", "ca")), "a"
    ).join(F.broadcast(numbers.toDF("b", "cb")), "b").groupBy("ca", "cb").agg(F.sum("n"))
    for ca, cb, n in by_class.collect():
        table[ca, cb] = n
    rest = workspace.store("rest", binned(rest_classes(blocks, shared, assigned, table, classes)))
    known.cls = np.full(len(known.hash), classes, np.int64)
    vocabulary_words = known.number < known.rest
    known.cls[vocabulary_words] = assigned[known.number[vocabulary_words]]
    # At most `frequent` of the other words have their class broadcast.
    found = rest.where(sure).select("word", "c").toArrow()
    place, there = known.find(found.column("word").to_numpy())
    known.cls[place[there]] = found.column("c").to_numpy()[there]
    lexicon = rest.where(~sure).select("word", "n", "c")
    words, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, distinct = tokens + texts, words + (texts > 0)  # with the end tokens
    base_total = total + 0.5 * (distinct + 1)
    base_end, end_known = float(np.log10((texts + 0.5) / base_total)), int(texts > 0)
    documents = workspace.store(
        "classed", classed(blocks, spark.broadcast(known), lexicon, classes, base_total))
    model = Model(transitions(documents.where("NOT held_out"), classes), base_total)
    return scored(documents, spark.broadcast(model)).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + end_known).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + base_end).alias("base_score"), "score",
    )


def op6_class_lm(spark, folder: str) -> DataFrame:
    return scores(spark.read.parquet(f"{folder}/documents.parquet"), Workspace(spark))
