"""BPE encoding and decoding by traversal of a trie of distinct words.

A text is cut into pre-tokens ("words") by the pattern of the tokenizer. The distinct words of a
block of rows form a trie over their bytes, walked depth first in sorted order. The state of a
node is the last token of the encoding of the prefix it stands for, so the encoding of a prefix is
that of a shorter prefix plus one token, and shared prefixes are computed once. A token may follow
another only if merging both from their bytes gives back these two; exactly one token that ends a
prefix fits that way. Words are kept in a cache of bounded size between blocks.

Python sees only the distinct stretches between spaces of a block; the tokens of all places are
gathered from a table of these, and the bytes of all tokens from a table of the vocabulary.
Rows are encoded where they are: nothing is shuffled, and a task holds one block of rows.

Defined results: a NULL text is an empty text and has no tokens; all other columns are kept,
whatever their names, but for one that has the name of the result. A vocabulary file whose added
tokens ask for stripping or whole words, or that has another cut or a normalizer, is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import by_weight, flat, gather, lists, or_empty, quoted, with_columns

#: Bytes of text that a task works on at a time, but for a longer single text.
BLOCK_BYTES = 4_000_000

#: Words whose encoding a worker remembers between blocks: about 50 MB.
CACHED_WORDS = 250_000

#: Steps and neighbours that a worker remembers between blocks: about 50 MB.
REMEMBERED = 400_000

# Fixed value: the pattern that cuts a text before the merges, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary file writes each byte: printable bytes stand
    for themselves, the others follow from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    letters = {chr(byte): byte for byte in printable}
    return letters | {chr(256 + n): byte for n, byte in enumerate(others)}


def _closed(word: str) -> bool:
    """Whether a space after ``word`` begins another word: it ends in something visible."""
    return word != "" and word[-1] != " " and word[-1].isprintable()


def spaced(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct stretches of the texts, the number of the stretch at each place, and at which place
    each text begins.

    A stretch is white space with the word after it. Texts are cut before a space that follows
    something visible: no token of the vocabularies used here goes across such a place.
    """
    split = pc.split_pattern(texts, " ")
    offsets = split.offsets.to_numpy()
    coded = split.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    first = np.zeros(len(codes), bool)
    first[offsets[:-1]] = True  # no text is without a part, an empty one has an empty part
    closed = np.fromiter(map(_closed, words), bool, count=len(words))
    head = first.copy()
    head[1:] |= closed[codes[:-1]]
    starts = np.flatnonzero(head)
    sizes = np.diff(starts, append=len(codes))
    key = codes[starts].astype(np.int64) * 2 + ~first[starts]
    alone = sizes == 1
    used = np.zeros(2 * len(words), bool)
    used[key[alone]] = True
    number = np.cumsum(used) - 1
    units = [" " * (k & 1) + words[k >> 1] for k in np.flatnonzero(used).tolist()]
    places = np.empty(len(starts), np.int64)
    places[alone] = number[key[alone]]
    if not alone.all():  # several spaces, or white space before one
        longer: dict[str, int] = {}
        for at in np.flatnonzero(~alone).tolist():
            parts = codes[starts[at]:starts[at] + sizes[at]].tolist()
            unit = " " * int(key[at] & 1) + " ".join([words[c] for c in parts])
            places[at] = longer.setdefault(unit, len(units) + len(longer))
        units += longer
    begins = np.concatenate([[0], np.cumsum(head)])[offsets]
    return units, places, begins


def _one_word(unit: str) -> bool:
    """Whether the pattern surely leaves ``unit`` whole: letters, after a space or not."""
    return unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha())


def _check(data: dict) -> None:
    """Refuse a vocabulary file that asks for more than this module does."""
    odd = [t["content"] for t in data["added_tokens"]
           if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"]]
    if odd:
        raise ValueError(f"added tokens with stripping, whole words or spaces: {odd}")
    cut = data.get("pre_tokenizer") or {}
    if data.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
        raise ValueError("only byte-level vocabularies without normalizer and prefix are read")


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str, added: bool = True):
        import regex

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        _check(data)
        letters = _byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        model = data["model"]
        self.ids = {raw(token): number for token, number in model["vocab"].items()}
        self.bytes = {number: token for token, number in self.ids.items()}
        self.sizes = {number: len(token) for token, number in self.ids.items()}
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges, self.parts = {}, {}
        for rank, (a, b) in enumerate(merges):
            left, right, made = self.ids[raw(a)], self.ids[raw(b)], self.ids[raw(a) + raw(b)]
            self.merges[left, right] = rank
            self.parts.setdefault(made, (left, right, rank))
        self.never = len(self.merges)
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes |= {number: text.encode() for text, number in self.added.items()}
        #: Bytes of all tokens by id; the last entry stands for unknown ids.
        self.table = pa.array([self.bytes.get(n, b"") for n in range(max(self.bytes) + 2)], pa.binary())
        if not added:  # their strings in a text are ordinary text
            self.added = {}
        # States of the search for tokens that end at a place: beginnings of tokens, each with the
        # tokens that are its ends, the longest first. Both are filled as texts need them.
        self.beginnings = {token[:i] for token in self.ids for i in range(len(token) + 1)}
        self.states, self.ending = {b"": 0}, [()]
        self.names = [b""]
        self.next: dict[int, int] = {}
        self.fitting: dict[int, bool] = {}
        self.cut = regex.compile(PATTERN).findall
        marks = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.at_added = regex.compile("(" + "|".join(marks) + ")").split if marks else None
        self.words: dict[str, tuple[int, ...]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at the left (0) or right (1) end of ``token`` while it is merged from bytes,
        each with the rank of the merge that ends it."""
        edge = self.edges[side].get(token)
        if edge is None:
            made = self.parts.get(token)
            if made is None:
                edge = [(token, self.never)]
            else:
                edge = self.edge(made[side], side)
                edge = [*edge[:-1], (edge[-1][0], made[2]), (token, self.never)]
            self.edges[side][token] = edge
        return edge

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can stand after ``left`` in an encoding.

        Both are merged from bytes in the order of ranks, left before right. They stay apart
        unless the tokens that meet between them have a merge that comes before their own next.
        """
        lefts, rights, pairs = self.edge(left, 1), self.edge(right, 0), self.merges
        i = j = 0
        while True:
            (a, ends_a), (b, ends_b) = lefts[i], rights[j]
            rank = pairs.get((a, b))
            if rank is not None and rank < ends_a and rank <= ends_b:
                return False
            if ends_a <= ends_b:
                if ends_a == self.never:
                    return True
                i += 1
            else:
                j += 1

    def step(self, state: int, byte: int) -> int:
        """The longest beginning of a token that ends with ``byte`` after ``state``."""
        name = self.names[state] + bytes([byte])
        while name not in self.beginnings:
            name = name[1:]
        if name not in self.states:
            self.states[name] = len(self.names)
            self.names.append(name)
            ends = ((len(name) - i, self.ids.get(name[i:])) for i in range(len(name)))
            self.ending.append(tuple((size, token) for size, token in ends if token is not None))
        return self.states[name]

    def learn(self, words: set[str]) -> None:
        """Encode words that are not cached, sharing the work on common prefixes.

        Sorted words meet the nodes of their trie in depth-first order; ``last`` is the path
        from the root to the current node: the last token of each prefix.
        """
        last, states = [-1], [0]
        path = b""
        following, ending, fitting = self.next, self.ending, self.fitting
        if len(following) + len(fitting) > REMEMBERED:
            following.clear()
            fitting.clear()
        for data, word in sorted((word.encode(), word) for word in words):
            depth = 0
            for a, b in zip(path, data):
                if a != b:
                    break
                depth += 1
            del last[depth + 1:], states[depth + 1:]
            state = states[-1]
            for byte in data[depth:]:
                depth += 1
                key = state << 8 | byte
                state = following.get(key)
                if state is None:
                    state = following[key] = self.step(key >> 8, byte)
                states.append(state)
                for size, token in ending[state]:
                    if size == depth:
                        last.append(token)
                        break
                    key = last[depth - size] << 32 | token
                    fits = fitting.get(key)
                    if fits is None:
                        fits = fitting[key] = self.fits(key >> 32, token)
                    if fits:
                        last.append(token)
                        break
            path = data
            tokens = []
            while depth:
                tokens.append(last[depth])
                depth -= self.sizes[last[depth]]
            tokens.reverse()
            self.words[word] = tuple(tokens)

    def cut_text(self, text: str) -> list[str]:
        if self.at_added is None or not any(mark in text for mark in self.added):
            return self.cut(text)
        parts = self.at_added(text)  # every second part is an added token
        return list(chain.from_iterable(
            [part] if i % 2 else self.cut(part) for i, part in enumerate(parts)
        ))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and where each text begins."""
        units, places, begins = spaced(texts)
        ids, ends = self.encode_units(units)
        ids, offsets = gather(ids, ends, places)
        return ids, offsets[begins]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct stretches, and where each begins."""
        new = [unit for unit in units if unit not in self.words]
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words.clear()
            new = units
        words = self.words
        words |= {mark: (number,) for mark, number in self.added.items()}
        cut = {unit: self.cut_text(unit) for unit in new if not _one_word(unit)}
        wanted = {unit for unit in new if unit not in cut}.union(*cut.values())
        self.learn(wanted.difference(words))
        rows = [
            words[unit] if unit not in cut else tuple(chain.from_iterable([words[w] for w in cut[unit]]))
            for unit in units
        ]
        ends = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, rows), np.int64, count=len(rows)), out=ends[1:])
        return np.fromiter(chain.from_iterable(rows), np.int32, count=int(ends[-1])), ends

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of the token ids between the offsets."""
        unknown = len(self.table) - 1
        known = np.where((ids >= 0) & (ids < unknown), ids, unknown)
        data = self.table.take(pa.array(known, pa.int64()))
        ends = np.frombuffer(data.buffers()[1], np.int32, count=len(data) + 1)[offsets]
        buffers = [None, pa.py_buffer(np.ascontiguousarray(ends)), data.buffers()[2]]
        texts = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers)
        try:
            return texts.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


@lru_cache(maxsize=4)
def vocabulary(path: str, added: bool = True) -> Vocabulary:
    return Vocabulary(path, added)


def encode(
    docs: DataFrame, vocabulary_path: str | None = None, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of ``text`` in place of a column ``ids``."""
    path = vocabulary_path or default_vocabulary()
    kept = [name for name in docs.columns if name.lower() != ids.lower()]
    value = or_empty(docs[quoted(text)].cast("string")).alias("value")
    kind = T.ArrayType(T.IntegerType(), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in by_weight(batches, "value", BLOCK_BYTES):
            yield _made(batch, lists(*words.encode(batch.column("value"))))

    return _mapped(docs, kept, value, run, ids, kind)


def decode(
    rows: DataFrame, vocabulary_path: str | None = None, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """``rows`` with the text of the token ids in place of a column ``text``.

    Bytes that are no UTF-8 become replacement characters; unknown ids are left out.
    """
    path = vocabulary_path or default_vocabulary()
    kept = [name for name in rows.columns if name.lower() != text.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in by_weight(batches, "value", BLOCK_BYTES // 4):
            yield _made(batch, words.decode(*flat(batch.column("value"))))

    return _mapped(rows, kept, rows[quoted(ids)].alias("value"), run, text, T.StringType())


def _made(batch: pa.RecordBatch, result: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("kept"), result], names=["kept", "result"])


def _mapped(rows: DataFrame, kept: list[str], value: Column, run, name: str, kind) -> DataFrame:
    """The ``kept`` columns with the ``result`` that ``run`` makes of ``value`` as column ``name``."""
    packed = rows.select(F.struct(F.lit(0).alias("_"), *map(quoted, kept)).alias("kept"), value)
    schema = T.StructType([packed.schema["kept"], T.StructField("result", kind, False)])
    back = [F.col(f"kept.{quoted(column)}").alias(column) for column in kept]
    return packed.mapInArrow(run, schema).select(*back, F.col("result").alias(name))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with ids and decoded text."""
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_bpe(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = with_columns(docs, {"doc_id": "bigint", "text": "string"})
    return digests(decode(encode(docs).drop("text")))
