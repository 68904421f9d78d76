"""Chat formatting with a loss mask aligned by offsets.

A conversation is rendered whole, encoded once with the character offsets of its tokens, and the
spans of the assistant's texts, which are sorted, are found for each token by binary search. A
token that reaches over the end of a span counts with the part inside.

Control strings inside texts are escaped by one backslash more after their first character, which
`unescape` takes back, so no text can end a turn or open another.

Defined results: rows are ordered by turn, NULL first, then role and text; a NULL text or role is
empty; a NULL conv_id is a conversation of its own; repeated rows are repeated turns; extra
columns are ignored. A conversation is one row of the output and must fit a task, as a text does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.bpe import default_vocabulary
from salesmart.llm.common import with_columns

# The template's own marks, and other strings that chat templates use as controls.
BEGIN, END = "<|turn|>", "<|end|>\n"
CONTROLS = [
    "<|turn|>", "<|end|>", "<|endoftext|>", "<|im_start|>", "<|im_end|>",
    "<s>", "</s>", "[INST]", "[/INST]",
]
LOSS_ROLE = "assistant"

# The first character of a control, backslashes, its rest.
_CONTROL = re.compile("|".join(f"(?:{re.escape(c[0])}\\\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"(?:{re.escape(c[0])}\\\\+{re.escape(c[1:])})" for c in CONTROLS))

ROW = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}

FORMATTED = (
    "conv_id bigint, formatted string, ids array<int>, "
    "token_starts array<int>, token_ends array<int>, loss array<boolean>, "
    "loss_starts array<int>, loss_ends array<int>"
)
READ_BACK = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)

#: Conversations that a task encodes at a time.
BLOCK_ROWS = 256


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[0][0]}{m[0][2:]}", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"


def _read_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts that the loss is taken on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = BEGIN + _role_line(role), escape(text)
        start = at + len(head)
        if role == LOSS_ROLE and body:
            spans.append((start, start + len(body)))
        parts += [head, body, END]
        at = start + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(BEGIN)[1:]:
        role, _, body = part.partition("\n")
        turns.append((_read_role(role), unescape(body[: -len(END)])))
    return turns


def mask(
    starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether it meets a span, and the part of it that lies inside."""
    if not spans:
        return np.zeros(len(starts), bool), starts, starts
    begin, end = np.array(spans, np.int64).T
    nearest = np.minimum(np.searchsorted(end, starts, side="right"), len(spans) - 1)
    low, high = np.maximum(starts, begin[nearest]), np.minimum(ends, end[nearest])
    return low < high, low, high


def merge(low: list[int], high: list[int]) -> list[tuple[int, int]]:
    """Union of sorted spans; tokens of one character share its span."""
    spans: list[tuple[int, int]] = []
    for a, b in zip(low, high):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True  # a special string in a text is ordinary text
    return tokenizer


def _format_row(turns: list[dict], encoding) -> tuple:
    formatted, spans, encoded = turns, encoding[1], encoding[0]
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    on, low, high = mask(offsets[:, 0], offsets[:, 1], spans)
    return formatted, encoded.ids, offsets[:, 0], offsets[:, 1], on, low[on], high[on]


def formatted(conversations: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per conversation: the formatted text, its tokens with offsets, the mask per token
    (``loss``), and for the tokens under the mask the characters that count."""
    path = vocabulary_path or default_vocabulary()
    rows = with_columns(conversations, ROW)
    empty = F.lit("")
    turns = F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )))
    grouped = rows.groupBy("conv_id").agg(turns.alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(start, BLOCK_ROWS)
                rendered = [
                    render([(turn["role"], turn["text"]) for turn in turns])
                    for turns in block.column("turns").to_pylist()
                ]
                encodings = tokenizer.encode_batch(
                    [text for text, _ in rendered], add_special_tokens=False
                )
                out = [
                    _format_row(text, (encoding, spans))
                    for (text, spans), encoding in zip(rendered, encodings)
                ]
                kinds = [pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_()),
                         *[pa.list_(pa.int32())] * 2]
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
                names = [field.split()[0] for field in FORMATTED.split(", ")]
                yield pa.RecordBatch.from_arrays([block.column("conv_id"), *columns], names=names)

    return grouped.mapInArrow(run, FORMATTED)


def read_back(rows: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the mask, read from formatted conversations."""

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in READ_BACK.split(", ")]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, turns = row["formatted"], read_turns(row["formatted"])
                spans = merge(row["loss_starts"], row["loss_ends"])
                loss = "".join(unescape(text[a:b]) for a, b in spans)
                listed = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((row["conv_id"], len(turns), digest(listed), len(loss), digest(loss),
                            len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)] if out else [
                pa.array([], kind) for kind in kinds
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    needed = rows.select("conv_id", "formatted", "loss_starts", "loss_ends")
    return needed.mapInArrow(run, READ_BACK)


def op4_chat(spark, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, LOSS_ROLE, said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    stored = with_columns(spark.read.parquet(f"{folder}/conversations.parquet"), ROW)
    return read_back(formatted(stored.unionByName(extra)))
