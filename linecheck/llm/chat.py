"""Conversations as tokens under a chat template.

Every turn becomes the id of the opening mark, the tokens of its role, of a line end, of its
text, the id of the closing mark and the tokens of a line end. The pieces are encoded
separately and the reserved ids are put between them, so no text can ever become a mark.
Strings that look like marks are also escaped inside texts: ``<|`` gets a backslash after
its first character, and one more if there are some already. Offsets of turns and the loss
mask are running sums of the lengths of pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecheck.llm.bpe import Merges, Tokenizer

# The marks, whose ids follow those of the vocabulary, and the role that is learned.
MARKS = ("<|im_start|>", "<|im_end|>")
LEARNED = "assistant"

_LOOKS = regex.compile(r"<(\\*)\|")
_ESCAPED = regex.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """The text without any ``<|``; ``unescape`` gives it back."""
    return _LOOKS.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def assembled(merges: Merges, size: int, roles: list[str], texts: list[str]) -> Iterator[tuple[bytes, int, int, int]]:
    """Per turn: ids, number of ids, first and last place of the loss mask."""
    escaped = [escape(role) for role in roles], [escape(text) for text in texts]
    heads, bodies = merges.encode(escaped[0]), merges.encode(escaped[1])
    line = merges.encode(["\n"])[0]
    opens, closes = (np.array([size + i], "<u4").tobytes() for i in range(2))
    for head, body, plain in zip(heads, bodies, roles, strict=True):
        pieces = (opens, head, line, body, closes, line)
        ends = np.cumsum([len(piece) // 4 for piece in pieces])
        start, end = (int(ends[2]), int(ends[4])) if plain == LEARNED else (0, 0)
        yield b"".join(pieces), int(ends[-1]), start, end


def turns(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Every row of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``) as tokens.

    The loss mask of a turn of the assistant covers its text and the closing mark, from
    ``loss_start`` up to ``loss_end`` within the turn. Missing roles and texts are empty;
    other columns are left out. No rows give no rows.
    """
    this, size = tokenizer.task_side(), tokenizer.size

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with this.merges() as merges:
            for batch in batches:
                conv, turn, role, text = batch.columns
                roles, texts = role.to_pylist(), text.to_pylist()
                made = list(assembled(merges, size, roles, texts)) if roles else []
                columns = list(zip(*made, strict=True)) if made else [[]] * 4
                kinds = (pa.binary(), *[pa.int64()] * 3)
                yield pa.RecordBatch.from_arrays(
                    [conv, turn, role, text, *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                    ["conv_id", "turn", "role", "text", "ids", "n_tokens", "loss_start", "loss_end"],
                )

    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "conv_id long, turn long, role string, text string, ids binary, n_tokens long, loss_start long, loss_end long"
    return plain.mapInArrow(formatted, schema)


def placed(rows: DataFrame) -> DataFrame:
    """Turns with ``offset``, where they begin in their conversation, by a running sum of lengths.

    The loss mask then covers ``offset + loss_start`` up to ``offset + loss_end``. Turns of
    one conversation with the same number, missing ones first, go by role and text; rows
    that repeat are turns of their own; rows without ``conv_id`` are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))


class Reader:
    """Reads the tokens of one conversation back, turn after turn, from ids and mask alone."""

    def __init__(self, names: dict[int, bytes], size: int):
        self.names, self.size = names, size
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.n_loss = self.n_chars = self.next = 0

    def add(self, ids: bytes, offset: int, loss_start: int, loss_end: int) -> None:
        if offset != self.next:
            raise ValueError(f"a turn begins at {offset}, but the one before ends at {self.next}")
        tokens = np.frombuffer(ids, "<u4")
        self.next += len(tokens)
        pieces = list(map(self.names.__getitem__, tokens.tolist()))
        self.n_chars += len(_text(pieces))
        opens, closes = np.flatnonzero(tokens == self.size), np.flatnonzero(tokens == self.size + 1)
        for a, b in zip(opens.tolist(), closes.tolist(), strict=True):
            role, _, text = _text(pieces[a + 1 : b]).partition("\n")
            self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            self.n_turns += 1
        if loss_end > loss_start:
            plain = (tokens[loss_start:loss_end] < self.size).tolist()
            text = unescape(_text(compress(pieces[loss_start:loss_end], plain)))
            self.loss.update(text.encode())
            self.n_loss += len(text)


def _text(pieces: Iterable[bytes]) -> str:
    return b"".join(pieces).decode("utf-8", "surrogatepass")


def read_back(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """One row per conversation of ``turns``: what its tokens and mask hold, ``formatted_chars`` with the marks.

    A conversation's turns stream through one task in order, as the digest of the whole
    asks for; none is held longer than its batch.
    """
    this, size = tokenizer.task_side(), tokenizer.size
    result = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
            ("n_tokens", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = this.merges().tokens | {size + i: mark.encode() for i, mark in enumerate(MARKS)}
        now, reader = None, None
        done: list[tuple] = []

        def summary() -> tuple:
            return (now, reader.n_turns, reader.turns.hexdigest(), reader.n_loss, reader.loss.hexdigest(), reader.n_chars, reader.next)

        for batch in batches:
            for conv, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or conv != now:
                    if reader is not None:
                        done.append(summary())
                    now, reader = conv, Reader(names, size)
                reader.add(*turn)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), result.types, strict=True)], schema=result)
                done = []
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(summary(), result.types, strict=True)], schema=result)

    columns = ("conv_id", "ids", "offset", "loss_start", "loss_end")
    # The running sum has dealt the rows by conversation.
    dealt = placed(rows).select(*columns).sortWithinPartitions("conv_id", "offset")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
    return dealt.mapInArrow(read, schema)
