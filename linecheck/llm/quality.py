"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger holds the measurements and one bit
per failed rule; a policy is a versioned set of bits, so verdicts under any policy, and what
each rule alone would change, are bitwise operations and one small aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecheck.llm.common import SEPARATOR, as_bytes, byte_counts, free_name, window_hashes, word_hashes

# Symbols that count, and the measurements of a text.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True

# Name and failure of every rule; the place in this list is the bit. Only add at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("capitals", "n_letters > 0 and 100 * n_capitals > 60 * n_letters"),
)
BASE = ("few_words", "repeated_words")

# Policies by name and version. A published version is not changed; a new one is added.
POLICIES: Mapping[tuple[str, int], tuple[str, ...]] = {
    ("prose", 1): ("few_words", "repeated_words", "symbols"),
    ("prose", 2): ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "capitals"),
}


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the rules."""
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in set(rules))


def measured(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = word_hashes(text)
    counts = byte_counts(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    capitals = int(counts[65:91].sum())
    return (
        len(words),
        int(counts[~SEPARATOR & ~_CONTINUES].sum()),
        int(counts[_IS_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(counts[97:123].sum()) + capitals,
        capitals,
    )


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words that the text has at least twice."""
    windows = window_hashes(words, 3)
    if len(windows) < 2:
        return 0
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    rows = [measured(text.as_py() or b"") for text in texts]
    columns = np.array(rows, np.int64).reshape(len(rows), len(MEASURES))
    return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(len(MEASURES))], list(MEASURES))


def failures(of: str) -> Column:
    """The bits of the failed rules, from the struct column of measurements ``of``."""
    bits = F.lit(0).cast("long")
    for place, (_, failure) in enumerate(RULES):
        for name in MEASURES:
            failure = failure.replace(name, f"`{of}`.{name}")
        bits = bits + F.when(F.expr(failure), F.lit(1 << place)).otherwise(F.lit(0))
    return bits


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, the measurements, and ``failed``, a bit per failed rule.

    A missing or empty text has no words and fails ``few_words``. Every row is judged by
    itself, so repeated rows give repeated results, missing keys stay, and other columns of
    ``docs`` play no part.
    """
    rows = docs.select(F.col(key).alias("key"), _measures(as_bytes(F.col(text))).alias("m"))
    return rows.select(F.col("key").alias(key), "m.*", failures("m").alias("failed"))


def passes(failed: Column, policy: tuple[str, int]) -> Column:
    """Whether the policy accepts a document with these bits."""
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def accepted(docs: DataFrame, policy: tuple[str, int], text: str = "text") -> DataFrame:
    """The documents that the policy accepts, with all their columns."""
    m = free_name(docs, "measures")
    judged = docs.withColumn(m, _measures(as_bytes(F.col(text))))
    return judged.where(passes(failures(m), policy)).select(*[F.col(f"`{c}`") for c in docs.columns])


def ablations(rows: DataFrame, policy: tuple[str, int]) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it rejects, and that stay without it.

    One aggregation over the ledger; an empty ledger gives counts of 0.
    """
    whole = mask(POLICIES[policy])
    hit = F.col("failed").bitwiseAND(F.lit(whole))
    named = [rule for rule, _ in RULES if rule in POLICIES[policy]]
    counts = [F.count(F.when(hit == 0, 1)).alias("kept")]
    for rule in named:
        bit = F.lit(mask((rule,)))
        counts.append(F.count(F.when(hit.bitwiseAND(bit) != 0, 1)).alias(f"fails_{rule}"))
        counts.append(F.count(F.when(hit == bit, 1)).alias(f"only_{rule}"))
    one = rows.agg(*counts)
    lines = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(f"fails_{rule}").alias("n_failed"),
            F.col(f"only_{rule}").alias("n_only"),
            (F.col("kept") + F.col(f"only_{rule}")).alias("n_kept_without"),
        )
        for rule in named
    ]
    return one.select(F.inline(F.array(*lines)))
