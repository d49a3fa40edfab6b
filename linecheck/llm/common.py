"""What several of these operators need: stored tables, free column names, words as hashes.

All operators take a document's text as bytes of UTF-8 and a missing text as empty. Words
are runs of bytes other than 0x20 and 0x09 to 0x0D, which never occur inside a longer UTF-8
sequence.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import linecheck
from linecheck.session import fresh_path

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Bytes of text that are hashed at once; bounds the memory a very long text takes.
PIECE = 1 << 18

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

MULTIPLIER = 0x9E3779B97F4A7C15
_VALUES = np.random.RandomState(20).randint(0, 2**62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_shipped: set[str] = set()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder; the shuffles that made it are removed.

    It survives the loss of executors, cuts the lineage and is computed once.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers that do not have it on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(linecheck.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="linecheck-code-")) / "linecheck.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return memory that this Python process has freed, which it would keep while it waits for more tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name the frame does not have, whatever the case of its names."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def numbered(rows: DataFrame, order: list[Column], number: str, name: str) -> DataFrame:
    """The rows, stored, with a column of different numbers from 0 that rise in the order."""
    return stored(rows.orderBy(*order).withColumn(number, F.monotonically_increasing_id()), name)


def as_bytes(text: Column) -> Column:
    """The text in UTF-8, empty if it is missing."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64; grown by doubling."""
    have = _powers.get(0)
    if have is None or len(have[0]) < size:
        n = 1 << max(12, (size - 1).bit_length())
        up, down = np.full(n, MULTIPLIER, np.uint64), np.full(n, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[0] = np.cumprod(up), np.cumprod(down)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(a: np.ndarray) -> np.ndarray:
    """Sums h so that (h[e] - h[s]) times the inverse power s depends on the bytes a[s:e] only."""
    up, _ = powers(len(a) + 1)
    out = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_VALUES[a] * up[: len(a)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of the bytes behind ``sums``."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = ~SEPARATOR[a]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text cut after separators into parts of about ``size`` bytes; words stay whole."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and not SEPARATOR[text[cut]]:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def byte_counts(text: bytes) -> np.ndarray:
    """How often each byte occurs."""
    a = np.frombuffer(text, np.uint8)
    return sum((np.bincount(a[i : i + PIECE], minlength=256) for i in range(0, len(a), PIECE)), np.zeros(256, np.int64))


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word, in order; with ``lower``, of A-Z as a-z."""
    found = []
    for piece in pieces(text):
        a = np.frombuffer(piece, np.uint8)
        starts, ends = word_spans(a)
        if len(starts):
            found.append(span_hashes(prefix_hashes(LOWER[a] if lower else a), starts, ends))
    return np.concatenate(found) if len(found) > 1 else found[0] if found else np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` neighbouring words; none if there are fewer words."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    up, _ = powers(size + 1)
    total = words[:n] * up[size]
    for k in range(1, size):
        total = total + words[k : k + n] * up[size - k]
    return mixed(total)
