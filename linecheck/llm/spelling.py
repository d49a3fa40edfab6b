"""Spelling variants: frequent words that differ by one inserted, deleted or replaced letter.

Every word's deletions and replacements are generated as hashes and probed against Bloom
filters of the vocabulary, one per word length, that are broadcast a bounded number of bytes at
a time. Only what passes a filter is shuffled, to an exact join with the vocabulary and a
comparison of the words themselves. An insertion is the deletion seen from the other word, and
only replacements by later letters are generated, so each pair of words is found once.

A word's hash is a sum over its letters, so an edit's hash follows from it in a few steps. A
Bloom filter is made of blocks of eight 64-bit numbers; a word's bits are all in one block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import PIECE, as_bytes, mixed, powers, stored

# Runs of letters in lower-cased UTF-8 (U+00C0 to U+00FF begin with 0xC3 and take
# two bytes), the divisor that chooses the runs to damage, and the least length and frequency.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
BREAK = re.compile(rb"[^a-z\x80-\xbf\xc3]")
DAMAGED = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5

# Of one word's form, at least so many times as frequent.
TIMES = 5

# Distinct words counted before they leave a task's memory.
HELD = 100_000

# Filter blocks of 64 bytes, words per block, bits per word, words per filter and bytes of filters
# broadcast at once.
BLOCK_BITS, BLOCK_WORDS = 512, 32
BITS = 6
FILTER_WORDS = 1 << 21
BROADCAST = 32 << 20

# Edits probed at once.
EDITS = 1 << 19

_LETTER = np.random.RandomState(12).randint(0, 2**62, 512, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PIECE`` bytes that cut no run."""
    start = 0
    while len(text) - start > PIECE:
        found = BREAK.search(text, start + PIECE)
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end
    yield text[start:]


def damaged(run: bytes, prefix: int) -> bytes:
    """The run, or the run without one letter; ``prefix`` is the checksum of what stands before it."""
    h = zlib.crc32(run, prefix)
    if h % DAMAGED:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def counts(docs: DataFrame) -> DataFrame:
    """How often each word of enough letters occurs: ``word``, ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def given() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )
            total.clear()
            return made

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                prefix = zlib.crc32((name.as_py() or "").encode() + b":")
                for part in _parts(text.as_buffer().to_pybytes().lower()):
                    for run, n in Counter(RUN.findall(part)).items():
                        word = damaged(run, prefix)
                        if len(word) >= LEAST_LETTERS and len(word) - word.count(b"\xc3") >= LEAST_LETTERS:
                            total[word] += n
                    if len(total) > HELD:
                        yield given()
        yield given()

    rows = docs.select(F.col("doc_id").cast("string"), as_bytes(F.col("text")).alias("text"))
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def codes(word: str) -> np.ndarray:
    """The word's letters as numbers below 256."""
    return np.frombuffer(word.encode("latin-1"), np.uint8)


def hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of words of equal length, given as rows of letters."""
    up, _ = powers(letters.shape[1] + 1)
    return (_LETTER[letters] * up[: letters.shape[1]]).sum(1, dtype=np.uint64)


def vocabulary(words: DataFrame) -> DataFrame:
    """Adds ``size`` (letters) and ``hash`` to words of letters below U+0100."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = [codes(w) for w in batch.column(0).to_pylist()]
            sums = [int(hashes(x[None, :])[0].astype(np.int64)) for x in letters]
            extra = [pa.array([len(x) for x in letters], pa.int32()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *extra], ["word", "n", "size", "hash"])

    return words.select("word", "n").mapInArrow(add, "word string, n long, size int, hash long")


def _blocks(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each mixed hash."""
    return ((h >> np.uint64(40)) * np.uint64(blocks) >> np.uint64(24)).astype(np.int64)


def _bit(h: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Number in the block, and mask, of one of a word's bits."""
    nine = mixed(h + np.uint64(turn)) if turn else h
    return (nine & np.uint64(7)).astype(np.int64), np.uint64(1) << (nine >> np.uint64(3) & np.uint64(63))


def bloom(words: np.ndarray) -> np.ndarray:
    """A filter of the hashes: blocks of eight 64-bit numbers."""
    blocks = max(1, -(-len(words) // BLOCK_WORDS))
    out = np.zeros((blocks, 8), np.uint64)
    h = mixed(words.copy())
    at = _blocks(h, blocks)
    for turn in range(BITS):
        lane, mask = _bit(h, turn)
        np.bitwise_or.at(out, (at, lane), mask)
    return out


def held(words: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Places of the hashes that may be in the filter."""
    h = mixed(words.copy())
    at = _blocks(h, len(filter_))
    left = np.arange(len(h))
    for turn in range(BITS):
        lane, mask = _bit(h, turn)
        good = filter_[at, lane] & mask != 0
        h, at, left = h[good], at[good], left[good]
    return left


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    """Which filter of its length a hash belongs to."""
    return (mixed(words + np.uint64(99)) % np.uint64(shards)).astype(np.int64)


def edits(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Edits of words of equal length, given as rows: length, rows, hashes, a bounded number at a time.

    Of equal neighbours only the first is deleted, as deleting the others gives the same word;
    a letter is replaced only by later ones of the sorted alphabet.
    """
    n, size = letters.shape
    up, down = powers(size + 1)
    terms = _LETTER[letters] * up[:size]
    whole = terms.sum(1, dtype=np.uint64)
    width = max(1, min(size, EDITS // max(1, len(alphabet))))
    height = max(1, EDITS // (width * max(1, len(alphabet))))
    for i in range(0, n, height):
        rows = slice(i, i + height)
        before = np.cumsum(terms[rows], axis=1, dtype=np.uint64) - terms[rows]
        after = whole[rows, None] - before - terms[rows]
        first = np.ones(before.shape, bool)
        first[:, 1:] = letters[rows, 1:] != letters[rows, :-1]
        row, at = np.nonzero(first)
        # What follows moves one place to the front.
        yield size - 1, row + i, before[row, at] + after[row, at] * down[1]
        for j in range(0, size, width):
            part = letters[rows, j : j + width]
            row, at, k = np.nonzero(alphabet[None, None, :] > part[:, :, None])
            change = _LETTER[alphabet[k]] - _LETTER[part[row, at]]
            yield size, row + i, whole[row + i] + change * up[j + at]


def _filters(words: DataFrame, shards: dict[int, int]) -> DataFrame:
    """One filter for each length and shard: ``size``, ``shard``, ``filter``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            h = batch.column(1).to_numpy().view(np.uint64)
            shard = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes):
                own = sizes == size
                shard[own] = shard_of(h[own], shards.get(int(size), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard), batch.column(1)], ["size", "shard", "hash"])

    def make(table: pa.Table) -> pa.Table:
        made = bloom(table.column("hash").to_numpy().view(np.uint64))
        return pa.table(
            {
                "size": table.column("size").slice(0, 1).cast(pa.int32()),
                "shard": table.column("shard").slice(0, 1).cast(pa.int32()),
                "filter": pa.array([made.tobytes()], pa.binary()),
            }
        )

    dealt = words.select("size", "hash").mapInArrow(deal, "size int, shard int, hash long")
    return dealt.groupBy("size", "shard").applyInArrow(make, "size int, shard int, filter binary")


def _positives(words: DataFrame, filters: dict[tuple[int, int], np.ndarray], shards: dict[int, int], alphabet: np.ndarray) -> DataFrame:
    """Edits that may be in the vocabulary: ``id`` of the word, ``size`` and ``hash`` of the edit."""
    sent = words.sparkSession.sparkContext.broadcast(filters)
    lengths = {size for size, _ in filters}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sent.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            letters = [codes(w) for w in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in letters])
            for length in np.unique(sizes):
                if not lengths & {length, length - 1}:
                    continue
                own = np.flatnonzero(sizes == length)
                # Some thousand letters at a time, or one long word.
                for i in range(0, len(own), step := max(1, EDITS // int(length))):
                    at = own[i : i + step]
                    for size, row, h in edits(np.stack([letters[k] for k in at]), alphabet):
                        if size not in lengths:
                            continue
                        which = shard_of(h, shards[size])
                        for shard in range(shards[size]):
                            if (size, shard) not in have:
                                continue
                            mine = np.flatnonzero(which == shard) if shards[size] > 1 else np.arange(len(h))
                            good = mine[held(h[mine], have[size, shard])]
                            if len(good):
                                yield pa.RecordBatch.from_arrays(
                                    [
                                        pa.array(ids[at[row[good]]]),
                                        pa.array(np.full(len(good), size, np.int32)),
                                        pa.array(h[good].view(np.int64)),
                                    ],
                                    ["id", "size", "hash"],
                                )

    return words.select("id", "word").mapInArrow(probe, "id long, size int, hash long")


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of words one edit apart, once: ``a``, ``n_a``, ``b``, ``n_b``.

    ``words`` has ``id``, ``word``, ``n``, ``size`` and ``hash``; words and ids are unique.
    """
    spark = words.sparkSession
    lengths = {row["size"]: row["count"] for row in words.groupBy("size").count().collect()}
    shards = {size: -(-n // FILTER_WORDS) for size, n in lengths.items()}
    # At most the letters that a run may have.
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").distinct().collect()
    alphabet = np.sort(codes("".join(row.letter for row in letters)))
    filters = stored(_filters(words, shards), "spelling-filters").withColumn("bytes", F.length("filter").cast("long"))

    # Filters by rounds of a bounded size; the vocabulary's words are probed in every round.
    facts = sorted((row["size"], row.shard, row.bytes) for row in filters.select("size", "shard", "bytes").collect())
    rounds: list[list[tuple[int, int]]] = []
    room = 0
    for size, shard, n in facts:
        if not rounds or n > room:
            rounds.append([])
            room = BROADCAST
        rounds[-1].append((size, shard))
        room -= n
    # Few words are still many edits, so they are spread over all cores.
    spread = words.repartition(max(spark.sparkContext.defaultParallelism, -(-sum(lengths.values()) // 50_000)))
    found = []
    for keys in rounds:
        least, most = keys[0], keys[-1]
        place = F.struct("size", "shard")
        bound = [F.struct(F.lit(size).cast("int").alias("size"), F.lit(shard).cast("int").alias("shard")) for size, shard in (least, most)]
        rows = filters.where(place.between(*bound)).select("size", "shard", "filter").collect()
        have = {(row["size"], row.shard): np.frombuffer(row["filter"], np.uint64).reshape(-1, 8) for row in rows}
        found.append(stored(_positives(spread, have, shards, alphabet), "spelling-positives"))
    positives = found[0] if found else spark.createDataFrame([], "id long, size int, hash long")
    for more in found[1:]:
        positives = positives.unionByName(more)

    exact = words.select("size", "hash", F.col("id").alias("other"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = positives.join(exact, ["size", "hash"])
    own = words.select("id", F.col("word").alias("a"), F.col("n").alias("n_a"))
    pairs = pairs.join(own, "id").where(F.levenshtein("a", "b", 1) == 1)
    return pairs.select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where following ``form`` ends; every step doubles the way behind it."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(further, F.col("root") == F.col("at"), "left")
        step = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """The frequent words of ``docs`` (``doc_id``, ``text``) with their forms and roots.

    Words are runs of letters, lower-cased in A-Z only; one run in DAMAGED, by a checksum of id
    and run, loses a letter first. Of LEAST_LETTERS letters and LEAST_COUNT occurrences on, a
    word is returned: ``word``, ``n``, ``n_near`` (words one edit away), ``form`` (the most
    frequent of those, ties to the first in order of code points, if at least TIMES as
    frequent; else missing), ``form_n``, ``root`` (the end of the chain of forms).

    A missing text has no words, a missing id is the empty text in the checksum. Repeated rows
    count each. Long texts are read in parts, a run is never cut. Other columns are not looked
    at. No words give no rows.
    """
    words = vocabulary(counts(docs).where(F.col("n") >= LEAST_COUNT))
    words = stored(words.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = stored(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_near"))
    both = both.union(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("n"), F.col("near").alias("near"))).alias("best")
    )
    rows = words.select("word", "n").join(best, "word", "left")
    good = -F.col("best.n") >= TIMES * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"),
        F.when(good, -F.col("best.n")).alias("form_n"),
    )
    rows = stored(rows, "spelling-forms")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    whole = rows.join(roots, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
