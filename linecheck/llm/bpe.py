"""Byte-level BPE by replaying merges over many words at once.

A text is cut by the tokenizer's pattern into words. All new words of many documents are laid
out in one sequence of symbols, with an inverted index from the rank of a pair to the places
where that pair stands. Ranks are applied in ascending order, each at all its places at once
where it has many; a merge touches the entries of its two neighbours only. A word that was
encoded is remembered while room lasts, until its task ends.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecheck.llm.common import PIECE, give_back

# Words in each of the two generations that a Python worker remembers: when the young one is
# full, it takes the place of the old one. Bounds memory, not results.
REMEMBERED = 40_000

# Words that are cut from a text at once.
CUT = 1 << 16

# Bytes of short texts whose new words are encoded together, and places of a rank that are merged
# together rather than one by one.
GATHERED = 1 << 21
MANY = 40


def parsed(lines: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class Merges:
    """A table of ranks, and the words it has encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the ranks lack {len(missing)} single bytes")
        self.ranks = ranks
        self.cut = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        # Every pair of tokens whose bytes together are a token, as one number, with its rank.
        self.size = 1 + max(self.tokens)
        found = [
            (ranks[token[:i]] * self.size + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        table = np.array(sorted(found) or [(-1, -1)], np.int64)
        self.pair_keys, self.pair_values = table[:, 0].copy(), table[:, 1].copy()
        self.pairs: dict[int, int] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __enter__(self) -> Merges:
        return self

    def __exit__(self, *_: object) -> None:
        """Forget the words of a task, which would stay in the memory of its Python process."""
        self.known, self.older, self.pairs = {}, {}, {}
        give_back()

    def rank(self, left: int, right: int) -> int:
        """The rank of the merged pair, -1 if it does not merge."""
        key = left * self.size + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            found = self.pairs[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return found

    def pair_ranks(self, keys: np.ndarray) -> np.ndarray:
        """The ranks of many merged pairs, given as one number each, -1 where they do not merge."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_values[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, which has at least one byte.

        Within a word the lowest rank goes first, at its leftmost place. Words in which a rank
        has one place are merged all at once; in others place after place, and where a merge
        makes a pair of lower rank, the other places of that word wait until it is done.
        """
        letters = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(word) for word in words])
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(words)), sizes)
        symbols = self.single[letters]
        after = np.arange(1, len(letters) + 1)
        after[ends - 1] = -1
        before = np.arange(-1, len(letters) - 1)
        before[ends[:-1]] = -1
        # Rank of the pair that starts at a place; the first pairs are pairs of bytes.
        now = np.full(len(letters), -1)
        now[:-1] = self.byte_pairs[letters[:-1], letters[1:]]
        now[ends - 1] = -1

        # Per rank its places, those found one by one and those found many at once.
        index: dict[int, list[int]] = {}
        crowds: dict[int, list[np.ndarray]] = {}
        ready: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for r, i, j in zip(ranks[starts[:-1]].tolist(), starts[:-1], starts[1:], strict=True):
                if r not in index and r not in crowds:
                    heapq.heappush(ready, r)
                if j - i < MANY:
                    index.setdefault(r, []).extend(places[i:j].tolist())
                else:
                    crowds.setdefault(r, []).append(places[i:j])

        first = np.flatnonzero(now >= 0)
        if len(first):
            enter(now[first], first)
        views = tuple(memoryview(x) for x in (symbols, after, before, now, owner))
        while ready:
            r = heapq.heappop(ready)
            places, crowd = index.pop(r, []), crowds.pop(r, [])
            if crowd or len(places) >= MANY:
                every = np.concatenate([*crowd, np.array(places, np.int64)])
                every = np.sort(every[now[every] == r])
                every = every[np.append(True, every[1:] != every[:-1])[: len(every)]]
                own = owner[every]
                alone = np.ones(len(own), bool)
                alone[1:] &= own[1:] != own[:-1]
                alone[:-1] &= own[1:] != own[:-1]
                self._merge_all(r, every[alone], symbols, after, before, now, enter)
                places = every[~alone].tolist()
            if places:
                places.sort()
                later = self._merge_each(r, places, views, index, crowds, ready)
                if later:
                    if r not in index and r not in crowds:
                        heapq.heappush(ready, r)
                    index.setdefault(r, []).extend(later)
        live = symbols >= 0
        bounds = np.concatenate(([0], np.cumsum(live)))[[0, *ends]] * 4
        ids = symbols[live].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _merge_all(self, r: int, at: np.ndarray, symbols: np.ndarray, after: np.ndarray, before: np.ndarray, now: np.ndarray, enter) -> None:
        """Merge the pairs of rank ``r`` at places of different words."""
        if not len(at):
            return
        gone = after[at]
        beyond, ahead = after[gone], before[at]
        symbols[at], symbols[gone], now[gone], now[at] = r, -1, -1, -1
        after[at] = beyond
        more, less = beyond >= 0, ahead >= 0
        beyond, start, ahead = beyond[more], at[more], ahead[less]
        before[beyond] = start
        places = np.concatenate((start, ahead))
        ranks = self.pair_ranks(np.concatenate((r * self.size + symbols[beyond], symbols[ahead] * self.size + r)))
        now[places] = ranks
        good = np.flatnonzero(ranks >= 0)
        if len(good):
            enter(ranks[good], places[good])

    def _merge_each(self, r: int, places: list[int], views: tuple, index: dict, crowds: dict, ready: list[int]) -> list[int]:
        """Merge the pairs of rank ``r`` at ascending places; returns those that have to wait."""
        symbols, after, before, now, owner = views
        pairs, size, rank = self.pairs, self.size, self.rank
        waiting: set[int] = set()
        later: list[int] = []
        for at in places:
            if now[at] != r:
                continue
            if waiting and owner[at] in waiting:
                later.append(at)
                continue
            gone = after[at]
            beyond, ahead = after[gone], before[at]
            symbols[at], symbols[gone], now[gone], now[at] = r, -1, -1, -1
            after[at] = beyond
            if beyond >= 0:
                before[beyond] = at
                right = symbols[beyond]
                new = pairs.get(r * size + right)
                if new is None:
                    new = rank(r, right)
                if new >= 0:
                    now[at] = new
                    if new in index:
                        index[new].append(at)
                    else:
                        if new not in crowds:
                            heapq.heappush(ready, new)
                        index[new] = [at]
                    if new < r:
                        waiting.add(owner[at])
            if ahead >= 0:
                left = symbols[ahead]
                new = pairs.get(left * size + r)
                if new is None:
                    new = rank(left, r)
                now[ahead] = new
                if new >= 0:
                    if new in index:
                        index[new].append(ahead)
                    else:
                        if new not in crowds:
                            heapq.heappush(ready, new)
                        index[new] = [ahead]
                    if new < r:
                        waiting.add(owner[at])
        return later

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not remembered."""
        new = []
        for word in words.difference(self.known):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.known[word] = ids
        raw = [word.encode("utf-8", "surrogatepass") for word in new]
        todo = []
        for word, letters in zip(new, raw, strict=True):
            whole = self.ranks.get(letters)
            if whole is None:
                todo.append((word, letters))
            else:
                self.known[word] = np.uint32(whole).tobytes()
        if todo:
            self.known.update(zip((word for word, _ in todo), self.replay([letters for _, letters in todo]), strict=True))

    def words(self, text: str) -> Iterator[list[str]]:
        """The text's words, some at a time."""
        if len(text) <= PIECE:
            yield self.cut.findall(text)
            return
        matches = (m.group() for m in self.cut.finditer(text))
        while part := list(islice(matches, CUT)):
            yield part

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids, as little-endian unsigned 32-bit integers."""
        found: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > PIECE:
                found.extend(self._joined(held))
                held, size = [], 0
                found.append(b"".join(self._joined([part])[0] for part in self.words(text)))
                continue
            held.append(self.cut.findall(text))
            size += len(text)
            if size > GATHERED:
                found.extend(self._joined(held))
                held, size = [], 0
        found.extend(self._joined(held))
        return found

    def _joined(self, texts: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        self.learn(set().union(*texts))
        return [b"".join(map(self.known.__getitem__, words)) for words in texts]

    def decode(self, ids: bytes) -> bytes:
        """The bytes behind the ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def slices(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The same values in pieces of about ``GATHERED`` bytes, so that few are Python objects at once."""
    for values in parts:
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(values):
            reach = GATHERED + (int(ends[start - 1]) if start else 0)
            end = max(start + 1, int(np.searchsorted(ends, reach, "right")))
            yield values.slice(start, end - start)
            start = end


def _lists(ids: list[bytes]) -> pa.Array:
    """Binary ids as lists of integers."""
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


_COUNTED = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_bytes", T.LongType())])
_ROUND_TRIP = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("bytes", T.BinaryType())])

_tables: dict[tuple[int, int], Merges] = {}


class TaskSide:
    """A tokenizer as sent to tasks."""

    def __init__(self, sent):
        self.sent = sent

    def merges(self) -> Merges:
        """The table of this Python process."""
        lines, pattern = self.sent.value
        key = (hash(lines), hash(pattern))
        if key not in _tables:
            _tables.clear()
            _tables[key] = Merges(parsed(lines), pattern)
        return _tables[key]


class Tokenizer:
    """Encodes and decodes columns by the ranks of a file, which the driver reads and sends out once.

    A missing text is encoded as the empty one, and missing ids are decoded as none; both give
    empty results, not missing ones. Any text of any length is encoded whole, repeated rows give
    equal results, and no rows give no rows.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = file.read()
        self.sent = spark.sparkContext.broadcast((lines, pattern))
        self.size = 1 + max(parsed(lines).values())

    def task_side(self) -> TaskSide:
        """What functions that run in tasks need."""
        return TaskSide(self.sent)

    def ids(self, text: Column) -> Column:
        """The ids of the text as binary, four bytes each; of a missing text, none."""
        this = self.task_side()

        @F.arrow_udf(T.BinaryType())
        def encoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            with this.merges() as merges:
                for texts in slices(parts):
                    yield pa.array(merges.encode([t or "" for t in texts.to_pylist()]), pa.binary())

        return encoded(text.cast("string"))

    def round_trip(self, text: Column) -> Column:
        """A struct of the text's ``ids`` and the ``bytes`` behind them, from one pass over the text."""
        this = self.task_side()

        @F.arrow_udf(_ROUND_TRIP)
        def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            with this.merges() as merges:
                for texts in slices(parts):
                    ids = merges.encode([t or "" for t in texts.to_pylist()])
                    yield pa.StructArray.from_arrays(
                        [pa.array(ids, pa.binary()), pa.array([merges.decode(i) for i in ids], pa.binary())], ["ids", "bytes"]
                    )

        return both(text.cast("string"))

    def counted(self, text: Column) -> Column:
        """A struct of the text's ``token_ids`` as integers and the number ``n_bytes`` of bytes that they decode to.

        All in one function, so that a task needs one Python process and the bytes do not leave it.
        """
        this = self.task_side()

        @F.arrow_udf(_COUNTED)
        def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            with this.merges() as merges:
                for texts in slices(parts):
                    ids = merges.encode([t or "" for t in texts.to_pylist()])
                    sizes = pa.array([len(merges.decode(i)) for i in ids], pa.int64())
                    yield pa.StructArray.from_arrays([_lists(ids), sizes], ["token_ids", "n_bytes"])

        return both(text.cast("string"))

    def text(self, ids: Column) -> Column:
        """The bytes behind binary ids."""
        this = self.task_side()

        @F.arrow_udf(T.BinaryType())
        def decoded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            merges = this.merges()
            for rows in slices(parts):
                yield pa.array([merges.decode(row.as_py() or b"") for row in rows], pa.binary())

        return decoded(ids)


def numbers(ids: Column) -> Column:
    """Binary ids as an array of integers."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def listed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in slices(parts):
            yield _lists([row.as_py() or b"" for row in rows])

    return listed(ids)
