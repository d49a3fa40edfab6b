"""Near duplicates by a grouped prefix join on word n-grams.

The n-grams of a document are put in one order for all documents, frequent ones last, by exact
counts. Two sets that are similar enough share some of the first n-grams of that order (their
prefixes). Sets with the same size and prefix form one group; pairs of groups are filtered by
size and by the number of n-grams their prefixes share; groups that may hold links are expanded
and their members compared exactly, under an n-gram that both prefixes have.

Sets are sets of 64-bit hashes of n-grams, which matter only between two documents that are
compared; ids of sets and groups have 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecheck.llm.common import as_bytes, free_name, give_back, mixed, numbered, stored, window_hashes, word_hashes
from linecheck.llm.graph import components
from linecheck.operators.measured import small_side

# N-grams that prefixes must share (fewer in small sets); prefixes are that much longer.
SHARED = 3

# Lists of groups with a common n-gram: up to this length all pairs of the list are
# candidates, longer ones are tied together and compared in blocks.
SHORT = 24

# N-grams of more than SHORT documents go to the back of the order, the most frequent last. At
# most so many are sent to the tasks; if there are more, the least frequent stay in front. The
# order decides how much work there is, not what is found.
FREQUENT = 1 << 21

# Frequencies are counted by the upper bits of hashes: those of a range, of which there is one for
# so many documents, and five bytes more. A task sends on so many n-grams at once.
RANGE_DOCS = 20_000
NUMBER_BYTES = 5
HELD = 1 << 20

# Rows of texts to compare up to which their names are broadcast.
SMALL = 200_000

# Sets, and n-grams, per block of a cluster; two blocks are compared by one task.
BLOCK_SETS = 256
BLOCK_GRAMS = 1 << 20


def grams(text: bytes, size: int) -> np.ndarray:
    """The distinct hashes of the text's n-grams, ascending; of a shorter text, one of all its words."""
    words = word_hashes(text, lower=True)
    if 0 < len(words) < size:
        return mixed(window_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(words, size))


def digest(values: np.ndarray) -> bytes:
    """128 bits that depend on the set of values and their number."""
    n = np.uint64(len(values))
    parts = [mixed(values ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return mixed(np.array(parts, np.uint64) + n).tobytes()


def prefix_length(n: int, percent: int) -> int:
    """How many first n-grams a set of size ``n`` has to show."""
    least = -(-percent * n // 100)
    return n - least + min(SHARED, least)


def _frequent(docs: DataFrame, size: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """The frequent n-grams (upper bits of their hashes, ascending), their classes by powers of two, and the bits left out.

    Counted are the first n-grams of every document in the order of hashes, half as many again as
    its prefix has; others get into a prefix only where most of the first are frequent.
    """
    bits = min(24, max(8, (docs.count() // RANGE_DOCS).bit_length()))
    shift = np.uint64(64 - 8 * NUMBER_BYTES - bits)
    low = np.uint64((1 << bits) - 1)

    def packed(values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Sorted numbers and how often each occurs, by ranges of their lowest bits."""
        numbers, times = np.unique(values >> shift, return_counts=True)
        part = (numbers & low).astype(np.int32)
        order = np.argsort(part, kind="stable")
        numbers, times, part = numbers[order] >> np.uint64(bits), times[order], part[order]
        at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        cuts = [*at.tolist(), len(part)]
        rows = list(zip(cuts[:-1], cuts[1:], strict=True))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part[at], pa.int32()),
                "numbers": pa.array([numbers[i:j].view(np.uint8).reshape(-1, 8)[:, :NUMBER_BYTES].tobytes() for i, j in rows]),
                "times": pa.array([times[i:j].astype("<u4").tobytes() for i, j in rows]),
            }
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                values = grams(text.as_py(), size)
                head = values[: -(-3 * prefix_length(len(values), percent) // 2)]
                held.append(head)
                n += len(head)
                if n >= HELD:
                    yield from packed(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield from packed(np.concatenate(held))
        held.clear()
        give_back()

    def add(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(table.column("numbers").to_pylist()), np.uint8).reshape(-1, NUMBER_BYTES)
        numbers = np.zeros((len(raw), 8), np.uint8)
        numbers[:, :NUMBER_BYTES] = raw
        numbers = numbers.view("<u8").ravel()
        times = np.frombuffer(b"".join(table.column("times").to_pylist()), "<u4")
        order = np.argsort(numbers, kind="stable")
        numbers, times = numbers[order], times[order]
        at = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
        total = np.add.reduceat(times.astype(np.int64), at)
        many = total > SHORT
        part = np.uint64(table.column("part")[0].as_py())
        return pa.table({"number": pa.array((numbers[at][many] << np.uint64(bits) | part).astype(np.int64)), "n": pa.array(total[many])})

    parts = docs.select("text").mapInArrow(count, "part int, numbers binary, times binary")
    counted = stored(parts.groupBy("part").applyInArrow(add, "number long, n long"), "gram-counts")
    least = SHORT
    while counted.where(F.col("n") > least).count() > FREQUENT:
        least *= 2
    table = counted.where(F.col("n") > least).toArrow()
    numbers = table.column("number").to_numpy().astype(np.uint64)
    order = np.argsort(numbers)
    classes = np.floor(np.log2(table.column("n").to_numpy() / least)).astype(np.uint8) + np.uint8(1)
    return numbers[order], classes[order], shift


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row: ``doc_id``, ``mark`` of its text, ``n``, ``set_id``, ``group_id`` and ``prefix``; the last three null for an empty set."""
    sent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size, percent))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes, shift = sent.value
        for batch in batches:
            n, sets, groups, prefixes = [], [], [], []
            for text in batch.column(1):
                values = grams(text.as_py(), size)
                n.append(len(values))
                if not len(values):
                    sets.append(None)
                    groups.append(None)
                    prefixes.append(None)
                    continue
                ordered = values
                if len(frequent):
                    numbers = values >> shift
                    at = np.minimum(np.searchsorted(frequent, numbers), len(frequent) - 1)
                    rank = np.where(frequent[at] == numbers, classes[at], 0)
                    ordered = values[np.argsort(rank, kind="stable")] if rank.any() else values
                prefix = ordered[: prefix_length(len(values), percent)]
                sets.append(digest(values))
                groups.append(digest(np.append(prefix, np.uint64(len(values)))))
                prefixes.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(groups, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "n", "set_id", "group_id", "prefix"],
            )
        give_back()

    schema = "doc_id long, mark long, n long, set_id binary, group_id binary, prefix array<long>"
    return stored(docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(described, schema), "gram-sets")


def _near(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _wanted(n: Column, percent: int) -> Column:
    """N-grams that the prefixes of two similar sets share, the smaller of size ``n``."""
    return F.least(F.lit(SHARED), F.ceil(n * percent / 100))


def _label(kind: int, value: Column) -> Column:
    return F.xxhash64(F.lit(kind), value)


def _candidates(groups: DataFrame, percent: int) -> DataFrame:
    """Rows ``gid``, ``label``, once each: groups that may have links share a label.

    A pair of groups that passes the filter is compared under its smallest common n-gram; groups
    that share n-grams with long lists only, under the hub that they are tied to.
    """
    listed = groups.select("gid", "n", F.explode("prefix").alias("gram"))
    lists = Window.partitionBy("gram")
    shared = stored(listed.withColumn("length", F.count("*").over(lists)).where("length > 1"), "gram-lists")

    short = shared.where(F.col("length") <= SHORT)
    left = short.select("gram", F.col("gid").alias("a"), F.col("n").alias("n_a"))
    right = short.select("gram", F.col("gid").alias("b"), F.col("n").alias("n_b"))
    met = left.join(right, "gram").where((F.col("a") < F.col("b")) & _near(F.col("n_a"), F.col("n_b"), percent))
    met = met.groupBy("a", "b").agg(F.count("*").alias("met"), F.min(F.least("n_a", "n_b")).alias("n"), F.min("gram").alias("gram"))

    # Places in long lists are counted per group only: a pair shares at most the smaller
    # number of the two. Pairs that may reach the wanted number that way stay.
    long = shared.where(F.col("length") > SHORT)
    counts = long.groupBy("gid").agg(F.count("*").alias("places"))
    enough = F.col("met") >= _wanted(F.col("n"), percent)
    crowded = not long.isEmpty()
    if crowded:
        for side in ("a", "b"):
            met = met.join(counts.select(F.col("gid").alias(side), F.col("places").alias(f"places_{side}")), side, "left")
        places = F.least(F.coalesce("places_a", F.lit(0)), F.coalesce("places_b", F.lit(0)))
        enough = F.col("met") + places >= _wanted(F.col("n"), percent)
    met = met.where(enough).select(F.explode(F.array("a", "b")).alias("gid"), _label(1, F.col("gram")).alias("label"))
    if not crowded:
        return met.distinct()

    # Pairs that share n-grams with long lists only: groups with enough of them are tied to
    # the list's first group of their size, and that to the first of the next size.
    smallest = F.ceil(F.col("n") * percent / 100)
    long = long.join(counts, "gid").where(F.col("places") >= _wanted(smallest, percent))
    step = float(np.log(100 / percent)) * (1 + 1e-9) if percent < 100 else 1.0
    long = long.withColumn("band", F.floor(F.log("n") / F.lit(step)))
    hubs = long.groupBy("gram", "band").agg(F.min("gid").alias("hub"))
    tied = long.join(hubs, ["gram", "band"]).select(F.col("gid").alias("a"), F.col("hub").alias("b"))
    above = hubs.select("gram", (F.col("band") - 1).alias("band"), F.col("hub").alias("b"))
    bridged = hubs.join(above, ["gram", "band"]).select(F.col("hub").alias("a"), "b")
    clusters = components(stored(tied.union(bridged).where("a <> b").distinct(), "gram-ties"))
    roots = clusters.select("root").distinct().withColumnRenamed("root", "gid")
    tied = clusters.select(F.col("node").alias("gid"), _label(2, F.col("root")).alias("label"))
    tied = tied.union(roots.select("gid", _label(2, F.col("gid")).alias("label")))
    return met.union(tied).distinct()


def _verified(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between members (``label``, ``rep``, ``mark``, ``set_id``, ``blocks``) that connect all linked ones.

    Members of one label are compared with each other. A member has one row of ``docs``, or several
    with different texts of equal marks.
    """
    texts = members.join(docs.select(F.col("doc_id").alias("rep"), "mark", "text"), ["rep", "mark"])
    block = F.pmod(F.xxhash64("rep", "set_id"), F.col("blocks"))
    rows = texts.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "label",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "rep",
        "set_id",
        "text",
    )

    def compare(table: pa.Table) -> pa.Table:
        reps, wanted, blocks = (table.column(c).to_pylist() for c in ("rep", "set_id", "block"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        sets, owners, sides = [], [], []
        known = set()
        for rep, want, side, text in zip(reps, wanted, blocks, table.column("text"), strict=True):
            values = grams(text.as_py(), size)
            if (rep, want) not in known and digest(values) == want:
                known.add((rep, want))
                sets.append(values)
                owners.append(rep)
                sides.append(side)
        a, b = links(sets, percent, np.array(sides) if low != high else None)
        return pa.table({"a": pa.array([owners[i] for i in a], pa.int64()), "b": pa.array([owners[i] for i in b], pa.int64())})

    return rows.groupBy("label", "low", "high").applyInArrow(compare, "a long, b long")


def links(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Pairs of indices of similar sets that connect all similar ones.

    With ``sides``, only sets of different sides are compared. An index from n-gram to sets
    gives the exact size of every intersection.
    """
    if len(sets) < 2:
        return [], []
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    root = np.arange(len(sets))
    a, b = [], []
    for i, own in enumerate(sets):
        first = np.searchsorted(values, own, "left")
        times = np.searchsorted(values, own, "right") - first
        shift = np.repeat(first - np.concatenate(([0], np.cumsum(times)[:-1])), times)
        common = np.bincount(owner[shift + np.arange(len(shift))], minlength=len(sets))
        linked = 100 * common >= percent * (sizes[i] + sizes - common)
        linked[: i + 1] = False
        if sides is not None:
            linked &= sides != sides[i]
        for j in np.flatnonzero(linked & (root != root[i])):
            if root[j] != root[i]:
                a.append(i)
                b.append(int(j))
                root[root == root[j]] = root[i]
    return a, b


def near_duplicates(docs: DataFrame, size: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, ``n_shingles`` and ``component_id``.

    A set holds the distinct n-grams of ``size`` words, A-Z lower-cased; a shorter text is
    one n-gram. Two documents link if 100 times the size of the intersection is at least
    ``percent`` times that of the union; ``component_id`` is the smallest key that links
    lead to. Missing, empty and blank texts have no n-grams and link with nothing. Rows
    with equal sets are copies: one of them stands for all. Repeated rows are such copies;
    a key with several texts has a result for each. A row without key has the component of
    its copies, or none. No rows give no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), as_bytes(F.col(text)).alias("text"))
    sets = _sets(rows, size, percent)
    full = sets.where("n > 0 and doc_id is not null")
    groups = stored(
        full.groupBy("group_id").agg(F.min("doc_id").alias("gid"), F.first("n").alias("n"), F.first("prefix").alias("prefix")),
        "gram-groups",
    )
    labels = stored(_candidates(groups, percent), "gram-labels")

    distinct = full.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "mark")).alias("first"), F.first("group_id").alias("group_id"), F.first("n").alias("n")
    )
    distinct = distinct.select("set_id", F.col("first.doc_id").alias("rep"), F.col("first.mark").alias("mark"), "group_id", "n")
    distinct = stored(distinct.join(groups.select("group_id", "gid"), "group_id").drop("group_id"), "gram-distinct")
    # Sets of one group that is in no other cluster are a cluster.
    several = distinct.groupBy("gid").agg(F.count("*").alias("sets")).where("sets > 1")
    alone = several.join(labels.select("gid"), "gid", "left_anti").select("gid", _label(3, F.col("gid")).alias("label"))
    members = distinct.join(labels.union(alone), "gid")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS))
    crowds = members.groupBy("label").agg(F.count("*").alias("sets"), blocks.alias("blocks")).where("sets > 1")
    members = members.join(crowds.drop("sets"), "label").select("label", "rep", "mark", "set_id", "blocks")
    members = stored(members, "gram-members")

    # Repeated rows have one text for all of them, wherever there are any. Only texts that are
    # compared are shuffled.
    texts = rows.where("doc_id is not null").withColumn("mark", F.xxhash64("text"))
    wanted = members.select(F.col("rep").alias("doc_id"), "mark").distinct()
    texts = texts.join(small_side(wanted, SMALL), ["doc_id", "mark"], "left_semi")
    several = full.groupBy("doc_id", "mark").agg(F.count("*").alias("copies")).where("copies > 1")
    if not several.isEmpty():
        texts = texts.groupBy("doc_id", "mark", F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"))
    roots = components(stored(_verified(texts, members, size, percent), "gram-links"))
    found = distinct.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("set_id", F.coalesce("root", "rep").alias("component_id"))
    return sets.join(found, "set_id", "left").select(
        F.col("doc_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, size: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that links tie to one with a smaller key; all columns stay.

    Rows without key stay. Of repeated rows of the key that stays, all do.
    """
    found = near_duplicates(docs, size, percent, key, text)
    gone = free_name(docs, "gone")
    drop = found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(gone)).distinct()
    return docs.join(drop, docs[key] == drop[gone], "left_anti")


def one_row_of_each(docs: DataFrame, size: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group that links tie together, that with the smallest key; all columns stay.

    Rows are judged, not keys. Of rows with equal key and text one stays. Each other row is a
    document of its own, be its key missing or that of other texts, too. Of one key's texts
    that with the smallest digest comes first; rows without key come last.
    """
    unclear = docs.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1 or key is null")
    if unclear.isEmpty():
        return one_of_each(docs, size, percent, key, text)
    digest, number = free_name(docs, "digest"), free_name(docs, "number")
    rows = docs.withColumn(digest, F.sha2(F.col(text).cast("binary"), 256)).dropDuplicates([key, digest])
    order = [F.col(key).cast("long").asc_nulls_last(), F.col(key).asc_nulls_last(), F.col(digest)]
    rows = numbered(rows, order, number, "gram-rows")
    found = near_duplicates(rows, size, percent, number, text)
    first = found.where(F.col(number) == F.col("component_id")).select(number)
    return rows.join(first, number, "left_semi").select(*[f"`{c}`" for c in docs.columns])
