"""Benchmark decontamination by winnowing: document words that stand in passages of benchmark items.

Words are hashed in runs of ``GRAM``; of every window of ``SIZE`` words the smallest hash is
kept as its fingerprint. Two equal windows keep the same one, so every shared window is found
by joining the fingerprints of documents with those of the benchmark. A hit is extended to the
windows around it, which are compared word by word. Only DataFrame functions.

The benchmark's windows are one row per distinct text, with the class of items that hold it,
so a passage common to many items is met once. Texts are known by their SHA-256; what is found
in one text goes to all its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import stored
from linecheck.operators.measured import is_small, small_side

# A window has SIZE words, a fingerprint hashes GRAM of them (a power of two).
SIZE = 10
GRAM = 4

# Fixed values.
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[a-z0-9\x80-\x{10FFFF}]++"
ANY_CASE = r"[A-Za-z0-9\x80-\x{10FFFF}]++"

# A fingerprint's upper half is a hash, its lower half the place of the first word.
PLACE = (1 << 32) - 1


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none if it is missing."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), CAPITALS, SMALL)
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def _from(array: str, n: int) -> Column:
    return F.slice(array, n + 1, F.greatest(F.size(array) - n, F.lit(0)))


def _hash_of(fingerprint: Column) -> Column:
    return F.shiftright(fingerprint, 32)


def _place_of(fingerprint: Column) -> Column:
    return fingerprint.bitwiseAND(F.lit(PLACE)).cast("int")


def gram_hashes(rows: DataFrame) -> DataFrame:
    """Adds ``grams``: per run of GRAM words of ``words`` a number of hash and place.

    Every step uses the one before twice, so that it is computed once per row; single elements
    are taken from arrays inside functions, as a slice there copies the whole array first.
    """
    high = F.lit(~PLACE).cast("long")

    def gram(word: Column, i: Column) -> Column:
        hashed = F.xxhash64(word, *[F.get("words", i + k) for k in range(1, GRAM)])
        return hashed.bitwiseAND(high).bitwiseOR(i.cast("long"))

    rows = rows.withColumn("grams", F.transform("words", gram))
    whole = F.greatest(F.size("words") - (GRAM - 1), F.lit(0))
    return rows.withColumn("grams", F.slice("grams", 1, whole))


def fingerprints(rows: DataFrame) -> DataFrame:
    """Adds ``prints``: the least of ``grams`` in every window of SIZE words of ``words``, each once."""
    width = SIZE - GRAM + 1
    rows = gram_hashes(rows)
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        rows = rows.withColumn("grams", F.zip_with("grams", _from("grams", step), lambda a, b: F.least(a, b)))
        covered += step
    windows = F.greatest(F.size("words") - (SIZE - 1), F.lit(0))
    return rows.withColumn("prints", F.array_distinct(F.slice("grams", 1, windows))).drop("grams")


def windows(items: DataFrame) -> DataFrame:
    """Rows ``passage``, ``class``, ``items``: every window of SIZE words of any item, once.

    ``items`` has ``item_id`` and ``text``. An item of fewer words is one window. ``class``
    stands for the set of items that hold the window, ``items`` are their ids as sorted text.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    rows = rows.where(F.size("words") > 0)
    # The words are used twice, so they are not computed anew at every place.
    last = F.greatest(F.size("words") - SIZE, F.lit(0))
    texts = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", *[F.get("words", i + k) for k in range(SIZE)]))
    found = rows.select("item", F.explode(texts).alias("passage"))
    found = found.groupBy("passage").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return found.withColumn("class", F.sha2(F.array_join("items", ","), 256))


def _matched(places: DataFrame, passages: DataFrame) -> DataFrame:
    """Of places (``key``, ``start``, ``passage``) those whose words are a window, with its class."""
    found = places.join(small_side(passages.select("passage", "class")), "passage")
    return found.select("key", "start", F.size(F.split("passage", " ")).alias("n"), "class")


def _long_matches(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """Where windows of SIZE words stand in documents (``key``, ``text``)."""
    rows = gram_hashes(passages.select(F.split("passage", " ").alias("words")))
    # All places of the least hash, so that it does not matter which of equal ones a document keeps.
    least = F.array_min(F.transform("grams", _hash_of))
    rows = rows.withColumn("least", least)
    ties = F.transform(F.filter("grams", lambda g: _hash_of(g) == F.col("least")), _place_of)
    index = rows.groupBy("least").agg(F.array_distinct(F.flatten(F.collect_set(ties))).alias("offsets"))
    index = small_side(stored(index, "winnowing-prints"))

    def around(p: Column) -> Column:
        at = _place_of(p)
        near = F.array(*[F.get("words", at + k) for k in range(GRAM - SIZE, SIZE)])
        return F.struct(_hash_of(p).alias("least"), at.alias("at"), near.alias("near"))

    prints = fingerprints(docs.select("key", words(F.col("text")).alias("words")))
    prints = prints.select("key", F.explode(F.transform("prints", around)).alias("p")).select("key", "p.*")
    hits = prints.join(index, "least")
    hits = hits.select("key", "at", "near", F.explode("offsets").alias("offset")).where("offset <= at")
    # Words beyond the end are missing, so that what is left is too short for a window.
    own = F.slice("near", SIZE - GRAM + 1 - F.col("offset"), SIZE)
    return _matched(hits.select("key", (F.col("at") - F.col("offset")).alias("start"), F.array_join(own, " ").alias("passage")), passages)


def _short_matches(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """Where whole items of fewer than SIZE words stand in documents (``key``, ``text``).

    Their fingerprint is the least hash of a single word. Texts that hold it are read again.
    """
    rows = passages.select(F.split("passage", " ").alias("words"))
    rows = rows.select(F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("grams"))
    rows = rows.withColumn("least", F.array_min("grams"))
    rows = rows.select("least", "n", (F.array_position("grams", F.col("least")) - 1).cast("int").alias("offset"))
    index = rows.groupBy("least").agg(F.collect_set(F.struct("offset", "n")).alias("offsets"))
    index = small_side(stored(index, "winnowing-short-prints"))

    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    prints = docs.select("key", F.posexplode(hashes).alias("at", "least"))
    hits = prints.join(index, "least").select("key", F.explode("offsets").alias("o"), "at")
    hits = hits.select("key", (F.col("at") - F.col("o.offset")).alias("start"), F.col("o.n").alias("n")).where("start >= 0")
    places = hits.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    places = stored(places, "winnowing-short-places")
    room = places.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    again = docs.join(F.broadcast(places) if room <= 500_000 else places, "key")
    again = again.select("key", "places", words(F.col("text")).alias("words"))
    inside = F.filter("places", lambda p: p["start"] + p["n"] <= F.size("words"))

    def own(p: Column) -> Column:
        some = [F.when(p["n"] > k, F.get("words", p["start"] + k)) for k in range(SIZE - 1)]
        return F.struct(p["start"].alias("start"), F.concat_ws(" ", *some).alias("passage"))

    texts = F.transform(inside, own)
    texts = again.select("key", F.explode(texts).alias("p")).select("key", "p.*")
    return _matched(texts, passages)


def _covered(spans: Column) -> Column:
    """The number of words in the union of sorted spans (``start``, ``end``)."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(total: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], total["end"]), F.lit(0))
        return F.struct((total["n"] + new).alias("n"), F.greatest(total["end"], span["end"]).alias("end"))

    return F.aggregate(spans, nothing, add, lambda total: total["n"])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs`` what it shares with the benchmark ``items`` (``item_id``, ``text``).

    Returns ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of an item's window),
    ``n_items`` and ``items_sha256`` (ids of items with a window in the document, sorted as text
    and joined by commas), and ``contaminated``. An item of fewer than SIZE words is one window,
    one without words is none. Missing texts have no words. Rows without id or with an id that
    repeats are judged by their own text; items that repeat an id count once, and items without
    id mark words but are not listed. Other columns are not looked at. An empty benchmark hits
    nothing, and no documents give no rows.
    """
    passages = stored(windows(items), "winnowing-windows")
    is_long = F.size(F.split("passage", " ")) == SIZE
    long, short = passages.where(is_long), passages.where(~is_long)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.sha2(text, 256))
    rows = docs.select(key.alias("key"), "text")
    found = _long_matches(rows, long)
    if not short.isEmpty():
        found = found.unionByName(_short_matches(rows, short))
    found = found.groupBy("key").agg(F.collect_set(F.struct("start", "n", "class")).alias("places"))
    spans = F.array_sort(F.transform("places", lambda p: F.struct(p["start"].alias("start"), (p["start"] + p["n"]).alias("end"))))
    classes = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["class"])))
    found = found.select("key", _covered(spans).cast("long").alias("n_hit"), classes.alias("classes"))
    found = found.withColumn("set", F.sha2(F.array_join("classes", ","), 256))
    found = stored(found, "winnowing-found")

    # Lists of items are made once per set of classes, not per document.
    sets = found.groupBy("set").agg(F.first("classes").alias("classes"))
    held = passages.groupBy("class").agg(F.first("items").alias("items"))
    lists = sets.select("set", F.explode("classes").alias("class")).join(held, "class")
    lists = lists.select("set", F.explode_outer("items").alias("item"))
    lists = lists.groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lists = lists.select(
        "set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    )
    lists = stored(lists, "winnowing-lists")
    found = found.select("key", "n_hit", "set").join(small_side(lists), "set").drop("set")
    found = stored(found, "winnowing-results")

    counts = docs.select("doc_id", key.alias("key"), F.regexp_count(text, F.lit(ANY_CASE)).cast("long").alias("n_words"))
    judged = counts.join(F.broadcast(found) if is_small(found) else found, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return judged.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
