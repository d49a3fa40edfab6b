"""Mixing sources by temperature.

The share of a source in all tokens is raised to an exponent between 0 (all sources alike)
and 1 (as they are), and normalised. The exponent is found by repeated section of that range
so that the mixture has a wanted entropy, unless a source would be repeated too often. The
weights, as budgets of tokens, are filled by passes over each source, every pass in another
order of blocks and of documents within blocks; the last pass stops where the budget ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linecheck.llm.common import free_name, stored

# Words are the tokens that are counted here.
WORD = r"[^\x20\x09-\x0D]+"

# Documents per block, on average. Windows over documents are no larger than about that.
BLOCK = 8192

# Exponents tried at once, and rounds of narrowing.
SECTIONS = 32
ROUNDS = 6


@dataclass(frozen=True)
class Target:
    """Wanted share of the highest possible entropy, most passes over a source, budget as a share of all tokens."""

    entropy: float
    passes: float
    budget: float = 1.0
    seed: int = 0


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _curves(totals: DataFrame, exponents: np.ndarray) -> list:
    """Per exponent: entropy of the mixture, sum of powers, and the most that a share is raised."""
    power = F.pow("share", "exponent")
    rows = totals.withColumn("exponent", F.explode(F.array(*[F.lit(float(e)) for e in exponents])))
    sums = rows.groupBy("exponent").agg(
        F.sum(power).alias("z"),
        F.sum(power * F.log("share")).alias("s"),
        F.max(power / F.col("share")).alias("most"),
    )
    found = sums.select(
        "exponent", (F.log("z") - F.col("exponent") * F.col("s") / F.col("z")).alias("entropy"), "z", (F.col("most") / F.col("z")).alias("raised")
    )
    return sorted(found.collect())


def _section(totals: DataFrame, holds) -> float | None:
    """The smallest exponent for which ``holds`` is true, given that it stays true above; none if never."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = _curves(totals, np.linspace(low, high, SECTIONS + 1))
        good = [row.exponent for row in tried if holds(row)]
        if not good:
            return None
        high = good[0]
        bad = [row.exponent for row in tried if row.exponent < high]
        if not bad:
            return high
        low = bad[-1]
    return high


def exponent(totals: DataFrame, target: Target) -> float:
    """The exponent for sources with their ``share`` of all tokens.

    The largest whose entropy is as wanted; larger where a source would be passed over too
    often; 1, the sources as they are, if nothing less keeps that limit.
    """
    n = totals.count()
    wanted = target.entropy * float(np.log(n)) if n else 0.0
    by_entropy = _section(totals, lambda row: row.entropy <= wanted + 1e-12)
    by_passes = _section(totals, lambda row: row.raised * target.budget <= target.passes)
    return max(1.0 if by_entropy is None else by_entropy, 1.0 if by_passes is None else by_passes)


def weights(rows: DataFrame, target: Target) -> DataFrame:
    """Per source (``source``, missing ones as one): ``tokens``, ``docs``, ``share``, ``weight`` and ``budget`` of tokens.

    Sources without tokens have no weight.
    """
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    totals = stored(totals.where("tokens > 0"), "mixing-totals")
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    totals = totals.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1))))
    e = exponent(totals, target)
    z = totals.agg(F.sum(F.pow("share", F.lit(e)))).first()[0] or 1.0
    weight = F.pow("share", F.lit(e)) / F.lit(z)
    return totals.withColumn("weight", weight).withColumn("budget", F.col("weight") * F.lit(target.budget * whole))


def schedule(docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """When each document is used: key, ``source``, ``n_tokens``, ``epoch`` (from 0) and ``position``.

    ``position`` says how much of its source's budget is used before the document, from 0
    to 1; rows in its order mix the sources in their weights all along. A document that does
    not fit into the rest of the budget ends its source. Rows with the same key and source,
    missing ones included, are used together and count as one. Documents without tokens, an
    empty or missing text among them, are used with the block they are in if their source
    has any tokens, else left out. No rows give no rows.
    """
    seed = F.lit(target.seed)
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"), n_tokens(F.col(text)).alias("tokens")
    )
    rows = stored(rows.groupBy("key", "source").agg(F.sum("tokens").alias("tokens")), "mixing-tokens")
    plan = stored(weights(rows, target), "mixing-weights").withColumnRenamed("tokens", "all_tokens")
    same = rows["source"].eqNullSafe(plan["source"])
    rows = rows.join(plan, same).select(rows["*"], "all_tokens", "docs", "budget")

    blocks = F.ceil(F.col("docs") / BLOCK)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(seed, "key"), blocks))
    last = F.ceil(F.col("budget") / F.col("all_tokens")) - 1
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long")))))

    sums = rows.groupBy("source", "epoch", "block").agg(F.sum("tokens").alias("in_block"))
    in_order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(seed, "epoch", "block"), "block")
    sums = sums.withColumn("before_block", F.sum("in_block").over(in_order) - F.col("in_block"))
    sums = stored(sums.drop("in_block"), "mixing-blocks").withColumnsRenamed({"source": "s", "epoch": "e", "block": "b"})

    within = Window.partitionBy("source", "epoch", "block").orderBy(F.xxhash64(seed, "epoch", "key"), "key")
    rows = rows.withColumn("before", F.sum("tokens").over(within) - F.col("tokens"))
    at = F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("block") == F.col("b"))
    used = F.col("epoch") * F.col("all_tokens") + F.col("before_block") + F.col("before")
    rows = rows.join(sums, at).withColumn("used", used)
    rows = rows.where(F.col("used") + F.col("tokens") <= F.col("budget") * (1 + 1e-12))
    return rows.select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        F.col("tokens").alias("n_tokens"),
        F.col("epoch"),
        (F.col("used") / F.col("budget")).alias("position"),
    )


def mixture(docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as often as the schedule uses them, with all their columns."""
    a, b = free_name(docs, "used_key"), free_name(docs, "used_source")
    used = schedule(docs, target, key, text, source).select(F.col(key).alias(a), F.col(source).alias(b))
    used = used.groupBy(a, b).agg(F.count("*").alias("times"))
    same = docs[key].cast("long").eqNullSafe(used[a]) & docs[source].cast("string").eqNullSafe(used[b])
    joined = docs.join(used, same).select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), used["times"])).alias(a))
    return joined.drop(a)
