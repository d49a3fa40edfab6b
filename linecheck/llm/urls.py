"""URL filters: stated rules, and rules mined from labels by Spark's FP-growth.

A URL is a set of tokens (labels of its host, segments of its path, keys of its query).
Frequent sets of tokens of labelled pages give association rules; those that say "block"
with enough support and confidence are kept and matched through an index from token to
rule. Everything is DataFrame functions and ``pyspark.ml``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import free_name, stored

# Fixed values.
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"

# The number of the document that a page shows: a path's last segment, as /en/7817 or /en/7817.html.
NUMBER = r"/([0-9]+)(?:\.[^/]*)?/?$"

# Mined rules need so much of the labelled pages and so many at least that are blocked, and so
# large a share of blocked ones.
MIN_SUPPORT = 0.002
MIN_PAGES = 10
MIN_CONFIDENCE = 0.5


def _part(url: Column, n: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, n), F.lit(""))


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), CAPITALS, SMALL)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def document(url: Column) -> Column:
    """The id of the document that the page shows, from its path; null if there is none."""
    return F.regexp_extract(path(url), NUMBER, 1).try_cast("long")


def tokens(url: Column) -> Column:
    """Host labels, path segments that are no numbers, and query keys, each once."""
    marked = [
        F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("host="), x)),
        F.transform(F.split(path(url), "/"), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, r"^\d+", "0"))),
        F.transform(F.split(_part(url, 3), "&"), lambda x: F.concat(F.lit("key="), F.split_part(x, F.lit("="), F.lit(1)))),
    ]
    return F.array_distinct(F.filter(F.concat(*marked), lambda x: ~F.endswith(x, F.lit("="))))


def stated(host_of: Column, path_of: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the rules (``host/path``, verdict) that fits, as a struct; else null.

    A rule fits its host and all subdomains if the path starts with the rule's path.
    """
    result = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        inside = (host_of == name) | F.endswith(host_of, F.lit(f".{name}"))
        fits = inside & F.startswith(path_of, F.lit(f"/{rest}"))
        result = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(result)
    return result


def mined(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Rules (``rule_id``, ``items``, ``confidence``, ``support``) from rows with ``url`` and ``blocked``.

    A rule whose items contain those of another rule of at least its confidence says
    nothing new and goes; so does one with fewer than ``min_pages`` blocked rows, however
    few rows there are. Rows without URL or label are left out; without any there are no
    rules. The rules are stored, so they are mined once.
    """
    known = labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull())
    mark = F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    baskets = known.select(F.concat(tokens(F.col("url")), mark).alias("items"))
    n = max(baskets.count(), 1)
    # Less than a whole page under the least number, as a share may be rounded up.
    share = min(1.0, max(min_support, (min_pages - 0.5) / n))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK)))
    found = found.where(F.round(F.col("support") * n) >= min_pages)
    found = found.select(
        F.array_sort("antecedent").alias("items"), "confidence", "support", F.size("antecedent").alias("n_items")
    )
    rules = stored(found.withColumn("rule_id", F.xxhash64("items")), "url-rules")

    # Subsets meet through the index as well: a smaller rule all of whose items the larger has.
    small = rules.select(F.col("rule_id").alias("small"), F.col("n_items").alias("n_small"), F.col("confidence").alias("least"), F.explode("items").alias("item"))
    large = rules.select("rule_id", "n_items", "confidence", F.explode("items").alias("item"))
    inner = large.join(small, "item").where((F.col("n_small") < F.col("n_items")) & (F.col("least") >= F.col("confidence")))
    inner = inner.groupBy("rule_id", "small", "n_small").agg(F.count("*").alias("n")).where("n = n_small")
    return rules.join(inner, "rule_id", "left_anti")


def matched(pages: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """Keys of the pages all of whose tokens some rule demands, each once."""
    index = rules.select("rule_id", "n_items", F.explode("items").alias("item"))
    rows = pages.select(F.col(key), F.explode(tokens(F.col("url"))).alias("item"))
    hits = rows.join(index, "item").groupBy(key, "rule_id", "n_items").agg(F.count_distinct("item").alias("n"))
    return hits.where("n = n_items").select(key).distinct()


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]], blocking: DataFrame, key: str = "page_id"
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict``: the stated rule's, else the mined ones'.

    A missing URL, or one without ``://``, has empty host and path, fits no rule and is
    allowed. Pages are matched by their URL, so rows that repeat, or share or lack a key,
    are each judged by their own URL. Other columns are kept, unless they bear one of the
    four names.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    stem = free_name(pages, "stem")
    rows = pages.select(*[F.col(f"`{c}`") for c in kept])
    rows = rows.withColumn(stem, F.array_join(F.array_sort(tokens(F.col("url"))), "\n"))
    shapes = rows.select(F.col(stem).alias("shape"), "url").groupBy("shape").agg(F.min("url").alias("url"))
    hit = matched(shapes, blocking, "shape")
    rows = rows.join(hit, rows[stem] == hit["shape"], "left")
    h, p = host(rows["url"]), path(rows["url"])
    by_rule = stated(h, p, rules)
    mined_verdict = F.when(hit["shape"].isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *[rows[f"`{c}`"] for c in kept],
        h.alias("host"),
        p.alias("path"),
        by_rule["rule"].alias("rule"),
        F.coalesce(by_rule["verdict"], mined_verdict).alias("verdict"),
    )
