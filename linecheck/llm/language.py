"""Language identification in two steps.

Linear support vector machines first tell the family of a text's language, one against the
rest, and then languages within the family, one against one. Features are frequencies of
hashed strings of one to three bytes; everything but letters counts as a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import PIECE, stored

UNKNOWN = "und"
FEATURES = 2048

# Bound of what is learned from: about so many documents of each language, chosen by a hash
# of their ids. If there are more than so many languages, all of them share as many documents
# as these would have, and the least documents of each are learned in any case.
SAMPLE = 1000
LANGUAGES = 100
LEAST = 20

# Families of languages by their codes. A language not listed is its own family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ast ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "indo-aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt ti",
    "austronesian": "ceb id jv mg ms su tl",
    "sinitic": "wuu yue zh",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = regex.compile(r"\p{L}")
_SOUNDS = np.full(256, 32, np.int64)
_SOUNDS[97:123] = np.arange(97, 123)
_SOUNDS[65:91] = np.arange(97, 123)
_SOUNDS[0x80:] = np.arange(0x80, 0x100)


def family(language: str) -> str:
    return _FAMILY.get(language, f"own {language}")


def features(text: str) -> np.ndarray | None:
    """Square roots of frequencies, of length 1; none if the text has no letter."""
    if not _LETTER.search(text):
        return None
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, len(raw), PIECE):
        a = _SOUNDS[np.frombuffer(raw, np.uint8, min(PIECE, len(raw) - at), at)]
        counts[:256] += np.bincount(a, minlength=256)
        two = (a[:-1] * 31 + a[1:]) * 2654435761
        three = (a[:-2] * 961 + a[1:-1] * 31 + a[2:]) * 2246822519
        rest = FEATURES - 256
        for grams in (two, three):
            counts[256:] += np.bincount(((grams & 0xFFFFFFFF) >> 11) % rest, minlength=rest)
    counts[32] = 0
    root = np.sqrt(counts.astype(np.float64))
    return root / np.sqrt(counts.sum()) if counts.any() else root


@dataclass(frozen=True)
class Model:
    """Weights and offsets: of families against the rest, and of pairs of languages of a family."""

    families: list[str]
    by_family: np.ndarray
    languages: dict[str, list[str]]
    by_pair: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure that is, from 0 to 1."""
        x = features(text or "") if self.families else None
        if x is None:
            return UNKNOWN, 0.0
        x = np.append(x, 1.0)
        margins = self.by_family @ x
        best = int(margins.argmax())
        sure = 1.0 if len(self.families) == 1 else _sure(margins[best])
        inside = self.languages[self.families[best]]
        if len(inside) == 1:
            return inside[0], sure
        votes = dict.fromkeys(inside, 0)
        margin = dict.fromkeys(inside, 0.0)
        for a, b in combinations(inside, 2):
            m = float(self.by_pair[a, b] @ x)
            votes[a if m >= 0 else b] += 1
            margin[a] += m
            margin[b] -= m
        winner = max(inside, key=lambda name: (votes[name], margin[name]))
        return winner, sure * _sure(margin[winner] / (len(inside) - 1))


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def _fitted(rows: DataFrame, positive: Column) -> np.ndarray:
    svm = LinearSVC(featuresCol="features", labelCol="label", maxIter=30, regParam=1e-3, standardization=False)
    model = svm.fit(rows.withColumn("label", positive.cast("double")))
    return np.append(model.coefficients.toArray(), model.intercept)


def _place() -> Column:
    """A number from 0 to 1 that depends on the row's key."""
    return F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang") -> Model:
    """A model of documents with a language; rows without key, text, letters or language are left out.

    Without any there is a model that knows no language. Every language that occurs is learned.
    Repeated rows count as often as they occur.
    """
    known = docs.select(
        F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"), F.col(language).alias("lang")
    ).dropna()
    counts = stored(known.groupBy("lang").agg(F.count("*").alias("n"), F.min(_place()).alias("first")), "language-counts")
    many = counts.count()
    each = max(LEAST, min(SAMPLE, SAMPLE * LANGUAGES // max(many, 1)))
    # The first document of a language always counts, so that none is lost by chance.
    bounds = counts.select("lang", (F.lit(each) / F.col("n")).alias("share"), "first")
    place = _place()
    chosen = known.join(bounds, "lang").where((place < F.col("share")) | (place == F.col("first")))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, features(text)) for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            rows = [row for row in rows if row[1] is not None]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([r[0] for r in rows], pa.string()), "x": pa.array([r[1] for r in rows], pa.list_(pa.float64()))}
            )

    sample = stored(chosen.select("text", "lang").mapInArrow(described, "lang string, x array<double>"), "language-sample")
    names = sorted(row.lang for row in sample.select("lang").distinct().collect())
    if not names:
        return Model([], np.empty((0, 0)), {}, {})
    inside: dict[str, list[str]] = {}
    for name in names:
        inside.setdefault(family(name), []).append(name)
    families = sorted(inside)
    vectors = sample.select("lang", array_to_vector("x").alias("features"))
    of = {f: F.col("lang").isin(inside[f]) for f in families}
    if len(families) == 1:
        by_family = np.zeros((1, FEATURES + 1))
    elif len(families) == 2:
        one = _fitted(vectors, of[families[0]])
        by_family = np.stack([one, -one])
    else:
        by_family = np.stack([_fitted(vectors, of[f]) for f in families])
    pairs = {
        (a, b): _fitted(vectors.where(F.col("lang").isin(a, b)), F.col("lang") == a)
        for f in families
        for a, b in combinations(inside[f], 2)
    }
    return Model(families, by_family, inside, pairs)


def identified(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, ``lang_pred`` and ``score`` from 0 to 1.

    A missing text, and one without letters, is ``und`` with score 0, as is every text under
    a model that knows no language. Whole texts count; rows are judged one by one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [key, "lang_pred", "score"],
            )

    rows = docs.select(F.col(key), F.col(text).cast("string"))
    return rows.mapInArrow(predicted, f"`{key}` {kind.simpleString()}, lang_pred string, score double")
