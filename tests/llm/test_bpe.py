import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from linecheck.llm import bpe
from tests.llm.cases import awkward_docs, awkward_texts, no_docs

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.parsed(file.read())


def known(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(merges, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in merges.encode(texts)]


def test_ids_equal_the_library(ranks):
    rnd = random.Random(1)
    letters = "abehilnorst  '\n\t.,!1234567890éñ漢字👍ABĳ​\x00<|>"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 80))) for _ in range(2000)]
    texts += [t or "" for t in awkward_texts()] + ["a" * 3000, " " * 999, "<|endoftext|>", "it's we'll'd"]
    merges = bpe.Merges(ranks, public_tokenizers.PATTERN)
    assert encoded(merges, texts) == [known(ranks).encode_ordinary(t) for t in texts]
    assert [merges.decode(ids).decode() for ids in merges.encode(texts)] == texts


def test_a_merge_may_make_a_pair_of_lower_rank():
    # "abc" ranks below "ab": after the first "ab", the pair "ab" "c" goes before the second.
    words = [b"abc", b"ab", b"bc", b"abcab", b"cab", b"caba"]
    for seed in range(40):
        rnd = random.Random(seed)
        order = rnd.sample(words, len(words))
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate(order)}
        merges = bpe.Merges(ranks, r"[a-c]+|[^a-c]+")
        own = tiktoken.Encoding("own", pat_str=r"[a-c]+|[^a-c]+", mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rnd.choices("abc", k=rnd.randint(1, 25))) for _ in range(60)]
        assert encoded(merges, texts) == [own.encode_ordinary(t) for t in texts]


def test_small_memory_gives_the_same(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "PIECE", 200)
    monkeypatch.setattr(bpe, "CUT", 7)
    texts = [t or "" for t in awkward_texts()[:20]]
    merges = bpe.Merges(ranks, public_tokenizers.PATTERN)
    assert encoded(merges, texts) == [known(ranks).encode_ordinary(t) for t in texts]


def test_columns(spark, ranks):
    docs = awkward_docs(spark, clashes=True)
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    rows = docs.withColumn("ids", tokenizer.ids(F.col("text"))).select(
        "text", bpe.numbers(F.col("ids")).alias("ids"), tokenizer.text(F.col("ids")).alias("back"), tokenizer.round_trip(F.col("text")).alias("both")
    )
    found = rows.collect()
    assert len(found) == docs.count()
    for row in found:
        assert row.ids == known(ranks).encode_ordinary(row.text or "")
        assert row.back.decode() == (row.text or "") == row.both.bytes.decode()
        assert np.frombuffer(row.both.ids, "<u4").tolist() == row.ids
    assert no_docs(spark).select(tokenizer.round_trip(F.col("text"))).count() == 0


def test_ranks_without_all_bytes_are_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Merges({b"a": 0}, "a")
