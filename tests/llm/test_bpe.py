import base64
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def raw():
    return bpe.read_ranks()


@pytest.fixture(scope="module")
def reference(raw):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=bpe.BYTE_BPE_50K, mergeable_ranks=ranks, special_tokens={})


def test_equals_a_public_implementation(raw, reference):
    encoder, r = bpe.Encoder(raw), random.Random(7)
    texts = ["", " ", "\n\n", "a", "<|endoftext|>", "don't we'll", "ab" * 5000, "日本語" * 400, "‍👩‍🚀", "x" * 10_000]
    texts += ["".join(r.choice("abcé日 \n.,'1😀\t") for _ in range(r.randint(0, 80))) for _ in range(400)]
    for t in texts:
        assert encoder.encode(t) == reference.encode_ordinary(t)
        assert encoder.count(t) == len(reference.encode_ordinary(t))


def test_leftmost_of_equal_ranks_first(raw):
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256}
    assert bpe.bpe_merge(b"aaaaa", ranks) == [256, 256, 97]


def test_null_empty_repeated_and_extra_columns(spark, reference):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "Hello there", 9), (3, "Hello there", 9), (None, " ", 9)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id or 0, r.ids) for r in bpe.encode_ids(df).collect() if r.ids is not None)
    assert got == [(0, reference.encode_ordinary(" ")), (2, [])] + [(3, reference.encode_ordinary("Hello there"))] * 2
    assert bpe.encode_ids(df).where("ids is null").select("doc_id").collect()[0][0] == 1
    assert bpe.encode_ids(df.limit(0)).count() == 0


def test_round_trip(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in df.join(bpe.encode_ids(df), "doc_id").where(F.col("text").isNotNull()).select("text", "ids").collect():
        assert reference.decode(r.ids) == r.text


def test_another_vocabulary_needs_its_pattern(spark):
    with pytest.raises(ValueError, match="pattern"):
        bpe.encode_ids(spark.createDataFrame([(1, "x")], "doc_id long, text string"), name="other")
    assert bpe.pattern_of("other", "x") == "x" and bpe.pattern_of("byte_bpe_50k", None) == bpe.BYTE_BPE_50K
