import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.llm import bpe
from wattloom.llm.queries import TOKENIZER

RANKS = bpe.tokenizer_ranks(public_tokenizers.path(TOKENIZER))
REAL = tiktoken.Encoding("real", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    None,
    "",
    " ",
    "  a  b ",
    "it's 12 o'clock,\n\n  then\t\tit'll go \n",
    "a\x0bb \x0b c \x1c d\x1c e\x85 f\xa0g 　h  i",
    "<|endoftext|> <|im_start|>",
    "naïve Ünïcode 漢字 かな 😀 é ١٢٣ x​y \U0001d54f",
    "word " * 3000,
    "퟿\x00 nul\x00",
    "'s 't 're 'S don't",
]


def expected(text):
    ids = REAL.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, block int")
    return bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN).collect()


def test_equals_the_library(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS * 2)]
    found = {r.doc_id: tuple(r)[1:] for r in run(spark, rows)}
    assert found == {i: expected(t) for i, t, *_ in rows}


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b", "", 1), (3, "a b", "", 1), (3, "a b", "", 1)]
    assert sorted((r.doc_id is None, r.n_tokens) for r in run(spark, rows)) == [(False, 2), (False, 2), (True, 2)]


def test_blocks_with_the_same_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "it's d, e")], "doc_id bigint, text string").coalesce(1)
    twice = spark.createDataFrame(spark.sparkContext.parallelize([(3, "x y z")] * 2, 2), docs.schema)
    rows = docs.unionByName(docs).unionByName(docs).unionByName(twice)
    found = bpe.encode_digests(rows, RANKS, public_tokenizers.PATTERN).collect()
    texts = [(1, "a b c"), (2, "it's d, e")] * 3 + [(3, "x y z")] * 2
    assert sorted(map(tuple, found)) == sorted((i, *expected(t)) for i, t in texts)
    ids = bpe.encode(rows, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in ids) == sorted(texts)


def test_empty_table(spark):
    assert run(spark, []) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 's\n\t\x0b\x1c\xa0é1.,漢")), max_size=30), min_size=1, max_size=6))
def test_blocks_split_as_the_pattern_does(texts):
    import pyarrow as pa

    find = bpe._matcher(public_tokenizers.PATTERN)
    block = bpe._Block(pa.array(texts, pa.large_string()), find)
    for text, numbers in zip(texts, block.sequences):
        words = [block.words[int(i)].as_py() for i in numbers]
        assert "".join(words) == text
        assert [i for w in words for i in REAL.encode_ordinary(w)] == REAL.encode_ordinary(text)


def test_tokens_decode_to_the_text(spark):
    docs = spark.createDataFrame([(1, "it's a naïve test"), (2, ""), (3, None)], "doc_id bigint, text string")
    tokens = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    table = bpe.token_bytes(spark, RANKS)
    found = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in bpe.decode(tokens.drop("decoded"), table).collect()}
    assert found[1] == (REAL.encode_ordinary("it's a naïve test"), "it's a naïve test".encode())
    assert found[2] == found[3] == ([], b"")


def test_unknown_and_null_ids(spark):
    rows = spark.createDataFrame([(1, [0, 99_999_999]), (2, None)], "doc_id bigint, ids array<int>")
    found = bpe.decode(rows, bpe.token_bytes(spark, RANKS)).where(F.col("decoded").isNull())
    assert found.count() == 2


def test_lost_words_are_an_error():
    import pyarrow as pa

    press = bpe.zstandard.ZstdCompressor()
    places = pa.table({"doc_ids": [[1]], "lengths": [[1]], "places": [press.compress(b"\0\0\0\0")]})
    packs = pa.table({"pack": pa.array([], pa.binary())})
    with pytest.raises(RuntimeError):
        bpe._assemble(bpe._digests, pa.array([], pa.large_binary()))(7, places, packs)
