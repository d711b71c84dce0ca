import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattloom.llm import token_files as module
from wattloom.llm.token_files import TokenFile, pack_file, read_documents, token_files, tokens_at, write_tokens

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [None, "", " ", "\n\n x", "it's  we'll", "a\x1cb\x85c\xa0d", "ABC 123\t\r\n  é 漢字  🙂", "<|endoftext|> x", "　 y ", "x" * 9000 + " ", "'s''s 's", "\x00\x01"]


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def brute(rows):
    """Rows in order: identifier, tokens before, tokens with the end, checksum."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(library().encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@pytest.mark.parametrize("top", [200, 70_000, 1 << 31])
def test_any_token_is_found_by_its_number(top):
    draw = np.random.default_rng(top)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (draw.pareto(0.3, n) * 50).clip(0, top).astype(np.uint32)
        file = TokenFile(pack_file(3, 4, [7, None], np.array([n, 0]), ids))
        assert (file.shard, file.part, file.n_tokens, file.doc_ids, file.starts.tolist()) == (3, 4, n, [7, None], [0, n, n])
        assert [file.token(i) for i in range(n)] == ids.tolist() == file.tokens(0, n).tolist()
        for a, b in draw.integers(0, n + 1, (20, 2)):
            assert file.tokens(min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)].tolist()


@pytest.mark.parametrize("file_tokens", [8 << 20, 60, 1])
def test_equals_the_library(spark, tmp_path, file_tokens):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    rows = [(-len(ODD) + i, t) for i, t in enumerate(ODD)] + [tuple(r) for r in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    write_tokens(docs, str(tmp_path / "files"), PATH, PATTERN, file_tokens=file_tokens)
    assert found(read_documents(spark, str(tmp_path / "files"))) == brute(rows)


def test_random_access_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "FILE_TOKENS", 64)
    rows = [(i, f"word {i} " * (i % 40)) for i in range(50)]
    path = str(tmp_path / "files")
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), path, PATH, PATTERN, file_tokens=100)
    ids = [x for _, t in rows for x in library().encode(t, add_special_tokens=False).ids + [0]]
    asked = spark.createDataFrame([(i,) for i in [*range(0, len(ids), 3), 0, -1, None, len(ids), 10**12]], "position bigint")
    assert {tuple(r) for r in tokens_at(spark, path, asked, slice_size=16).collect()} == {(i, ids[i]) for i in range(0, len(ids), 3)}


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    rows = [(None, "one two", 1), (5, "b", 2), (5, "b", 3), (4, None, 4), (6, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int").selectExpr("*", "1 AS start", "'x' AS data", "2 AS shard")
    assert found(token_files(docs, PATH, PATTERN)) == brute([(None, "one two"), (4, None), (5, "b"), (5, "b"), (6, "")])


def test_one_identifier_with_all_rows_is_spread(spark, tmp_path):
    docs = spark.range(4000).selectExpr("7 AS doc_id", "repeat('some text ', 50) AS text").repartition(8)
    write_tokens(docs, str(tmp_path / "files"), PATH, PATTERN)
    read = read_documents(spark, str(tmp_path / "files"))
    size = len(library().encode("some text " * 50, add_special_tokens=False).ids) + 1
    assert sorted(r.start for r in read.select("start").collect()) == [i * size for i in range(4000)]


def test_empty_table(spark):
    assert token_files(spark.createDataFrame([], "doc_id bigint, text string"), PATH, PATTERN).collect() == []
