"""Byte-level BPE over a corpus by a global shuffle of distinct words.

Texts are cut into blocks of documents. A block sends each distinct pre-token once, and keeps one row per
document with the positions of its pre-tokens, packed. The pre-tokens of all blocks are shuffled by word,
each distinct word is encoded once, and its ids go back to the blocks that have it. There they are joined
with the table of token bytes, once for each distinct word, and documents are put together by position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wattloom.llm.arrowtext import blocks, filled

_WORDS = "block bigint, word_no int, word string"
_PLACES = "block bigint, doc_ids array<bigint>, lengths array<bigint>, places binary"
_PACKED = "block bigint, pack binary"
_ENCODED = "doc_id bigint, ids array<int>, decoded binary"
_DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# Words that one Arrow batch sends back to a block travel as one packed row.
_LEVEL = 3

# Larger blocks have fewer distinct words between them, so less is shuffled; this many bytes of text keep a
# task that puts a block together well within its memory.
WORD_BLOCK = 32 << 20

# A single blank before a visible character, after a visible one, is always where a pre-token begins.
# Texts with any other blank next to white space are matched as a whole.
_OTHER_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_IRREGULAR = r"[\s\x0B]\x20|\x20[\s\x0B]|^\x20|\x20$"


def tokenizer_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The token-byte table: token_id, token. As large as the vocabulary, whatever the corpus."""
    rows = [(rank, bytearray(token)) for token, rank in ranks.items()]
    return spark.createDataFrame(rows, "token_id int, token binary")


def _matcher(pattern: str) -> Callable[[str], list[str]]:
    # White space by the Unicode property: the separators U+001C to U+001F are not white space.
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall


# A blank or none, letters that every version of Unicode has as such, and plain punctuation: two pre-tokens at most.
_SIMPLE = r"^(?P<head> ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<tail>[.,;:!?]*)$"


class _Block:
    """Distinct pre-tokens of a block, and for each text the numbers of its pre-tokens in order.

    Texts are cut at single blanks. Only the distinct pieces, and whole texts with other blanks next to
    white space, meet the pattern; for most pieces, letters and punctuation, its result is known.
    """

    def __init__(self, texts: pa.Array, find: Callable[[str], list[str]]):
        odd = pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        odd = odd | pc.match_substring_regex(texts, _OTHER_SPACE).to_numpy(zero_copy_only=False)

        pieces = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        units = pieces.flatten().dictionary_encode()
        starts = pieces.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        n = len(units.dictionary)
        use = units.indices.to_numpy().astype(np.int64) + n  # with a blank before it
        use[starts[:-1]] -= n  # the first piece of a text has none
        present = np.zeros(2 * n, bool)
        present[use] = True
        uses = np.flatnonzero(present)
        use = (np.cumsum(present) - 1)[use]

        names = units.dictionary.take(pa.array(uses % max(n, 1)))
        blank = pa.array(np.array(["", " "], object)[(uses >= n).astype(int)], names.type)
        names = pc.binary_join_element_wise(blank, names, pa.scalar("", names.type))
        parts = pc.extract_regex(names, _SIMPLE)
        simple = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        known = parts.filter(pa.array(simple))
        heads, tails = known.field("head"), known.field("tail")
        tailed = pc.binary_length(tails).to_numpy() > 0
        others = [find(name) for name in names.filter(pa.array(~simple)).to_pylist()]
        whole = [find(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        pool = pa.concat_arrays(
            [heads.cast(pa.string()), tails.filter(pa.array(tailed)).cast(pa.string())]
            + [pa.array(chain.from_iterable(x), pa.string()) for x in (others, whole)]
        ).dictionary_encode()
        self.words, codes = pool.dictionary, pool.indices.to_numpy()

        # Where the pre-tokens of each use are in the pool.
        counts = np.empty(len(uses), np.int64)
        counts[simple] = 1 + tailed
        counts[~simple] = [len(x) for x in others]
        first = np.concatenate([[0], np.cumsum(counts)])
        at = np.empty(first[-1], np.int64)
        n_heads, n_tails, n_others = len(heads), int(tailed.sum()), sum(map(len, others))
        at[first[:-1][simple]] = np.arange(n_heads)
        at[first[:-1][simple][tailed] + 1] = n_heads + np.arange(n_tails)
        at[np.repeat(~simple, counts)] = n_heads + n_tails + np.arange(n_others)

        ends = np.cumsum(counts[use])
        sequence = codes[at[np.repeat(first[use] - (ends - counts[use]), counts[use]) + np.arange(ends[-1] if len(ends) else 0)]]
        bounds = np.concatenate([[0], ends])[starts]
        self.sequences: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        for row, low, high in zip(np.flatnonzero(~odd), bounds[:-1], bounds[1:]):
            self.sequences[row] = sequence[low:high]
        low = n_heads + n_tails + n_others
        for row, found in zip(np.flatnonzero(odd), whole):
            self.sequences[row] = codes[low : low + len(found)]
            low += len(found)


def _block_number(ids: pa.Array, texts: pa.Array) -> int:
    """Named by its contents: a task that ran again on other rows can't pass for the same block."""
    state = xxhash.xxh3_64(str(ids.to_pylist()).encode())
    for text in texts:
        state.update(text.as_buffer())
        state.update(b"\0\xff")
    return int(np.uint64(state.intdigest()).view(np.int64))


def _cut(pattern: str, words: bool):
    """Rows of distinct words, or rows of positions, of each block."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _matcher(pattern)
        press = zstandard.ZstdCompressor(level=_LEVEL)
        for batch in blocks(batches, 1, WORD_BLOCK):
            texts = filled(batch.column(1))
            number = _block_number(batch.column(0), texts)
            block = _Block(texts, find)
            sequence = np.concatenate(block.sequences)
            # The most frequent words get the smallest numbers, which pack best.
            order = np.argsort(-np.bincount(sequence, minlength=len(block.words)), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            if words:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(order), number, np.int64)),
                        pa.array(rank.astype(np.int32)),
                        block.words,
                    ],
                    names=["block", "word_no", "word"],
                )
                continue
            planes = np.ascontiguousarray(rank[sequence].view(np.uint8).reshape(-1, 4).T)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(s) for s in block.sequences]], pa.list_(pa.int64())),
                    pa.array([press.compress(planes.tobytes())], pa.binary()),
                ],
                names=["block", "doc_ids", "lengths", "places"],
            )

    return cut


def _encode_words(ranks: dict[bytes, int], pattern: str):
    """Rows come sorted by word: each distinct word is encoded once, and its ids go to all its blocks.

    All that a batch has for the same block becomes one packed row.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        press = zstandard.ZstdCompressor(level=_LEVEL)
        last: tuple[str | None, list[int]] = (None, [])
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(2).dictionary_encode()
            names = words.dictionary.to_pylist()
            lists = [last[1] if name == last[0] else encoding.encode_ordinary(name) for name in names]
            last = (names[-1], lists[-1])
            ids = pa.array(lists, pa.list_(pa.int32())).take(words.indices)

            owner = batch.column(0).to_numpy()
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]])
            rest = pa.record_batch([batch.column(1), ids], names=["word_no", "ids"]).take(pa.array(order))
            packs = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as writer:
                    writer.write_batch(rest.slice(low, high - low))
                packs.append(press.compress(sink.getvalue().to_pybytes()))
            yield pa.RecordBatch.from_arrays([pa.array(owner[cuts[:-1]]), pa.array(packs, pa.binary())], names=["block", "pack"])

    return encode


def _unpack(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(pack)).read_all()


def _assemble(finish: Callable[[pa.ListArray, pa.Array], Callable[[np.ndarray], tuple]], tokens: pa.Array):
    """Documents of one block from its words' ids and its documents' positions.

    ``tokens`` is the token-byte table by id; the ids of each distinct word are joined with it.
    """

    def assemble(block: int, places: pa.Table, packs: pa.Table) -> list[tuple]:
        parts = [_unpack(p) for p in packs["pack"].to_pylist()]
        n_words, ids = 0, pa.array([], pa.list_(pa.int32()))
        if parts:
            words = pa.concat_tables(parts).combine_chunks()
            # Blocks with the same rows share a number, and each of them sends all its words.
            numbers, first = np.unique(words["word_no"].to_numpy(), return_index=True)
            n_words = len(numbers)
            ids = words["ids"].combine_chunks().take(pa.array(first))
        pieces = pa.LargeListArray.from_arrays(ids.offsets.cast(pa.int64()), tokens.take(ids.values))
        make = finish(ids, pc.binary_join(pieces, pa.scalar(b"", tokens.type)))
        rows = []
        for doc_ids, lengths, pack in zip(*(places[c].to_pylist() for c in ("doc_ids", "lengths", "places"))):
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(pack) if sum(lengths) else b"", np.uint8)
            numbers = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
            if len(numbers) and int(numbers.max()) >= n_words:
                raise RuntimeError(f"block {block} misses words: its input changed between two readings")
            ends = np.cumsum(lengths)
            rows += [(doc_id, *make(numbers[e - n : e])) for doc_id, n, e in zip(doc_ids, lengths, ends)]
        return rows

    return assemble


def _tokens(ids: pa.ListArray, decoded: pa.Array):
    lists, pieces = ids.to_pylist(), decoded.to_pylist()

    def make(at: np.ndarray) -> tuple:
        order = at.tolist()
        return [x for i in order for x in lists[i]], b"".join([pieces[i] for i in order])

    return make


def _digests(ids: pa.ListArray, decoded: pa.Array):
    lengths = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    decimals = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
    texts, pieces = pc.binary_join(decimals, ",").to_pylist(), decoded.to_pylist()

    def make(at: np.ndarray) -> tuple:
        order = at.tolist()
        return (
            int(lengths[at].sum()),
            hashlib.sha256(",".join([texts[i] for i in order]).encode()).hexdigest(),
            hashlib.sha256(b"".join([pieces[i] for i in order])).hexdigest(),
        )

    return make


def decode(tokens_of: DataFrame, tokens: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``tokens_of`` with the column ``decoded``: the bytes of its ids, by a join with the token-byte table.

    The table has one row per vocabulary entry and is broadcast. Null ids give null, no ids give no
    bytes, an unknown id gives null. Rows keep their other columns.
    """
    ids = tokens_of.select(F.col(ids_col).alias("ids")).where(F.col("ids").isNotNull()).distinct()
    pieces = ids.select("ids", F.posexplode_outer("ids").alias("at", "token_id")).join(F.broadcast(tokens), "token_id", "left")
    ordered = F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("at", "token"))))
    joined = F.aggregate(ordered, F.lit(b""), lambda done, x: F.concat(done, x["token"]))
    decoded = pieces.groupBy("ids").agg(F.when(F.count("token") == F.count("token_id"), joined).alias("decoded"))
    return tokens_of.join(decoded.withColumnRenamed("ids", ids_col), ids_col, "left")


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # A block sends a word once, so the most frequent word has no more rows here than there are blocks.
    sent = source.mapInArrow(_cut(pattern, words=True), _WORDS).repartition("word").sortWithinPartitions("word")
    packs = sent.mapInArrow(_encode_words(ranks, pattern), _PACKED)
    places = source.mapInArrow(_cut(pattern, words=False), _PLACES)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    assemble = _assemble(finish, pa.array(table, pa.large_binary()))
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = list(zip(*assemble(key[0].as_py(), left, right))) or [[]] * len(arrow)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return places.groupBy("block").cogroup(packs.groupBy("block")).applyInArrow(run, schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded for each row of ``docs``: token ids of the whole text, and their bytes.

    A null text is empty; an empty text has no ids; a very long text is a block by itself. Repeated rows and null
    identifiers each give their row. An empty table gives no rows; other columns aren't read.
    """
    return _encoded(docs, ranks, pattern, id_col, text_col, _tokens, _ENCODED)


def encode_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, but doc_id, n_tokens, ids_sha256, decoded_sha256: nothing as long as a text comes out."""
    return _encoded(docs, ranks, pattern, id_col, text_col, _digests, _DIGESTS)
