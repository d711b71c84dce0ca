"""Token files with directly addressable codes: any token by its number, without decoding a block.

Documents are sorted by identifier over the whole corpus. Their token ids, each document closed by an end
id, go to binary files of whole documents. Inside a file the ids are split into chunks of eight bits. Level 0
holds the lowest chunk of every id; where an id is larger, a bit is set in the level's continuation bitmap and
the next chunk is on the next level, at the place that the number of set bits before it gives. A rank directory
holds that number for every 512th bit, so a token is found with at most one short popcount a level.

File format, little-endian, every section padded to eight bytes:
  magic 'WTOK', u32 version, u32 shard, u32 part, u64 documents, u64 tokens, u64 levels
  documents x i64 identifier, documents x u8 (1 where there is one), (documents + 1) x u64 first token
  for each level: u64 chunks, chunks x u8, and for all levels but the last the bitmap, bits from the lowest on,
  and u32 set bits before each stretch of 512
and one line feed at the end. Files of a shard are numbered by part, shards by their place in the order.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm.arrowtext import blocks, filled
from wattloom.llm.bpe import _Block, _matcher
from wattloom.session import fresh_dir
from wattloom.sources.tables import stage

# The id that closes each document.
END = 0
# Tokens after which a file is closed; it holds whole documents, and a longer document is a file by itself.
FILE_TOKENS = 4 << 20
# Bytes of text whose distinct pre-tokens are encoded together, and pre-tokens that a task remembers.
ENCODE_BLOCK = 6 << 20
REMEMBERED = 300_000

_MAGIC, _VERSION = b"WTOK", 1
_HEAD = struct.Struct("<4sIIIQQQ")
_STRETCH = 512

_DOCS = "shard bigint, part bigint, place bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"
_FOUND = "shard bigint, part bigint, position bigint, token_id bigint"


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def pack_levels(ids: np.ndarray) -> list[bytes]:
    """The sections of all levels of an array of ids."""
    sections, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        sections += [struct.pack("<Q", len(rest)), _padded((rest & 0xFF).astype(np.uint8).tobytes())]
        if not more.any():
            return sections
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (_STRETCH // 8)))
        counts = np.bitwise_count(bits).reshape(-1, _STRETCH // 8).sum(axis=1, dtype=np.int64)
        before = np.cumsum(counts) - counts
        sections += [bits.tobytes(), _padded(before.astype("<u4").tobytes())]
        rest = rest[more] >> 8


def pack_file(shard: int, part: int, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file, without the line feed."""
    levels = pack_levels(ids)
    n_levels = (len(levels) + 2) // 4
    known = np.array([x is not None for x in doc_ids], np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    head = _HEAD.pack(_MAGIC, _VERSION, shard, part, len(doc_ids), len(ids), n_levels)
    names = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    return b"".join([_padded(head), names, _padded(known.tobytes()), starts.tobytes(), *levels])


class TokenFile:
    """Reads a file's bytes in place."""

    def __init__(self, data):
        self._data, self._at = memoryview(data), 0
        magic, version, self.shard, self.part, self.n_docs, self.n_tokens, n_levels = _HEAD.unpack_from(self._data)
        if magic != _MAGIC or version != _VERSION:
            raise ValueError("not a token file of this version")
        self._skip(_HEAD.size)
        names, known = self._take("<i8", self.n_docs), self._take(np.uint8, self.n_docs)
        self.doc_ids = [int(x) if ok else None for x, ok in zip(names, known)]
        self.starts = self._take("<u8", self.n_docs + 1).astype(np.int64)
        self._levels = []
        for level in range(n_levels):
            n = int(self._take("<u8", 1)[0])
            chunks, bits, before = self._take(np.uint8, n), None, None
            if level < n_levels - 1:
                stretches = -(-n // _STRETCH)
                bits, before = self._take(np.uint8, stretches * (_STRETCH // 8)), self._take("<u4", stretches)
            self._levels.append((chunks, bits, before))

    def _skip(self, size: int) -> None:
        self._at += size + -size % 8

    def _take(self, kind, n: int) -> np.ndarray:
        found = np.frombuffer(self._data, kind, n, self._at)
        self._skip(found.nbytes)
        return found

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level before place ``at``."""
        chunks, bits, before = self._levels[level]
        stretch = min(at // _STRETCH, len(before) - 1)
        whole = bits[stretch * (_STRETCH // 8) : at // 8]
        rest = int(bits[at // 8]) & ((1 << at % 8) - 1) if at % 8 else 0
        return int(before[stretch]) + int(np.bitwise_count(whole).sum()) + rest.bit_count()

    def token(self, at: int) -> int:
        """The id of token ``at``."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self._levels):
            value |= int(chunks[at]) << 8 * level
            if bits is None or not int(bits[at // 8]) >> at % 8 & 1:
                break
            at = self._rank(level, at)
        return value

    def tokens(self, first: int, end: int, level: int = 0) -> np.ndarray:
        """The ids of tokens ``first`` to ``end``, without the last; reads only their stretch of each level."""
        chunks, bits, _ = self._levels[level]
        found = chunks[first:end].astype(np.uint32)
        if bits is None or end <= first:
            return found
        more = np.unpackbits(bits[first // 8 : -(-end // 8)], bitorder="little")[first % 8 :][: end - first].astype(bool)
        if more.any():
            found[more] |= self.tokens(self._rank(level, first), self._rank(level, end), level + 1) << 8
        return found


def _byte_letters() -> dict[int, str]:
    """Fixed rule of byte-level vocabularies: visible bytes stand for themselves, others for letters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in visible]
    return {x: chr(x) for x in visible} | {x: chr(256 + at) for at, x in enumerate(hidden)}


class Encoder:
    """Ids of texts by a byte-level tokenizer. Each distinct pre-token of a block meets the merges once."""

    def __init__(self, definition: str, pattern: str):
        tokenizer = Tokenizer.from_str(definition)
        if tokenizer.normalizer is not None or type(tokenizer.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError("no plain byte-level tokenizer")
        self._merge = tokenizer.model.tokenize
        self._find, self._letters = _matcher(pattern), _byte_letters()
        self._known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """The ids of a pre-token, four bytes each."""
        ids = self._known.get(word)
        if ids is None:
            letters = word.encode().decode("latin-1").translate(self._letters)
            ids = self._known[word] = array("I", [t.id for t in self._merge(letters)]).tobytes()
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, each text closed by the end id, and their number for each text."""
        block = _Block(texts, self._find)
        if len(self._known) > REMEMBERED:
            self._known = {}
        # One more word: the end of a text.
        lists = [self._word(w) for w in block.words.to_pylist()] + [array("I", [END]).tobytes()]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), np.uint32)
        end = np.array([len(lists) - 1], np.int32)
        uses = np.concatenate([x for s in block.sequences for x in (s, end)] or [end[:0]])
        stops = np.cumsum([len(s) + 1 for s in block.sequences])
        del lists, block
        counts = sizes[uses]
        ends = np.cumsum(counts)
        at = np.repeat((np.cumsum(sizes) - sizes)[uses] - (ends - counts), counts)
        at += np.arange(len(at))
        return flat[at], np.diff(np.concatenate([[0], ends[stops - 1] if len(stops) else []])).astype(np.int64)


def _files(definition: str, pattern: str, file_tokens: int):
    """The files of one shard, a row each."""

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part = Encoder(definition, pattern), TaskContext.get().partitionId(), 0
        names, lengths, ids, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            data = pack_file(shard, part, names, np.concatenate(lengths), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for batch in blocks(batches, 1, ENCODE_BLOCK):
            block_ids, block_lengths = encoder.encode(filled(batch.column(1)))
            block_names, ends = batch.column(0).to_pylist(), np.cumsum(block_lengths)
            low = 0
            while low < len(block_names):
                before = int(ends[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + file_tokens - size, side="right")))
                if size and int(ends[high - 1]) - before > file_tokens - size:
                    high = low  # the next document belongs to the next file
                else:
                    names += block_names[low:high]
                    lengths.append(block_lengths[low:high])
                    ids.append(block_ids[before : int(ends[high - 1])])
                    size += len(ids[-1])
                if high == low or high < len(block_names):
                    yield row()
                    names, lengths, ids, size, part = [], [], [], 0, part + 1
                low = high
        if names:
            yield row()

    return files


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = FILE_TOKENS
) -> None:
    """Write the ids of all texts to token files below ``path``, in ascending order of the identifier.

    ``tokenizer`` is the driver's path of a byte-level tokenizer file of the tokenizers library, ``pattern`` the
    pattern it cuts texts by. Strings of special tokens in a text are ordinary text. A null text is
    empty: it has the end id alone. Rows without identifier come first; rows that repeat one are in the
    order of a hash of their texts. An empty table gives no files with tokens.

    The order is a range shuffle over (identifier, hash of the text, row): even an identifier with most of
    the rows is spread over many shards. The text writer puts out the bytes as they are, so files are committed as
    any output of Spark, and a task that runs again replaces its own.
    """
    order = ["doc_id", "text_hash", "row_no"]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "row_no": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    files = ordered.mapInArrow(_files(definition, pattern, file_tokens), "data binary")
    files.select(F.col("data").cast("string").alias("data")).write.option("maxRecordsPerFile", 1).text(path)


def _content(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 1").select("content")


def _read_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            file = TokenFile(value.as_buffer())
            ids = file.tokens(0, file.n_tokens).astype("<u4")
            spans = list(zip(file.starts[:-1].tolist(), file.starts[1:].tolist()))
            numbers = [np.full(file.n_docs, file.shard), np.full(file.n_docs, file.part), np.arange(file.n_docs)]
            columns = [pa.array(x.astype(np.int64)) for x in numbers] + [
                pa.array(file.doc_ids, pa.int64()),
                pa.array([a for a, _ in spans], pa.int64()),
                pa.array([b - a for a, b in spans], pa.int64()),
                pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()),
            ]
            names = ["shard", "part", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _file_starts(docs: DataFrame) -> DataFrame:
    """shard, part, start, end: the tokens of each file. Sums run inside shards and, a row each, over the shards."""
    files = docs.groupBy("shard", "part").agg(F.sum("n_tokens").alias("size"))
    shards = files.groupBy("shard").agg(F.sum("size").alias("shard_size"))
    sofar = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shards = shards.select("shard", (F.sum("shard_size").over(sofar) - F.col("shard_size")).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = files.withColumn("end", F.sum("size").over(within)).join(shards, "shard")
    return ends.select("shard", "part", (F.col("shard_start") + F.col("end") - F.col("size")).alias("start"), (F.col("shard_start") + F.col("end")).alias("end"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """shard, part, place, doc_id, start, n_tokens, ids_crc32 of each document, read from the files below ``path``.

    ``start`` counts the tokens of all documents before; the checksum is that of the ids as little-endian 32-bit
    numbers. Each file is read once.
    """
    docs = stage(_content(spark, path).mapInArrow(_read_docs, _DOCS), "token-documents")
    starts = _file_starts(docs).select("shard", "part", F.col("start").alias("file_start"))
    start = (F.col("file_start") + F.col("local_start")).alias("start")
    return docs.join(starts, ["shard", "part"]).select("shard", "part", "place", "doc_id", start, "n_tokens", "ids_crc32")


def _tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value, starts, places in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            file = TokenFile(value.as_buffer())
            n = len(places)
            columns = [[file.shard] * n, [file.part] * n, places, [file.token(p - starts) for p in places]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "part", "position", "token_id"])


def _number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            file = TokenFile(value.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (file.shard, file.part)] + [pa.array([value.as_py()], pa.binary())], names=["shard", "part", "content"])


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, column: str = "position", slice_size: int = 100_000) -> DataFrame:
    """position, token_id for each distinct token number in ``positions``, by random access into the files.

    Numbers that no token has, and nulls, give no row. Positions meet a file in slices, so that a file
    which most of them fall into is met by many tasks.
    """
    docs = stage(_content(spark, path).mapInArrow(_read_docs, _DOCS).select("shard", "part", "n_tokens"), "token-counts")
    files = stage(_file_starts(docs), "token-file-starts")
    # A file and the positions in it meet by the stretches of the token numbers that the file touches.
    width = FILE_TOKENS
    stretches = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)))
    wanted = positions.select(F.col(column).cast("bigint").alias("position")).where("position >= 0").distinct()
    placed = wanted.withColumn("stretch", F.floor(F.col("position") / width)).join(files.withColumn("stretch", stretches), "stretch")
    placed = placed.where("position >= start AND position < end")
    cut = F.pmod(F.xxhash64("position"), F.greatest(F.ceil((F.col("end") - F.col("start")) / slice_size), F.lit(1).cast("bigint")))
    asked = placed.groupBy("shard", "part", "start", cut.alias("cut")).agg(F.collect_list("position").alias("places"))
    content = _content(spark, path).mapInArrow(_number, "shard bigint, part bigint, content binary")
    met = content.join(asked, ["shard", "part"]).select("content", "start", "places")
    return met.mapInArrow(_tell, _FOUND).select("position", "token_id")


def token_files(docs: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of ``docs``, read back from files in the working folder.

    See ``write_tokens`` for null, empty and repeated rows; an empty table gives no rows, other columns aren't
    read, and a very long text is a file by itself.
    """
    spark = docs.sparkSession
    path = fresh_dir(spark, "token-files")
    write_tokens(docs, path, tokenizer, pattern, id_col, text_col)
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
