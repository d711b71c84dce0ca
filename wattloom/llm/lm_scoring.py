"""Cross-entropy difference of documents under two word bigram models.

The target model is counted over the documents that a label names, the background model over all others. They
share one vocabulary, all words of the corpus, the orders and the smoothing, and the background counts are
scaled to as many tokens as the target's (matched), so that a difference of the losses is one of the texts and not
of the amounts of data. Counts cover every token of every document.

Documents are cut into blocks once. A block sends each of its distinct words and word pairs once, as 56-bit keys with
their counts, packed by bucket of the key. A bucket adds up what all blocks have sent and answers each with the totals
of its own keys; there are as many buckets as keep one small however large the corpus is. At the block the totals are joined with
the pairs, and the losses of a document's tokens are added up. Neither model is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.arrowtext import blocks, coded, filled, split_words
from wattloom.sources.tables import stage

# Weight of the next lower order, in tokens.
PRIOR = 8.0
# Bytes of text in a block, and tokens of the corpus for each bucket.
BLOCK, BUCKET_TOKENS = 8 << 20, 1 << 20
# Two of a hundred million keys of this size are the same about once in ten corpora.
KEY_BITS = 56
_LEVEL = 3

_PLACES = "block bigint, doc_ids array<bigint>, lengths array<bigint>, words binary, places binary"
_PIECES = "bucket bigint, block bigint, pack binary"
_ANSWERS = "bucket bigint, block bigint, pack binary, new_words bigint"
_SCORED = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double"

_STEP = np.uint64(0x9E3779B97F4A7C15)
# No word has a blank or a line feed in it: these stand for the end of a text and for what is before its first word.
_END, _BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" ", b"\n"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pressed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: those that are all zero cost nothing."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=_LEVEL).compress(planes.tobytes()) if len(values) else b""


def _opened(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data) if data else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(*arrays: np.ndarray) -> bytes:
    parts = [_pressed(np.ascontiguousarray(a, np.uint64)) for a in arrays]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _unpacked(pack: bytes, n: int) -> list[np.ndarray]:
    ends = 8 * n + np.cumsum(np.frombuffer(pack, "<i8", n))
    return [_opened(pack[a:b], np.uint64) for a, b in zip([8 * n, *ends[:-1]], ends)]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks: the hashes of their distinct words, and the numbers of each document's words in order."""
    number = TaskContext.get().partitionId() << 32
    for batch in blocks(batches, 1, BLOCK):
        words, starts = split_words(filled(batch.column(1)))
        names, codes = coded(words)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.large_binary()).to_pylist()], np.uint64)
        # The most frequent words get the smallest numbers, which pack best.
        order = np.argsort(-np.bincount(codes, minlength=len(hashes)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        columns = [
            pa.array([number]),
            pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
            pa.array([np.diff(starts).tolist()], pa.list_(pa.int64())),
            pa.array([_pressed(hashes[order])], pa.binary()),
            pa.array([_pressed(rank[codes])], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "lengths", "words", "places"])
        number += 1


class _Events:
    """The events of a block: each word after the one before it, and the end of each text that has words."""

    def __init__(self, lengths: list[int], words: bytes, places: bytes):
        sizes = np.array(lengths, np.int64)
        hashes, at = _opened(words, np.uint64), _opened(places, np.uint32).astype(np.int64)
        self.n_words = len(hashes)
        end, begin = self.n_words, self.n_words + 1
        full = np.flatnonzero(sizes)
        current = np.insert(at, np.cumsum(sizes[full]), end)
        previous = np.concatenate([[begin], current[:-1]])[: len(current)]
        previous[np.concatenate([[0], np.cumsum(sizes[full] + 1)])[:-1]] = begin
        self.document = np.repeat(full.astype(np.int32), sizes[full] + 1)
        codes = previous * (begin + 1) + current
        del previous, current
        pairs, self.pair = np.unique(codes, return_inverse=True)
        del codes
        self.pair = self.pair.astype(np.int32)
        self.current, self.previous = pairs % (begin + 1), pairs // (begin + 1)
        marked = np.concatenate([hashes, [_END, _BEGIN]])
        # Keys of words and the end mark, and of pairs.
        self.keys = [_mix(x) >> np.uint64(64 - KEY_BITS) for x in (marked[:-1], marked[self.previous] * _STEP + marked[self.current])]
        self.orders = [np.argsort(k) for k in self.keys]

    def counts(self, side: np.ndarray) -> list[np.ndarray]:
        """How often each word and each pair occurs in the documents of one side."""
        of_pair = np.bincount(self.pair[side[self.document]], minlength=len(self.current))
        return [np.bincount(self.current, of_pair, self.n_words + 1).astype(np.uint64), of_pair.astype(np.uint64)]


def _send(bits: int):
    """The keys of each block with their counts on either side, a piece for each bucket."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a block at a time is unpacked
                block, lengths, words, places, targets = (c[at].as_py() for c in batch.columns)
                events = _Events(lengths, words, places)
                target = np.zeros(len(lengths), bool)
                target[targets or []] = True
                sides = [events.counts(target), events.counts(~target)]
                sent = [(k[o], t[o], b[o]) for k, o, t, b in zip(events.keys, events.orders, *sides)]
                del events, sides
                cuts = [np.searchsorted(k >> np.uint64(KEY_BITS - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) for k, _, _ in sent]
                rows = []
                for bucket in range(1 << bits):
                    piece = [a[c[bucket] : c[bucket + 1]] for part, c in zip(sent, cuts) for a in part]
                    if len(piece[0]) or len(piece[3]):
                        # Sorted keys travel as the steps between them.
                        for keys in (0, 3):
                            piece[keys] = np.diff(piece[keys], prepend=np.uint64(0))
                        rows.append((bucket, block, _packed(*piece)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.binary()))], names=["bucket", "block", "pack"])

    return send


def _add_up(key: tuple, table: pa.Table) -> pa.Table:
    """Totals of a bucket's words and pairs, and for each block those of its own keys in their order."""
    pieces = [_unpacked(p, 6) for p in table["pack"].to_pylist()]
    answers: list[list[np.ndarray]] = [[] for _ in pieces]
    new_words = 0
    for at in (0, 3):
        keys = np.concatenate([np.cumsum(p[at], dtype=np.uint64) for p in pieces])
        distinct, inverse = np.unique(keys, return_inverse=True)
        new_words += len(distinct) if at == 0 else 0
        totals = [np.bincount(inverse, np.concatenate([p[at + 1 + side] for p in pieces]), len(distinct)).astype(np.uint64) for side in (0, 1)]
        stops = np.cumsum([len(p[at]) for p in pieces])
        for answer, low, high in zip(answers, [0, *stops[:-1]], stops):
            answer += [t[inverse[low:high]] for t in totals]
    packs = pa.array([_packed(*a) for a in answers], pa.binary())
    fresh = np.zeros(len(pieces), np.int64)
    fresh[0] = new_words
    return pa.Table.from_arrays([table["bucket"], table["block"], packs, pa.array(fresh)], names=["bucket", "block", "pack", "new_words"])


def _score(tokens: tuple[int, int], texts: tuple[int, int], n_words: int):
    """Losses of the documents of a block from the totals of its keys."""
    scale = tokens[0] / tokens[1] if all(tokens) else 1.0
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])

    def score(key: tuple, places: pa.Table, answers: pa.Table) -> pa.Table:
        found = []
        for row in places.to_pylist():  # one: a block's
            events = _Events(row["lengths"], row["words"], row["places"])
            parts = [_unpacked(p, 4) for p in answers.sort_by("bucket")["pack"].to_pylist()]
            losses = []
            for side, factor in ((0, 1.0), (1, scale)):
                counts = []
                for at, order in zip((side, 2 + side), events.orders):
                    total = np.concatenate([p[at] for p in parts] or [np.empty(0, np.uint64)])
                    if len(total) != len(order) and len(events.pair):
                        raise RuntimeError(f"block {row['block']} misses counts")
                    counts.append(np.empty(len(total)))
                    counts[-1][order[: len(total)]] = total * factor
                if not len(events.pair):
                    losses.append(np.zeros(len(row["lengths"])))
                    continue
                context = np.concatenate([counts[0], [texts[side] * factor]])[events.previous]
                word = (counts[0][events.current] + PRIOR / max(n_words, 1)) / (tokens[side] * factor + PRIOR)
                pair = -np.log2((counts[1] + PRIOR * word) / (context + PRIOR))
                losses.append(np.bincount(events.document, pair[events.pair], len(row["lengths"])))
            sizes = np.array(row["lengths"], np.int64)
            means = [pa.array(x / (sizes + 1), mask=sizes == 0) for x in losses]
            found.append(pa.Table.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(sizes), *means], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    return score


def cross_entropy_difference(
    docs: DataFrame, labels: DataFrame, is_target: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, difference.

    Tokens are words, as white space parts them. Losses are bits per token, the end of the text counted as one; a
    negative difference (target less background) means a text more like the target's. ``is_target`` is a
    condition over ``labels``; a document with any label row that meets it is one of the target's; null labels and
    identifiers meet nothing. A text without words (null, empty) has null losses. Rows that repeat are counted
    each. With no target documents both models still exist: the target's is uniform over the vocabulary. A very long text
    is a block by itself. An empty table gives no rows. Only the two named columns of ``docs`` are read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    placed = stage(texts.mapInArrow(_cut, _PLACES), "word-places")
    chosen = labels.where(is_target).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().withColumn("is_target", F.lit(True))
    # Only identifiers meet the labels. Their list grows with the corpus: a merge at every size.
    each = placed.select("block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("place", "doc"))
    each = each.select("block", "place", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.lengths").alias("n"))
    flagged = stage(each.join(chosen.hint("merge"), "doc_id", "left").select("block", "place", "n", F.coalesce("is_target", F.lit(False)).alias("is_target")), "target-flags")
    sizes = {r["is_target"]: r for r in flagged.where("n > 0").groupBy("is_target").agg(F.sum(F.col("n") + 1).alias("tokens"), F.count(F.lit(1)).alias("texts")).collect()}
    tokens, n_texts = ([sizes[side][c] if side in sizes else 0 for side in (True, False)] for c in ("tokens", "texts"))

    bits = max(3, int(np.ceil(np.log2(max(sum(tokens) / BUCKET_TOKENS, 1)))))
    targets = flagged.where("is_target").groupBy("block").agg(F.sort_array(F.collect_list("place")).alias("targets"))
    # The list of targets grows with the corpus: a merge at every size.
    marked = placed.join(targets.hint("merge"), "block", "left").select("block", "lengths", "words", "places", "targets")
    pieces = marked.mapInArrow(_send(bits), _PIECES)
    answers = stage(pieces.groupBy("bucket").applyInArrow(_add_up, _ANSWERS), "bucket-answers")
    n_words = answers.agg(F.sum("new_words")).first()[0] or 0

    score = _score(tuple(tokens), tuple(n_texts), n_words)
    scored = placed.groupBy("block").cogroup(answers.drop("new_words").groupBy("block")).applyInArrow(score, _SCORED)
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
