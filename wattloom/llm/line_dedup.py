"""Line dedup by winnowing over line hashes.

A window is a shortest run of whole lines with at least ``min_words`` words that begins or ends at a given
line. Every repeated run of so many words contains the same windows at both places, so their minima, the
lines with the smallest hash in each window, are fingerprints that both places select. Fingerprints that
occur at one place only go no further. At the others a match reaches to both ends of every window that selected
the fingerprint, which is told by the window's rolling hash and not line by line; neighbouring windows carry it on
over the whole run. Of equal windows the first by (doc_id, line) stays and lines of the others go. So a
place is met with the first of its kind only: two places of a frequent line are never paired otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.arrowtext import blocks, coded, filled, split_words
from wattloom.sources.tables import stage

MIN_WORDS = 50

_FOUND = "print bigint, doc_id bigint, line int, window binary, first_line int, last_line int"
_CLEAN = "doc_id bigint, n_lines bigint, n_removed bigint, text string"


# Primes below 2^31 and a base for each. A window is named by four remainders and its number of lines.
_FIELDS = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_220_703_125), (2_147_483_587, 1_664_525_001), (2_147_483_579, 1_812_433_253))


def _windows(words: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the shortest runs with enough words, from each first line and to each last line.

    Lines of several texts in a row; ``begin`` and ``end`` say for each line where its text does.
    """
    n, at = len(words), np.arange(len(words))
    sums = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    last = np.searchsorted(sums[1:], sums[:-1] + least)
    first = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    ahead, behind = last < end, first >= begin
    pairs = np.unique(np.concatenate([at[ahead] * n + last[ahead], first[behind] * n + at[behind]]))
    return pairs // max(n, 1), pairs % max(n, 1)


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    found = np.ones(max(n, 1), np.uint64)
    known = 1
    while known < n:
        more = min(known, n - known)
        found[known : known + more] = found[:more] * np.uint64(pow(base, known, prime)) % np.uint64(prime)
        known += more
    return found[:n]


def _names(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """A name for each run of lines a..b from the lines' four 32-bit hashes: a rolling hash, so the length costs nothing."""
    parts = []
    for part, (prime, base) in zip(hashes.T, _FIELDS):
        p = np.uint64(prime)
        sums = np.concatenate([[0], np.cumsum(part % p * _powers(base, len(part), prime) % p)]).astype(np.uint64) % p
        parts.append((sums[b + 1] + p - sums[a]) % p * _powers(pow(base, -1, prime), len(part), prime)[a] % p)
    names = np.ascontiguousarray(np.stack([*parts, (b - a + 1).astype(np.uint64)], axis=1).astype("<u4"))
    offsets = np.arange(len(a) + 1, dtype=np.int32) * (4 * names.shape[1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(names)])


def _lowest(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The place of the first smallest value in each stretch low..high, by tables of powers of two."""
    tables = [np.arange(len(values))]
    while 2 << len(tables) - 1 <= (high - low).max(initial=1):
        one, step = tables[-1], 1 << len(tables) - 1
        left, right = one[:-step], one[step:]
        tables.append(np.where(values[left] <= values[right], left, right))
    level = np.frexp((high - low).astype(float))[1] - 1
    found = np.empty(len(low), np.int64)
    for at, table in enumerate(tables):
        mine = level == at
        left, right = table[low[mine]], table[high[mine] - (1 << at)]
        found[mine] = np.where(values[left] <= values[right], left, right)
    return found


def _select(least: int):
    """The windows of each text with their fingerprint, the line with words whose hash is smallest, and a name.

    Every step is linear in the lines of the block: a text of blank lines costs no more than another one.
    """

    def select(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 1):
            pieces = pc.split_pattern(filled(batch.column(1)), "\n")
            starts = pieces.offsets.to_numpy().astype(np.int64)
            lines, starts = pieces.flatten(), starts - starts[0]
            sizes = np.diff(starts)
            begin, end = np.repeat(starts[:-1], sizes), np.repeat(starts[1:], sizes)
            words = np.diff(split_words(lines)[1])
            a, b = _windows(words, begin, end, least)
            if not len(a):
                continue
            distinct, code = coded(lines)
            raw = distinct.cast(pa.large_binary()).to_pylist()
            hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in raw]), "<u4").reshape(-1, 4)[code].astype(np.uint64)

            full = np.flatnonzero(words > 0)
            before = np.concatenate([[0], np.cumsum(words > 0)])
            prints = hashes[full, 0] << np.uint64(32) | hashes[full, 1]
            lowest = _lowest(prints, before[a], before[b + 1])
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)[a]))
            places = [(x - begin[a]).astype(np.int32) for x in (full[lowest], a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[lowest].view(np.int64)), ids, pa.array(places[0]), _names(hashes, a, b), pa.array(places[1]), pa.array(places[2])],
                names=["print", "doc_id", "line", "window", "first_line", "last_line"],
            )

    return select


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of lines (doc_id, first_line, last_line) that repeat an earlier run, of rows (doc_id, text)."""
    windows = stage(docs.where("doc_id IS NOT NULL").mapInArrow(_select(min_words), _FOUND), "windows")
    # The fingerprints at more than one place; counts combine before the shuffle.
    place = F.struct("doc_id", "line")
    shared = windows.groupBy("print").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("print")
    joined = windows.join(shared, "print").select("window", "doc_id", "first_line", "last_line")
    first = windows.join(shared, "print").groupBy("window").agg(
        F.min(F.struct("doc_id", "first_line", "last_line")).alias("kept"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("window", "kept")
    later = joined.join(first, "window").where(
        (F.col("doc_id") != F.col("kept.doc_id")) | (F.col("first_line") != F.col("kept.first_line"))
    )
    # A copy that overlaps the kept one in its own text loses only what lies behind it.
    own = (F.col("doc_id") == F.col("kept.doc_id")) & (F.col("first_line") <= F.col("kept.last_line"))
    start = F.when(own, F.col("kept.last_line") + 1).otherwise(F.col("first_line"))
    return later.select("doc_id", start.cast("int").alias("first_line"), "last_line").where("first_line <= last_line")


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    for batch in blocks(batches, 1):
        rows = []
        for doc_id, text, runs in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if text is None:
                rows.append((doc_id, 0, 0, None))
                continue
            lines = text.split("\n")
            if not runs:
                rows.append((doc_id, len(lines), 0, text))
                continue
            gone = np.zeros(len(lines) + 1, np.int64)
            for run in runs:
                if run["first_line"] < len(lines):
                    gone[run["first_line"]] += 1
                    gone[min(run["last_line"] + 1, len(lines))] -= 1
            stays = np.cumsum(gone)[:-1] == 0
            kept = [line for line, stay in zip(lines, stays) if stay]
            rows.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc_id", "n_lines", "n_removed", "text"]
            )


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, text without later repeated runs.

    A run of consecutive lines, equal byte for byte to an earlier run, goes if both have ``min_words``
    words or more; earlier is by (doc_id, line). A run that overlaps its own copy keeps the first copy
    whole. A null text stays null with no lines; an empty one is one empty line; shorter texts never
    change. A very long text, of blank lines too, costs time by its length. Rows with a null doc_id are left as they are. A doc_id names one document: rows that repeat it are no
    copies of each other. An empty table gives no rows; other columns aren't read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = repeated_lines(texts, min_words).groupBy("doc_id", "first_line").agg(F.max("last_line").alias("last_line"))
    lists = stage(runs.groupBy("doc_id").agg(F.collect_list(F.struct("first_line", "last_line")).alias("runs")), "removed-runs")
    return texts.join(lists.hint("merge"), "doc_id", "left").select("doc_id", "text", "runs").mapInArrow(_cut, _CLEAN)
