"""Whole texts inside Arrow batches: white space, words and blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A block holds whole documents up to about so many bytes of text; a longer text is a block by itself.
BLOCK_BYTES = 8 << 20

WORD = r"[^\x20\x09-\x0D]+"


def filled(texts: pa.Array) -> pa.Array:
    """Texts with null as empty, with 64-bit offsets so that no batch is too large for them.

    A slice is copied: the offsets of its cast begin in the middle of the data, which ``ascii_lower`` takes wrong.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))


def blocks(batches: Iterable[pa.RecordBatch], text_at: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece has about ``limit`` bytes of text, or is a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts and, for each text, where its words begin; one entry more for the end."""
    pieces = pc.ascii_split_whitespace(texts)
    words = pieces.flatten()
    starts = pieces.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    full = pc.binary_length(words).to_numpy() > 0
    if not full.all():  # white space at either end of a text makes an empty piece
        words = words.filter(pa.array(full))
        starts = np.concatenate([[0], np.cumsum(full)])[starts]
    return words, starts


def coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and the number of each word among them."""
    table = words.dictionary_encode()
    return table.dictionary, table.indices.to_numpy()
