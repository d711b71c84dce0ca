"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition makes a run of (digest, identifier). In each round the partitions whose numbers
differ only in their lowest bits exchange their runs and merge them; the groups of partitions so grow
by a fixed factor until one run of each digest is left. A merge needs at most ``FAN_IN`` rows of a
digest for each task of the round before, however many copies a text has, and the way back down the
tree joins each row with one row of its parent, so no key is ever hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.arrowtext import filled
from wattloom.sources.tables import stage

# Runs merged at once: partition numbers lose so many bits a round.
FAN_BITS = 4

# Digest, length and a second digest of another family: rows merge only where all three agree.
KEY = ("digest", "n_bytes", "witness")
_RUN = "doc_id bigint, digest binary, n_bytes bigint, witness bigint, run bigint"
_MERGED = "digest binary, n_bytes bigint, witness bigint, run bigint, best bigint, size bigint"


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in pc.ascii_lower(filled(batch.column(1))).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
                batch.column(2).cast(pa.int64()),
            ],
            names=["doc_id", "digest", "n_bytes", "witness", "run"],
        )


def _merge(largest: bool):
    """Fold neighbours of a sorted stream that have the same key; a key may span batches."""
    pick = max if largest else min

    def fold(one, two):
        ids = [x for x in (one[4], two[4]) if x is not None]
        return (*one[:4], pick(ids) if ids else None, one[5] + two[5])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "n_bytes", "witness", "run", "best", "size"]
        open_row = None
        for batch in batches:
            done = []
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if open_row is None:
                    open_row = row
                elif row[:4] == open_row[:4]:
                    open_row = fold(open_row, row)
                else:
                    done.append(open_row)
                    open_row = row
            if done:
                yield _as_batch(done, batch.schema, names)
            schema = batch.schema
        if open_row is not None:
            yield _as_batch([open_row], schema, names)

    return merge


def _as_batch(rows: list[tuple], schema: pa.Schema, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, schema.field(n).type) for n, values in zip(names, zip(*rows))], names=names
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; a null text is empty. Of equal texts
    the largest identifier stays (the smallest with ``largest=False``). Null identifiers lose
    against any other; where a group has no other, keep_id is null and its rows are kept. Rows that
    repeat both identifier and text are one document: each is returned, with the same decision. Of a very long text
    only the digests leave the task that reads it. An empty table gives no rows; other columns of ``docs`` are not read.
    """
    source = docs.select(
        F.col(id_col).cast("bigint"), F.col(text_col).cast("string"), F.spark_partition_id().cast("bigint")
    )
    rows = stage(source.mapInArrow(_digests, _RUN), "digest-runs")
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1

    runs, levels, merge = rows.select(*KEY, "run", F.col("doc_id").alias("best"), F.lit(1).cast("bigint").alias("size")), [], _merge(largest)
    while True:
        order = [*KEY, "run"]
        runs = stage(runs.repartition("run", *KEY).sortWithinPartitions(*order).mapInArrow(merge, _MERGED), "merged-runs")
        levels.append(runs)
        if n_runs == 1:
            break
        n_runs = (n_runs - 1 >> FAN_BITS) + 1
        runs = runs.withColumn("run", F.shiftright("run", FAN_BITS))

    # Down the tree: every level takes the answer of its parent.
    answer = levels.pop()
    for level in reversed(levels):
        parent = answer.withColumnsRenamed({"run": "up"})
        answer = level.select(*KEY, "run", F.shiftright("run", FAN_BITS).alias("up")).join(parent, [*KEY, "up"]).drop("up")
    return rows.join(answer, [*KEY, "run"]).select(
        "doc_id",
        F.col("best").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
