"""Near-duplicates by MinHash: many universal hash minima, bands, signature and full-set checks.

Documents with the same shingle set form a class, whose smallest identifier stands for it. Only these
go on. Documents that agree in a band form a bucket, and buckets with the same smallest member, their
leader, form one group, so that copies which meet in many bands are compared once. A group is compared
with a bounded number of its members, the hubs: first by signature, which lets most chance meetings go,
then on full sets. Members stream past the hubs in slices; a task holds the sets of the hubs only and
puts out links that connect something new, never all pairs.

Groups of up to ``HUBS`` documents are so decided in one round. In larger ones the rest meets again in
the next round, but for what is settled: documents that are connected already, and, as 1 - similarity is a
metric, connected ones too near to the leader to be linked to any that is not connected. Every round draws
its hubs anew from those that are left, as many each time, so a group of n near misses takes some n / ``HUBS`` rounds.
They go on until nothing is left, so every pair of documents that share a band is decided. A round's tables go with it.
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

from wattloom.llm.arrowtext import blocks, coded, filled, split_words
from wattloom.llm.components import connected_components
from wattloom.session import fresh_dir
from wattloom.sources.folders import Folders
from wattloom.sources.tables import stage

# 50 bands of 6 minima: two sets at similarity 0.8 miss each other in all bands once in four million
# times, two at 0.5 share a band with probability 0.54 and two at 0.2 with 0.003.
BANDS, ROWS = 50, 6
SHINGLE, PERCENT = 5, 80
SEED = 20_24

# A signature estimate is trusted only this many standard errors (0.029 at most) away from the bound.
DOUBT = 0.18
# Members of a group that the others are compared with in a round, and the shingles of their sets.
HUBS, HUB_SHINGLES = 4096, 2_000_000
# Members compared with one copy of the hubs.
SLICE = 1024

_SIGNED = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary"
_RATED = "leader bigint, doc_id bigint, near boolean, distance double"
_JUDGED = "leader bigint, doc_id bigint, other bigint, distance double"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(words) - size + 1
    out = words[:n]
    for at in range(1, size):
        out = _mix(out * _MIX + words[at : at + n])
    return out


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles of ``size`` words, letters A-Z lower-cased.

    A text with fewer words has one shingle, its whole sequence of words; one without words has none.
    """
    words, starts = split_words(pc.ascii_lower(filled(texts)))
    names, codes = coded(words)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.large_binary()).to_pylist()], np.uint64)
    each = hashes[codes] if len(codes) else np.empty(0, np.uint64)
    runs = _fold(each, size) if len(each) >= size else np.empty(0, np.uint64)
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        else:
            yield _fold(each[a:b], b - a) if b > a else np.empty(0, np.uint64)


class _Minima:
    """Multiply-add hash functions over 32 bits, and the minimum of each over a set."""

    WIDTH = 2048

    def __init__(self):
        draw = np.random.default_rng(SEED)
        n = BANDS * ROWS
        self.a = (draw.integers(0, 1 << 31, n, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
        self.b = draw.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)[:, None]
        self.room = np.empty((n, self.WIDTH), np.uint32)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
        found = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, x.shape[1], self.WIDTH):
            part = x[:, at : at + self.WIDTH]
            room = self.room[:, : part.shape[1]]
            np.multiply(self.a, part, out=room)
            np.add(room, self.b, out=room)
            np.minimum(found, room.min(axis=1), out=found)
        return found


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, from the minima of one document a row."""
    rows = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX, (len(minima), BANDS))
    for at in range(ROWS):
        keys = _mix(keys + rows[:, :, at] * _MIX + np.uint64(at))
    return keys.view(np.int64)


def _sign(size: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Minima()
        for batch in blocks(batches, 1):
            counts, names, rows = [], [], []
            for shingles in shingle_sets(batch.column(1), size):
                counts.append(len(shingles))
                names.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                rows.append(hashed.of(shingles))
            minima = np.array(rows, np.uint32)
            full = np.array(counts) > 0
            keys, empty = _band_keys(minima), np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array([k if ok else empty for k, ok in zip(keys, full)], pa.list_(pa.int64())),
                    pa.array([m.tobytes() for m in minima.astype(np.uint8)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "bands", "sketch"],
            )

    return sign


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of rows with the same (leader, slice)."""
    keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    start = 0
    for at in range(1, len(keys) + 1):
        if at == len(keys) or keys[at] != keys[start]:
            yield keys[start], start, at
            start = at


def _estimate(percent: int):
    """Which members may be linked to a hub, or hubs to a member, and a distance each surely has from its leader.

    Rows come sorted by (leader, slice), the hubs of each slice first.
    """

    def estimate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hubs, sketches, touched = None, [], [], np.zeros(0, bool)

        def rows_of_hubs() -> list[tuple]:
            return [(at[0], hub, True, None) for hub, hit in zip(hubs, touched) if hit]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["leader", "doc_id", "near", "distance"])

        for batch in batches:
            rows = []
            members, ids = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            data = batch.column(4).to_pylist()
            for key, start, end in _runs(batch):
                if key != at:
                    if at:
                        rows += rows_of_hubs()
                    at, hubs, sketches, touched = key, [], [], np.zeros(0, bool)
                for row in range(start, end):
                    sketch = np.frombuffer(data[row], np.uint8)
                    if not members[row]:
                        hubs.append(ids[row])
                        sketches.append(sketch)
                        continue
                    if isinstance(sketches, list):
                        sketches, touched = np.array(sketches).reshape(-1, BANDS * ROWS), np.zeros(len(hubs), bool)
                    likely = ((sketches == sketch).mean(axis=1) - 1 / 256) / (255 / 256)
                    others = np.array(hubs) != ids[row]
                    near = (likely + DOUBT >= percent / 100) & others
                    touched |= near
                    lead = [x for x, hub in zip(likely, hubs) if hub == key[0]]
                    rows.append((key[0], ids[row], bool(near.any()), float(np.clip(1 - max(lead) - DOUBT, 0, 1)) if lead else 0.0))
            if rows:
                yield out(rows)
        if at and touched.any():
            yield out(rows_of_hubs())

    return estimate


class _Hubs:
    """The sets of the hubs of one slice in an inverted index of several chunks, and how links connect them."""

    CHUNK = 256

    def __init__(self, percent: int):
        self.percent, self.ids, self.sets = percent, [], []
        self.chunks: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.sizes = self.part = np.empty(0, np.int64)

    def _prepare(self) -> None:
        self.sizes = np.array([len(x) for x in self.sets], np.int64)
        self.part = np.arange(len(self.ids))
        for start in range(0, len(self.ids), self.CHUNK):
            sets = self.sets[start : start + self.CHUNK]
            shingles = np.concatenate(sets)
            order = np.argsort(shingles, kind="stable")
            owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
            self.chunks.append((start, shingles[order], owner[order]))
        self.place = {doc_id: at for at, doc_id in enumerate(self.ids)}
        self.sets = []

    def links(self, doc_id: int, shingles: np.ndarray, leader: int) -> tuple[list[int], float | None]:
        """Hubs to link to so that all that is linked is connected, and the distance from the leader.

        The leader has the smallest identifier, so it is in the first chunk. Later chunks with nothing
        but hubs that the member is connected with already are not looked at.
        """
        if self.sets:
            self._prepare()
        own = self.place.get(doc_id, -1)
        mine = self.part[own] if own >= 0 else -1
        new, distance = [], None
        for start, known, owner in self.chunks:
            stop = min(start + self.CHUNK, len(self.ids))
            if start and mine >= 0 and (self.part[start:stop] == mine).all():
                continue
            low, high = (np.searchsorted(known, shingles, side) for side in ("left", "right"))
            counts = high - low
            places = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            shared = np.bincount(owner[places], minlength=stop - start)
            unions = np.maximum(self.sizes[start:stop] + len(shingles) - shared, 1)
            if start == 0 and self.ids[0] == leader:
                distance = float(1 - shared[0] / unions[0])
            for at in start + np.flatnonzero(100 * shared >= self.percent * unions):
                if at != own and self.part[at] != mine:
                    new.append(self.ids[at])
                    if mine >= 0:
                        self.part[self.part == self.part[at]] = mine
                    else:
                        mine = self.part[at]
        return new, distance


def _confirm(size: int, percent: int):
    """Links on full sets, in a stream sorted by (leader, slice) in which the hubs' texts come first."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hubs = None, None
        for batch in blocks(batches, 4):
            out = []
            head = zip(*(batch.column(c).to_pylist() for c in range(4)))
            for (leader, part, member, doc_id), shingles in zip(head, shingle_sets(batch.column(4), size)):
                if (leader, part) != at:
                    at, hubs = (leader, part), _Hubs(percent)
                if not member:
                    hubs.ids.append(doc_id)
                    hubs.sets.append(shingles)
                    continue
                new, distance = hubs.links(doc_id, shingles, leader)
                out += [(leader, doc_id, other, distance) for other in new or [None]]
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["leader", "doc_id", "other", "distance"])

    return confirm


def _past_hubs(group: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Rows (leader, doc_id, is_hub) with a value, dealt and sorted so that the members of each slice follow its hubs."""
    slices = group.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("slices"))
    valued = group.join(slices, "leader").join(values, "doc_id")
    members = valued.select("leader", F.pmod(F.xxhash64("doc_id"), "slices").alias("slice"), F.lit(1).alias("member"), "doc_id", value)
    hubs = valued.where("is_hub").select("leader", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("member"), "doc_id", value)
    return members.unionByName(hubs).repartition("leader", "slice").sortWithinPartitions("leader", "slice", "member", "doc_id")


def similar_links(signed: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links doc_id, other that connect all similar documents of ``signed`` that share a band."""
    reach, spark = 1 - percent / 100 + 1e-9, signed.sparkSession
    places: list[str] = []

    def held(rows: DataFrame, name: str) -> DataFrame:
        """A table of the round."""
        places.append(fresh_dir(spark, name))
        rows.write.parquet(places[-1])
        return spark.read.schema(rows.schema).parquet(places[-1])

    def dropped(done: list[str]) -> None:
        for place in done:
            Folders(spark).remove(place)
            places.remove(place)

    members = signed.select(F.explode("bands").alias("bucket"), "doc_id")
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    left = held(members.join(crowded, "bucket"), "buckets")
    sketches, sizes = signed.select("doc_id", "sketch"), signed.select("doc_id", "n_shingles")
    links, number = None, 0
    while True:
        number += 1
        leaders = left.groupBy("bucket").agg(F.min("doc_id").alias("leader"))
        led = held(left.join(leaders, "bucket"), "led-buckets")
        group = led.select("leader", "doc_id").distinct().join(sizes, "doc_id")
        totals = group.groupBy("leader").agg(F.least(F.lit(float(HUBS)) / F.count(F.lit(1)), F.lit(float(HUB_SHINGLES)) / F.sum("n_shingles")).alias("share"))
        draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED), F.lit(number)), F.lit(1 << 30)) / float(1 << 30)
        is_hub = (F.col("doc_id") == F.col("leader")) | (draw < F.col("share"))
        group = held(group.join(totals, "leader").select("leader", "doc_id", is_hub.alias("is_hub")), "groups")

        rated = _past_hubs(group, sketches, "sketch").mapInArrow(_estimate(percent), _RATED)
        rated = held(rated.groupBy("leader", "doc_id").agg(F.max("near").alias("near"), F.min("distance").alias("distance")), "rated")
        near = held(group.join(rated.where("near"), ["leader", "doc_id"]).select("leader", "doc_id", "is_hub"), "near-groups")
        wanted = held(near.select("doc_id").distinct(), "near-ids")
        # The first list grows with the corpus and is never broadcast.
        bodies = texts.join(wanted.hint("merge") if number == 1 else wanted, "doc_id", "left_semi")
        judged = held(_past_hubs(near, bodies, "text").mapInArrow(_confirm(size, percent), _JUDGED), "judged")
        found = stage(judged.where("other IS NOT NULL").select("doc_id", "other"), "links")
        links = found if links is None else links.unionByName(found)

        # Who is left: members of buckets with two or more that were no hubs.
        rest = led.join(group.where("NOT is_hub").select("leader", "doc_id"), ["leader", "doc_id"])
        several = rest.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("bucket")
        rest = held(rest.join(several, "bucket"), "rest")
        if rest.isEmpty():
            dropped(list(places))
            return links
        roots = connected_components(links, "doc_id", "other")
        exact = judged.groupBy("leader", "doc_id").agg(F.max("distance").alias("exact"))
        known = rest.join(rated, ["leader", "doc_id"]).join(exact, ["leader", "doc_id"], "left").select("bucket", "leader", "doc_id", "exact", "distance")
        rooted = known.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("lead_root"))
        rooted = rooted.join(lead, "leader", "left").withColumn(
            "inside", F.coalesce("root", "doc_id") == F.coalesce("lead_root", "leader")
        )
        # Lower bounds will do for those outside; a connected one without an exact distance may be anywhere.
        distance = F.coalesce("exact", F.when(F.col("inside"), 1.0).otherwise(F.col("distance")))
        rooted = held(rooted.select("bucket", "doc_id", "inside", distance.alias("distance")), "rooted")
        far = rooted.where("NOT inside").groupBy("bucket").agg(F.min("distance").alias("nearest"))
        open_rows = rooted.join(far, "bucket").where(~F.col("inside") | (F.col("distance") >= F.col("nearest") - reach))
        open_rows = open_rows.select("bucket", "doc_id")
        several = open_rows.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("bucket")
        done = list(places)
        left = held(open_rows.join(several, "bucket"), "buckets")
        dropped(done)
        if left.isEmpty():
            dropped(list(places))
            return links


def near_dedup(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents whose sets of ``size``-word shingles have a similarity of ``percent`` or more are linked;
    component_id is the smallest identifier reachable over links. A text without words (null, empty or
    white space) has no shingles and is linked with nothing. A null identifier is linked with nothing,
    its component is null and it is kept. An identifier names one document: rows that repeat it share
    its links. A very long text is a block by itself, with all its shingles. An empty table gives no rows; other
    columns aren't read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stage(texts.mapInArrow(_sign(size), _SIGNED), "signatures")
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(named.groupBy("set_id").agg(F.min("doc_id").alias("first_id")), "same-sets")
    first = stage(named.join(classes, (named["set_id"] == classes["set_id"]) & (named["doc_id"] == classes["first_id"])).select("doc_id", "n_shingles", "bands", "sketch").dropDuplicates(["doc_id", "bands"]), "first-of-sets")
    roots = connected_components(similar_links(first, texts, size, percent), "doc_id", "other")

    owners = classes.join(roots, classes["first_id"] == roots["node"], "left").select("set_id", F.coalesce("root", "first_id").alias("component_id"))
    sets = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("set_id")).alias("set_id"))
    component = F.coalesce("component_id", "doc_id")
    return sets.join(owners, "set_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
