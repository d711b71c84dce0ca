"""Audit of how far the sources of a language differ, with late string materialization.

Blocks of documents count their terms and store one run row for each term of a language: a 64-bit digest, the
string, the number of documents and the counts by source. The string stays where it was written. What is
shuffled are digests and counts, of fixed width for each entry. Digests that reach the bound on documents are kept; the
smallest and the largest string of each tell whether two terms share it, and such digests alone are counted again by
string. All sums then run on digests, and strings are joined back for the few terms that are put out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.arrowtext import blocks, coded, filled, split_words
from wattloom.sources.tables import stage

MIN_DOCS, TOP = 10, 10

# Bytes of text that are counted together; larger blocks send fewer rows for the same terms.
COUNT_BLOCK = 32 << 20
# Cells (terms x sources) of a language that a task works on at once.
CELLS = 1 << 20

# The scale of p, as two factors, so that no product leaves 64 bits below 2.9e14 occurrences.
SCALE_HIGH, SCALE_LOW = 31_250, 32_000

# A-Z are lower-cased, other bytes below 0x80 but a-z end a term.
_LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

_RUNS = "lang_no bigint, digest bigint, term string, n_docs bigint, counts binary"
_KEPT = "lang_no bigint, digest bigint, split string, groups array<bigint>, counts array<bigint>"
_SUMS = "lang_no bigint, one bigint, two bigint, value bigint"


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts and where those of each text begin."""
    texts = filled(texts)
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_LETTERS))
    return split_words(pa.LargeStringArray.from_buffers(len(texts), offsets, plain))


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, heads) if len(heads) else values[:0]


def _binaries(pairs: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Rows of (group, count), eight bytes each, as one binary value for each start."""
    ends = 16 * np.concatenate([starts, [len(pairs)]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(pairs))])


def _count(bits: int):
    """Runs of the blocks of (text, lang_no, group)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 0, COUNT_BLOCK):
            words, starts = _terms(batch.column(0))
            if not len(words):
                continue
            names, codes = coded(words)
            size = len(names)
            digests = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.large_binary()).to_pylist()], np.uint64)
            digests = (digests & np.uint64((1 << bits) - 1)).view(np.int64)
            langs, groups = (batch.column(c).to_numpy() for c in (1, 2))
            group_names, first, group_of = np.unique(groups, return_index=True, return_inverse=True)
            lang_names, lang_of = np.unique(langs[first], return_inverse=True)

            # By document and term, then by group and term, then by language and term.
            found, n = np.unique(np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * size + codes, return_counts=True)
            keys = group_of[found // size] * size + found % size
            order = np.argsort(keys, kind="stable")
            heads = _heads(keys[order])
            keys, n, n_docs = keys[order][heads], _sums(n[order], heads), np.diff(np.concatenate([heads, [len(keys)]]))
            group = keys // size
            keys = lang_of[group] * size + keys % size
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            heads = _heads(keys)
            code = keys[heads] % size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lang_names[keys[heads] // size]),
                    pa.array(digests[code]),
                    names.take(pa.array(code)).cast(pa.string()),
                    pa.array(_sums(n_docs[order], heads)),
                    _binaries(np.stack([group_names[group[order]], n[order]], axis=1), heads).cast(pa.binary()),
                ],
                names=["lang_no", "digest", "term", "n_docs", "counts"],
            )

    return count


def _merge(min_docs: int):
    """Add up runs that come sorted by (lang_no, digest, split); terms with too few documents go.

    A key has as many entries as the language has sources. It may span batches: what is known of the last one
    goes ahead of the next batch as a row.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead: pa.Table | None = None
        schema = pa.schema([("lang_no", pa.int64()), ("digest", pa.int64()), ("split", pa.string()), ("n_docs", pa.int64()), ("counts", pa.large_binary())])

        def added(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
            """One row for each key, and all entries with the number of their key."""
            rows = rows.combine_chunks()
            langs, digests = (rows[c].to_numpy() for c in ("lang_no", "digest"))
            split = rows["split"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.concatenate([[True], (np.diff(langs) != 0) | (np.diff(digests) != 0) | (np.diff(split) != 0)])
            number, heads = np.cumsum(new) - 1, np.flatnonzero(new)
            counts = rows["counts"].combine_chunks()
            entries = np.frombuffer(b"".join(counts.to_pylist()), np.int64).reshape(-1, 2)
            owner = np.repeat(number, pc.binary_length(counts).to_numpy() // 16)
            order = np.lexsort((entries[:, 0], owner))
            entries, owner = entries[order], owner[order]
            same = _heads(np.stack([owner, entries[:, 0]], axis=1).view([("o", np.int64), ("g", np.int64)]).ravel()) if len(owner) else owner
            entries = np.stack([entries[same, 0], _sums(entries[:, 1], same)], axis=1) if len(owner) else entries
            keys = rows.select(["lang_no", "digest", "split"]).take(pa.array(heads))
            keys = keys.append_column("n_docs", pa.array(np.add.reduceat(rows["n_docs"].to_numpy(), heads)))
            return keys, entries, owner[same]

        def put(keys: pa.Table, entries: np.ndarray, owner: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
            """The first ``n`` keys, but for those with too few documents."""
            keep = keys["n_docs"].to_numpy()[:n] >= min_docs
            if keep.any():
                mine = np.concatenate([keep, np.zeros(len(keys) - n, bool)])[owner]
                sizes = np.bincount(owner[mine], minlength=n)[np.flatnonzero(keep)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(entries[mine, c]))) for c in (0, 1)]
                chosen = keys.slice(0, n).filter(pa.array(keep)).combine_chunks()
                columns = [chosen[c].combine_chunks() for c in ("lang_no", "digest", "split")]
                yield pa.RecordBatch.from_arrays(columns + lists, names=["lang_no", "digest", "split", "groups", "counts"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).cast(schema)
            keys, entries, owner = added(rows if ahead is None else pa.concat_tables([ahead, rows]))
            last = len(keys) - 1
            yield from put(keys, entries, owner, last)
            tail = _binaries(entries[owner == last], np.array([0]))
            ahead = keys.slice(last).append_column("counts", tail).cast(schema)
        if ahead is not None:
            yield from put(*added(ahead), 1)

    return merge


def _scaled(count, total):
    """1 + floor(10^9 * count / total) without leaving 64 bits; for arrays and numbers."""
    high = count * SCALE_HIGH
    return 1 + high // total * SCALE_LOW + high % total * SCALE_LOW // total


def _scaled_column(count: Column, total: Column) -> Column:
    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    high, low = count * F.lit(SCALE_HIGH), F.lit(SCALE_LOW).cast("bigint")
    return F.lit(1).cast("bigint") + div(high, total) * low + div(F.pmod(high, total) * low, total)


def _distance(p, q):
    return (p - q) * (p - q) // (p + q)


def _pair_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two sources of a language the sum over the task's kept terms.

    Of most terms a source has none, and then its p is the same. So only terms that a source has are worked out,
    against all others; what both sources of a pair have is counted twice and taken off, and what neither has is
    one product.
    """
    found: dict[int, list] = {}

    def add(lang: int, groups: np.ndarray, totals: np.ndarray, kept: int, terms: list[tuple[np.ndarray, np.ndarray]]) -> None:
        size = len(groups)
        bottom = totals + 2 * kept
        zero = _scaled(np.full(size, 2, np.int64), bottom)
        sums = found.setdefault(lang, [groups, np.zeros((size, size), np.int64)])[1]
        row = np.repeat(np.arange(len(terms)), [len(g) for g, _ in terms])
        at = np.searchsorted(groups, np.concatenate([g for g, _ in terms]))
        counts = np.zeros((len(terms), size), np.int64)
        counts[row, at] = np.concatenate([c for _, c in terms])
        p, has = _scaled(counts + 2, bottom[None, :]), counts > 0
        one_sided, both, n_both = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)
        for a in range(size):
            mine = has[:, a]
            value, shared = _distance(p[mine, a : a + 1], p[mine]), has[mine]
            one_sided[a], both[a], n_both[a] = value.sum(axis=0), (value * shared).sum(axis=0), shared.sum(axis=0)
        n = np.diag(n_both)
        neither = len(terms) - n[:, None] - n[None, :] + n_both
        sums += one_sided + one_sided.T - both + neither * _distance(zero[:, None], zero[None, :])

    for batch in batches:
        langs, kept = batch.column(0).to_pylist(), batch.column(5).to_pylist()
        groups, counts, all_groups, totals = (batch.column(c) for c in (1, 2, 3, 4))
        start = 0
        while start < len(langs):
            names, bottom = all_groups[start].values.to_numpy(), totals[start].values.to_numpy()
            stop, most = start + 1, max(1, CELLS // len(names))
            while stop < len(langs) and langs[stop] == langs[start] and stop - start < most:
                stop += 1
            terms = [(groups[i].values.to_numpy(), counts[i].values.to_numpy()) for i in range(start, stop)]
            add(langs[start], names, bottom, kept[start], terms)
            start = stop
    for lang, (groups, sums) in found.items():
        one, two = np.triu_indices(len(groups), 1)
        columns = [np.full(len(one), lang), groups[one], groups[two], sums[one, two]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["lang_no", "one", "two", "value"])


def _groups(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, int]:
    """lang, source, lang_no, group: the numbers are hashes by the first seed that gives no two the same."""
    pairs = stage(docs.select("lang", "source").distinct(), "source-groups")
    while True:
        numbered = pairs.select("lang", "source", *_numbers(seed))
        distinct = numbered.agg(*(F.countDistinct(c) for c in ("lang", "lang_no", "group")), F.count(F.lit(1))).first()
        if distinct[0] == distinct[1] and distinct[2] == distinct[3]:
            return numbered, seed
        seed += 1


def _numbers(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "lang").alias("lang_no"), F.xxhash64(F.lit(seed), "lang", "source").alias("group")]


def _kept_terms(runs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms with their counts by group, and the strings of digests that one term has."""
    key = ["lang_no", "digest"]

    def merged(rows: DataFrame, name: str) -> DataFrame:
        order = [*key, "split"]
        together = rows.select(*order, "n_docs", "counts").repartition(*order).sortWithinPartitions(*order)
        return stage(together.mapInArrow(_merge(min_docs), _KEPT), name)

    likely = merged(runs.withColumn("split", F.lit(None).cast("string")), "kept-digests")
    strings = runs.select(*key, "term").join(likely.select(*key), key, "left_semi")
    names = stage(strings.groupBy(*key).agg(F.min("term").alias("term"), F.max("term").alias("last")), "kept-strings")
    shared = names.where("term < last").select(*key)
    if shared.isEmpty():
        return likely, names.select(*key, "term")
    split = merged(runs.join(shared, key, "left_semi").withColumn("split", F.col("term")), "split-digests")
    return stage(likely.join(shared, key, "left_anti").unionByName(split), "kept-terms"), names.where("term = last").select(*key, "term")


def divergence_audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    digest_bits: int = 63,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language, and by which terms.

    A term is a run of letters A-Z, taken in lower case, and of characters beyond ASCII. A language keeps the V terms that
    at least ``min_docs`` of its rows have. A group of N kept occurrences gives a term p = 1 + floor(10^9 *
    (count + 2) / (N + 2V)), and f = floor((p - q)^2 / (p + q)). Part ``pair``: f summed over all kept
    terms, for every other source of the language. Part ``term``: the ``top`` terms the source has and for which p is
    above the whole language's q. Rank goes by falling value, then by the item's UTF-8 bytes.

    Null text, language and source are empty strings; texts without terms, empty ones too, count for nothing, but their
    group exists. Every row is a document, repeated ones too. A very long text is a block by itself. Without kept
    terms pairs have the value 0. An empty table gives no rows; other columns aren't read. All arithmetic
    is exact below 2.9e14 occurrences in a language.

    A task holds a square of a language's sources, as large as the part ``pair`` itself, and nothing else that grows.
    """
    filled_docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    groups, seed = _groups(filled_docs)
    runs = stage(filled_docs.select("text", *_numbers(seed)).mapInArrow(_count(digest_bits), _RUNS), "term-runs")
    kept, names = _kept_terms(runs, min_docs)

    entries = kept.select("lang_no", "digest", "split", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("lang_count"), F.inline(F.arrays_zip(F.col("groups").alias("group"), F.col("counts").alias("count"))))
    totals = entries.groupBy("group").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang_no").agg(F.count(F.lit(1)).alias("kept"))
    zero = F.lit(0).cast("bigint")
    sized = groups.join(totals, "group", "left").join(sizes, "lang_no", "left").select(
        "lang", "source", "lang_no", "group", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept")
    )
    sized = stage(sized.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang_no"))), "sized-groups")

    # Sums over the kept terms, for each two sources of a language.
    in_order = F.sort_array(F.collect_list(F.struct("group", "total")))
    profile = sized.groupBy("lang_no").agg(in_order.alias("p"), F.first("kept").alias("kept"))
    profile = stage(profile.select("lang_no", F.col("p.group").alias("all_groups"), F.col("p.total").alias("totals"), "kept"), "language-profiles")
    sums = kept.select("lang_no", "groups", "counts").join(profile, "lang_no").select("lang_no", "groups", "counts", "all_groups", "totals", "kept")
    sums = sums.mapInArrow(_pair_sums, _SUMS).groupBy("one", "two").agg(F.sum("value").alias("value"))
    own = sized.select("lang", "source", "lang_no", F.col("group").alias("own"))
    other = sized.select(F.col("source").alias("item"), "lang_no", F.col("group").alias("other"))
    pairs = own.join(other, "lang_no").where("own <> other").withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
    pairs = pairs.join(sums, ["one", "two"], "left").select("lang", "source", "item", F.coalesce("value", zero).alias("value"))

    # The terms a source has more of than its language; ties of the last place are told apart by their strings.
    p = _scaled_column(F.col("count") + 2, F.col("total") + 2 * F.col("kept"))
    q = _scaled_column(F.col("lang_count") + 2, F.col("lang_total") + 2 * F.col("kept"))
    more = entries.join(sized, ["lang_no", "group"]).select("lang", "source", "lang_no", "digest", "split", p.alias("p"), q.alias("q")).where("p > q")
    more = more.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    of_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = more.withColumn("place", F.rank().over(of_source)).where(F.col("place") <= top).drop("place", "p", "q")
    # Kept outputs get their strings; a handful for each source.
    named = best.join(names, ["lang_no", "digest"], "left").select("lang", "source", F.coalesce("split", "term").alias("item"), "value")

    ranked = [
        rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).withColumn("part", F.lit(part))
        for rows, part in ((pairs, "pair"), (named, "term"))
    ]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
