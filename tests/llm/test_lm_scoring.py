import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattloom.llm import lm_scoring as module
from wattloom.llm.lm_scoring import PRIOR, cross_entropy_difference

BEGIN, END = "<begin>", "<end>"


def brute(rows, targets):
    """(doc_id, losses) of each row by the definition: word pairs, smoothed by words, smoothed by the vocabulary."""
    def events(text):
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        return list(zip([BEGIN, *words], [*words, END])) if words else []

    pairs, vocabulary = [Counter(), Counter()], set()
    for i, t in rows:
        pairs[0 if i in targets else 1].update(events(t))
        vocabulary |= {w for _, w in events(t)}
    scale = pairs[0].total() / pairs[1].total() if all(pairs) else 1.0
    pairs[1] = Counter({g: n * scale for g, n in pairs[1].items()})

    def loss(counts, event):
        word = sum(n for (_, w), n in counts.items() if w == event[1])
        context = sum(n for (p, _), n in counts.items() if p == event[0])
        p = (word + PRIOR / len(vocabulary)) / (counts.total() + PRIOR)
        return -math.log2((counts[event] + PRIOR * p) / (context + PRIOR))

    return [(i, *(tuple(sum(loss(s, e) for e in events(t)) / len(events(t)) for s in pairs) if events(t) else (None, None))) for i, t in rows]


def check(spark, rows, targets):
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, difference double").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in targets] + [(2, None), (None, 1), (6, 0)], "doc_id bigint, quality int")
    key = lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])
    found = sorted(((r.doc_id, r.target_loss, r.background_loss) for r in cross_entropy_difference(docs, labels, F.col("quality") == 1).collect()), key=key)
    expected = sorted(brute(rows, targets), key=key)
    assert [r[0] for r in found] == [r[0] for r in expected]
    for one, other in zip(found, expected):
        assert one[1:] == (pytest.approx(other[1:], abs=1e-9) if other[1] is not None else other[1:])


@pytest.mark.parametrize("targets", [{1, 3}, set()])
def test_equals_brute_force(spark, targets):
    check(spark, [(1, "the cat sat"), (2, "ékä zz é"), (3, "the mat"), (4, None), (5, ""), (6, "a"), (7, " a\tb\n"), (8, "the the"), (None, "the cat")], targets)


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(module, "BUCKET_TOKENS", 40)
    draw = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(draw.choices(words, [1 / (k + 1) for k in range(50)], k=draw.randrange(0, 30)))) for i in range(120)]
    check(spark, rows + [rows[5], rows[5], (rows[6][0], rows[7][1])], {i for i in range(0, 120, 3)})


def test_a_long_text(spark):
    long = "some words again and again " * 40_000
    check(spark, [(1, long), (2, "some words"), (3, "other words")], {1})


def test_counts_grow_with_the_corpus(spark):
    """The model has every pair of words that occurs, however many: what is sent for it is no smaller than that."""
    docs = spark.range(2_000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 50), x -> concat('w', pmod(xxhash64(id, x), 100000)))) AS text")
    placed = docs.mapInArrow(module._cut, module._PLACES).selectExpr("*", "CAST(NULL AS array<int>) AS targets")
    pieces = placed.select("block", "lengths", "words", "places", "targets").mapInArrow(module._send(3), module._PIECES)
    n = sum(len(p) for row in pieces.select("pack").collect() for p in module._unpacked(row.pack, 6)[3:4])
    assert n >= docs.selectExpr("explode(slice(split(text, ' '), 1, 49)) AS w").count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert cross_entropy_difference(docs, labels, F.col("quality") == 1).collect() == []


def test_held_out_targets_score_lower(spark):
    docs = [(i, ("good words here " if i % 2 else "xq zv kj qq ") * (3 + i % 4)) for i in range(60)]
    labels = [(i, 1) for i in range(1, 40, 2)]
    scored = cross_entropy_difference(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int"), F.col("quality") == 1
    )
    held = {r.doc_id: r.difference for r in scored.where("doc_id >= 40").collect()}
    assert max(d for i, d in held.items() if i % 2) < min(d for i, d in held.items() if not i % 2)
