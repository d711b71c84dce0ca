import random
import time

import pyarrow as pa
import pytest

from wattloom.llm.line_dedup import _select, line_dedup


def brute(rows, least):
    """Windows by the definition: lines covered by a run that an earlier place has, the first copy staying whole."""
    texts = {i: t.split("\n") for i, t in rows if t is not None}
    count = lambda line: len(line.split())
    places = {}
    for i in sorted(texts):
        lines = texts[i]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += count(lines[b])
                shortest = total >= least and (total - count(lines[b]) < least or total - count(lines[a]) < least)
                if shortest:
                    places.setdefault(tuple(lines[a : b + 1]), []).append((i, a, b))
    gone = {i: set() for i in texts}
    for found in places.values():
        first = min(found)
        for place in found:
            if place != first:
                keep = set(range(first[1], first[2] + 1)) if place[0] == first[0] else set()
                gone[place[0]] |= set(range(place[1], place[2] + 1)) - keep
    return sorted((i, len(t), len(gone[i]), "\n".join(x for n, x in enumerate(t) if n not in gone[i])) for i, t in texts.items())


def run(spark, rows, least=50):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_lines int")
    return sorted((tuple(r) for r in line_dedup(docs, least).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    pool = [" ".join(draw.choice("abcdef") for _ in range(draw.randrange(0, 7))) for _ in range(12)]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randrange(1, 25)))) for i in range(60)]
    assert run(spark, rows, 8) == sorted(brute(rows, 8), key=str)


def test_passages_go_but_once(spark):
    passage = "\n".join(" ".join(f"{a}{i}" for i in range(20)) for a in "xyz")
    rows = [(1, f"own one\n{passage}\nend one"), (2, f"own two\n{passage}\nend two"), (3, passage), (4, "short\nshort\nshort"), (5, "long " * 60)]
    found = {r[0]: r[3] for r in run(spark, rows)}
    assert found == {1: rows[0][1], 2: "own two\nend two", 3: "", 4: rows[3][1], 5: rows[4][1]}


def test_odd_rows(spark):
    line = "w " * 60
    rows = [(1, None), (2, ""), (None, line), (3, line), (3, line), (4, f"{line}\n{line}")]
    found = run(spark, rows)
    expected = [(1, 0, 0, None), (2, 1, 0, ""), (None, 1, 0, line), (3, 1, 0, line), (3, 1, 0, line), (4, 2, 2, "")]
    assert found == sorted(expected, key=str)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_blank_lines_cost_no_more_than_others(spark):
    text = "\n" * (1 << 20) + "\n".join(f"word{i} next" for i in range(30))
    batch = pa.record_batch([pa.array([1, 2]), pa.array([text, "other " + text])], names=["doc_id", "text"])
    began = time.process_time()
    rows = sum(part.num_rows for part in _select(50)([batch]))
    assert time.process_time() - began < 4 and rows > 1 << 20  # two texts of a megabyte each
    found = run(spark, [(1, "\n" * 3000 + text[-400:]), (2, "end " * 50 + "\n" * 3000 + text[-400:])])
    assert [r[2] for r in found] == [0, 3000 + text[-400:].count("\n")]


def test_long_texts_and_lines(spark):
    passage = "\n".join(f"line {i} of the passage with some words" for i in range(3000))
    rows = [(1, passage), (2, "before\n" + passage + "\nafter"), (3, "x " * 200_000), (4, "x " * 200_000 + "\nown")]
    assert [(r[0], r[2], len(r[3])) for r in run(spark, rows)] == [(1, 0, len(passage)), (2, 3000, 12), (3, 0, 400_000), (4, 1, 3)]
