import random
import re
from collections import Counter, defaultdict

import pytest

from wattloom.llm import near_dedup as module
from wattloom.llm.components import connected_components
from wattloom.llm.near_dedup import near_dedup


def shingles(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    seen = defaultdict(list)
    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in seen[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            seen[s].append(i)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def run(spark, rows, size, percent=80):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, n_shingles int, component_id string")
    return sorted(tuple(r) for r in near_dedup(docs, size, percent).collect())


def corpus(n, seed, edits):
    """Families of a base text whose members differ from it in a few words, and texts of their own."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghijklmnop") + str(draw.randrange(40))
    bases = [[word() for _ in range(draw.randrange(30, 120))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = list(draw.choice(bases)) if draw.random() < 0.8 else [word() for _ in range(draw.randrange(1, 60))]
        for _ in range(draw.randrange(edits)):
            words[draw.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "hubs", "edits"), [(2, 512, 12), (2, 3, 12), (5, 4, 4)])
def test_equals_brute_force_in_one_round_or_many(spark, monkeypatch, size, hubs, edits):
    monkeypatch.setattr(module, "HUBS", hubs)
    monkeypatch.setattr(module, "SLICE", 16)
    rows = corpus(160, size * 100 + hubs, edits)
    assert run(spark, rows, size) == brute(rows, size, 80)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, "One  two\n"), (9, "É one"), (10, "é one")]
    assert run(spark, rows, 2) == brute(rows, 2, 80)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "A b c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((tuple(r) for r in near_dedup(docs, 2).collect()), key=str)
    assert found == sorted([(None, 2, None, True), (4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True)], key=str)


def test_empty_table(spark):
    assert run(spark, [], 2) == []


def test_a_long_text_meets_its_copy(spark):
    words = [f"w{i}" for i in range(40_000)]
    other = words[:39_000] + ["x"] * 10
    assert [r[2] for r in run(spark, [(1, " ".join(words)), (2, " ".join(other))], 2)] == [1, 1]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3), (5, 200)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = dict(tuple(r) for r in connected_components(frame, "a", "b").collect())
    assert found == {i: 100 for i in range(101, 141)} | {i: 5 for i in range(200, 260)}


def test_a_large_group_of_near_misses_ends_in_rounds_of_hubs(spark, monkeypatch, tmp_path):
    """Each two differ by a little too much: every round has to settle as many as there are hubs, and leaves no tables."""
    made = []

    def fresh(session, name):
        made.append(f"{tmp_path}/{len(made)}-{name}")
        return made[-1]

    monkeypatch.setattr(module, "HUBS", 12)
    monkeypatch.setattr(module, "fresh_dir", fresh)
    draw, rows = random.Random(3), []
    base = [f"w{i}" for i in range(60)]
    for i in range(60):
        words = list(base)
        for at in draw.sample(range(1, 59, 3), 3):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    expected = brute(rows, 2, 80)
    assert run(spark, rows, 2) == expected and sum(kept for *_, kept in expected) > 40
    assert sum(name.endswith("-led-buckets") for name in made) <= 60 / 12 + 3
    assert not any(path.is_dir() for path in tmp_path.iterdir())
