import hashlib
from collections import defaultdict

import pytest

from wattloom.llm import exact_dedup as module
from wattloom.llm.exact_dedup import exact_dedup


def brute(rows, largest=True):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[fold(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[fold(text)] if i is not None]
        keep = (max if largest else min)(ids) if ids else None
        digest = hashlib.sha256(fold(text).encode()).hexdigest()
        out.append((doc_id, keep, len(groups[fold(text)]), doc_id == keep, digest))
    return sorted(out, key=str)


def run(spark, rows, parts=1, **options):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id bigint, text string, digest string, run int")
    return sorted((tuple(r) for r in exact_dedup(docs.repartition(parts), **options).collect()), key=str)


ROWS = [(5, "A b"), (9, "a B"), (None, "a b"), (2, None), (3, ""), (None, "only"), (7, "É"), (8, "é"), (5, "A b"), (4, "x" * 100_000)]


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("largest", [True, False])
def test_equals_brute_force(spark, parts, largest):
    assert run(spark, ROWS, parts, largest=largest) == brute(ROWS, largest)


def test_one_text_in_most_rows_takes_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(module, "FAN_BITS", 1)
    rows = [(i, "same" if i % 3 else f"text {i}") for i in range(500)]
    assert run(spark, rows, 11) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
