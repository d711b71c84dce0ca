import random
import re
from collections import Counter, defaultdict

import pytest

from tests.oracle import compare, connect
from wattloom.llm import divergence as module
from wattloom.llm.divergence import divergence_audit
from wattloom.llm.queries import OP11_SQL, op11_divergence_audit

DDL = "text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    """The contract word for word, over all sources and all kept terms."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = []
    for lang in {r[1] for r in rows}:
        docs, counts = Counter(), defaultdict(Counter)
        for text, _, source in (r for r in rows if r[1] == lang):
            terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
            docs.update(set(terms))
            counts[source].update(terms)
        kept = [t for t, n in docs.items() if n >= min_docs]
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}

        def p(n, bottom):
            return 1 + 10**9 * (n + 2) // (bottom + 2 * len(kept))

        whole = {t: p(sum(c[t] for c in counts.values()), sum(total.values())) for t in kept}
        by_source = {s: {t: p(c[t], total[s]) for t in kept} for s, c in counts.items()}
        for s, mine in by_source.items():
            pairs = [(sum((mine[t] - q[t]) ** 2 // (mine[t] + q[t]) for t in kept), o) for o, q in by_source.items() if o != s]
            terms = [((mine[t] - whole[t]) ** 2 // (mine[t] + whole[t]), t) for t in kept if counts[s][t] and mine[t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(ordered, 1) if part == "pair" or i <= top]
    return sorted(found)


def run(spark, rows, **options):
    return sorted(tuple(r) for r in divergence_audit(spark.createDataFrame(rows, DDL), **options).collect())


def corpus(n, seed):
    draw = random.Random(seed)
    words = ["a", "É", "é", "straße", "漢字", "b'c", "Foo", "foo", "x\x7fy", "z1w"] + [chr(97 + i % 26) * (1 + i // 26) for i in range(60)]
    weights = [1 / (1 + i) for i in range(len(words))]
    return [
        (" ".join(draw.choices(words, weights, k=draw.randrange(30))), draw.choice(["en", "de", None]), draw.choice(["s0", "s0", "s1", "s2", "", None]))
        for _ in range(n)
    ]


def test_equals_brute_force(spark):
    rows = corpus(400, 1)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_terms_that_share_a_digest_are_split(spark, bits):
    rows = corpus(300, 2)
    assert run(spark, rows, digest_bits=bits) == brute(rows)


def test_small_batches_blocks_and_squares(spark, monkeypatch):
    monkeypatch.setattr(module, "COUNT_BLOCK", 100)
    monkeypatch.setattr(module, "CELLS", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = corpus(200, 3)
        assert run(spark, rows, min_docs=4, top=2) == brute(rows, 4, 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "s"), ("1 2 3", "en", "t"), ("Ab aB", "en", "s")] + [("same same", "fr", "s")] * 10 + [("w " * 50_000, "fr", "t")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, min_docs=100) == brute(rows, 100)
    assert run(spark, [rows[-1]] * 12, top=1) == brute([rows[-1]] * 12, top=1)


def test_ties_of_the_last_place_go_by_their_bytes(spark):
    rows = [("é z a 漢 b", "en", "s")] * 10 + [("other", "en", "t")] * 10
    assert run(spark, rows, top=3) == brute(rows, top=3)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = corpus(60, 4)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS digest", "2 AS rank", "'x' AS item", "3 AS lang_no")
    assert sorted(tuple(r) for r in divergence_audit(docs).collect()) == brute(rows)


def test_scaled_arithmetic_is_exact():
    for count, total in ((2, 3), (123_456_789, 987_654_321), (10**13 + 7, 10**14 + 9), (2 * 10**14, 2 * 10**14)):
        assert module._scaled(count, total) == 1 + 10**9 * count // total


def test_query_equals_its_sql(spark):
    assert compare(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", op11_divergence_audit, OP11_SQL) is None
