import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from wattloom.llm import quality_rules as module
from wattloom.llm.quality_rules import BASE, Condition, DecisionList, learn, quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def texts():
    draw = random.Random(4)
    some = [None, "", " \n\t\x0b ", "a", "a b", "a a a", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "#*$ %&|<>é 😀", "a b " * 4000, "é\x85f \x1cg"]
    return some + [" ".join(draw.choice("abcde") + draw.choice("\n ab") for _ in range(draw.randrange(400))) for _ in range(60)]


def test_statistics_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in enumerate(texts())], "doc_id bigint, text string, n_words int, kept string")
    rows = quality(docs, DecisionList(())).collect()
    assert {r.doc_id: tuple(r[c] for c in BASE) for r in rows} == {i: brute(t) for i, t in enumerate(texts())}
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)


def labelled(spark, n=1500):
    draw = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        bad = draw.random() < 0.2
        words = [draw.choice("abcdefghij") * draw.randrange(2, 8) + str(draw.randrange(1000)) for _ in range(draw.randrange(60, 90))]
        if bad:
            words = [w + "##" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad) if draw.random() > 0.01 else None))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_a_rule_is_learned_and_spares_good_texts(spark):
    docs, labels = labelled(spark)
    rules = learn(docs, labels, F.col("quality") == 0)
    assert rules.rules and rules.rules[0][0].feature == "symbols_per_word"
    judged = quality(docs, rules).where("NOT base_failed").join(labels, "doc_id")
    assert judged.where("quality = 1 AND NOT kept").count() == 0
    assert judged.where("quality = 0 AND kept").count() == 0
    assert "symbols_per_word" in str(rules)


def test_no_labels_no_rules(spark):
    docs, labels = labelled(spark, 20)
    assert learn(docs, labels.where("quality > 5"), F.col("quality") == 0).rules == ()
    assert learn(docs.where("doc_id < 0"), labels, F.col("quality") == 0).rules == ()
    assert quality(docs.where("doc_id < 0"), DecisionList(())).collect() == []


def test_the_first_rule_that_fits_is_named(spark):
    rules = DecisionList(((Condition("n_words", True, 3.0),), (Condition("n_words", True, 1.0), Condition("symbols_per_word", False, 0.5))))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b"), (3, "# #"), (4, None)], "doc_id bigint, text string")
    assert {r.doc_id: r.rule for r in quality(docs, rules).collect()} == {1: 1, 2: 2, 3: None, 4: None}


def plain_list(rows, names):
    """Sequential covering by the definition, over (bad, held, values): grow by information gain, prune on the held third, stop."""
    cuts = []
    for f in range(len(names)):
        ordered = sorted(r[2][f] for r in rows)
        cuts.append(sorted({ordered[max(0, math.ceil(i / module.BINS * len(ordered)) - 1)] for i in range(1, module.BINS)}))

    def meets(values, rule):
        return all(values[f] > cut if above else values[f] <= cut for f, above, cut in rule)

    def count(some, rule):
        bad = sum(r[0] for r in some if meets(r[2], rule))
        return bad, sum(meets(r[2], rule) for r in some) - bad

    rules, left = [], rows
    while len(rules) < module.MAX_RULES:
        grown, held, rule = [r for r in left if not r[1]], [r for r in left if r[1]], []
        while len(rule) < module.MAX_CONDITIONS:
            p0, n0 = count(grown, rule)
            if not p0 or not n0:
                break
            best = (0.0, None)
            for f in range(len(names)):
                for cut in cuts[f]:
                    for above in (False, True):
                        p, n = count(grown, [*rule, (f, above, cut)])
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                        if p >= module.LEAST_COVER and gain > best[0] + 1e-9:
                            best = (gain, (f, above, cut))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        ways = []
        for k in range(1, len(rule) + 1):
            p, n = count(held, rule[:k])
            ways.append((p / (p + n) if p + n else 0.0, -k, p, n))
        precision, k, p, _ = max(ways)
        if p < module.LEAST_COVER or precision < module.LEAST_PRECISION:
            break
        rules.append(rule[:-k])
        left = [r for r in left if not meets(r[2], rules[-1])]
    return [[(names[f], above, float(cut)) for f, above, cut in rule] for rule in rules]


def test_the_learned_list_equals_brute_force(spark):
    draw = random.Random(9)
    docs, labels = [], []
    for i in range(900):
        kind = draw.choices(["good", "symbols", "long", "mixed"], [6, 1, 1, 1])[0]
        size = draw.randrange(60, 90) if kind != "long" else draw.randrange(200, 260)
        words = [draw.choice("abcdefghij") * draw.randrange(2, 8) + str(draw.randrange(1000)) for _ in range(size)]
        if kind == "symbols" or (kind == "mixed" and draw.random() < 0.5):
            words = [w + "##" if draw.random() < 0.8 else w for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind in ("good", "mixed"))))
    texts, known = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    names = list(module.features())
    values = module.with_statistics(texts).where(~module.base_failed()).join(known, "doc_id").select(
        (F.col("quality") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("held"), F.array(*module.features().values()).alias("values")
    )
    expected = plain_list([tuple(r) for r in values.collect()], names)
    found = learn(texts, known, F.col("quality") == 0)
    assert [[(c.feature, c.above, c.threshold) for c in rule] for rule in found.rules] == expected and expected


def test_a_very_long_text_is_judged(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    row = quality(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), DecisionList(())).first()
    assert (row.n_words, row.n_repeat_words, row.kept) == (300_000, 0, True)
