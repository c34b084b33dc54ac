"""The language model against plain Python, and languages with little trusted text."""

import random
from collections import Counter
from math import log2
from zlib import crc32

import pytest

from strikeloom.llm import kneser_ney

PAD = "\x02" * 3


def text(seed, words, letters="aeioklmnrst"):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(letters, k=pick.randint(1, 6))) for _ in range(words))


def plain_model(texts):
    """Probability of a character after three others, by the textbook recursion."""
    counts = {4: Counter()}
    for each in texts:
        padded = PAD + each
        counts[4].update(padded[i : i + 4] for i in range(len(each)))
    for order in (3, 2, 1):
        counts[order] = Counter(gram[1:] for gram in counts[order + 1])
    discounts, totals, spare = {}, {}, {}
    for order, grams in counts.items():
        n = Counter(grams.values())
        found = []
        for k in (1, 2, 3):
            d = k / 2
            if n[1] and n[2] and n[3]:
                d = k - (k + 1) * n[1] / (n[1] + 2 * n[2]) * n[k + 1] / n[k]
            found.append(d if 0 < d < k else k / 2)
        discounts[order] = found
        totals[order], spare[order] = Counter(), Counter()
        for gram, c in grams.items():
            totals[order][gram[:-1]] += c
            spare[order][gram[:-1]] += found[min(c, 3) - 1]

    def probability(gram):
        p = 1 / (len(counts[1]) + 1)
        for order in (1, 2, 3, 4):
            own = gram[4 - order :]
            total = totals[order][own[:-1]]
            if total:
                c = counts[order][own]
                kept = c - discounts[order][min(c, 3) - 1] if c else 0
                p = kept / total + spare[order][own[:-1]] / total * p
        return p

    return probability


def test_perplexities_equal_plain_python(spark):
    rows = [(k, text(k, 5 + k % 40), "xx" if k % 3 else "yy") for k in range(60)]
    rows += [(100 + k, text(k, 3, "aeqz") + " \U0001f600", "xx") for k in range(4)]
    trusted = [k for k in range(60) if k % 5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    ids = spark.createDataFrame([(k,) for k in trusted], "doc_id bigint")
    found = {row.doc_id: row.perplexity for row in kneser_ney.classified(docs, ids).collect()}
    models = {
        (lang, half): plain_model(
            [t for k, t, other in rows if k in set(trusted) and other == lang and crc32(t.encode()) & 1 != half]
        )
        for lang in ("xx", "yy")
        for half in (0, 1)
    }
    for k, t, lang in rows:
        probability = models[lang, crc32(t.encode()) & 1]
        folded = "".join(min(c, "￿") for c in t)
        bits = sum(-log2(probability((PAD + folded)[i : i + 4])) for i in range(len(t)))
        assert found[k] == pytest.approx(2 ** (bits / len(t)), rel=0.001)


@pytest.mark.parametrize("few", [0, 1, 5])
def test_thin_languages_are_left_alone(spark, few):
    rows = [(k, text(k, 60), "xx") for k in range(80)]
    rows += [(100 + k, text(500 + k, 40, "bdfghu"), "thin") for k in range(30)]
    rows += [(200 + k, "word", "one word") for k in range(30)]
    rows += [(300, "%%% &&& ### " * 30, "xx"), (301, "", "thin"), (302, None, "one word")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trusted = [*range(60), *range(100, 100 + few), *range(200, 200 + few)]
    ids = spark.createDataFrame([(k,) for k in trusted], "doc_id bigint")
    kept = {row.doc_id: row.kept for row in kneser_ney.classified(docs, ids).collect()}
    assert all(kept[k] for k in range(100, 130)) and all(kept[k] for k in range(200, 230))
    assert sum(kept[k] for k in range(80)) >= 78
    assert not kept[300] and not kept[301] and not kept[302]


def test_limits_count_ties_and_widen_for_few(spark):
    def bounds(values, **options):
        rows = [("xx", v, True) for v in values] + [("xx", 99.0, False), ("xx", None, True)]
        frame = spark.createDataFrame(rows, "lang string, bits double, trusted boolean")
        return [tuple(row)[1:] for row in kneser_ney.limits(frame, **options).collect()]

    assert bounds([2.0] * 19) == []
    assert bounds([2.0] * 20) == [(2.0, 2.0)]
    assert bounds([1.0] + [2.0] * 20 + [2.5]) == [(0.0, 3.0)]
    assert bounds([1.0] + [2.0] * 20 + [2.5], many=20) == [(1.0, 2.5)]
    assert bounds([1.0] * 10 + [2.0] * 300 + [3.0], many=20, high=0.99) == [(1.0, 2.0)]
