"""The language network on invented languages, and on documents held out of the given tables."""

import random
from zlib import crc32

import numpy as np
import pytest

from strikeloom.llm import language_cnn
from strikeloom.llm.queries import op12_language_cnn

SYLLABLES = {
    "aa": ["ka", "lo", "mi", "ru", "te"],
    "bb": ["sch", "ung", "ein", "ver", "ach"],
    "cc": ["é", "oux", "tre", "ç", "que"],
}
SCHEMA = "doc_id bigint, text string, lang string, score int, letters int, h string"


def text(lang, words, seed):
    pick = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang]
    return " ".join("".join(pick.choices(parts, k=pick.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, text(lang, 5 + k % 60, k), lang, 1, 1, "") for k, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(500 + k, rows[0][1], "aa", None, None, None) for k in range(200)]
    rows += [
        (900, None, "aa", None, None, None),
        (901, "", "bb", None, None, None),
        (902, "12 34 -- %%\n", "bb", None, None, None),
        (903, text("bb", 60_000, 1), None, None, None, None),
        (904, text("aa", 3_000, 1) + " " + text("cc", 30_000, 2), None, None, None, None),
        (None, text("bb", 40, 3), "aa", None, None, None),
        (905, text("cc", 20, 5).upper(), None, None, None, None),
        (905, text("cc", 20, 5).upper(), None, None, None, None),
    ]
    return rows, language_cnn.predicted(spark.createDataFrame(rows, SCHEMA)).collect()


def test_languages_are_told_apart(judged):
    rows, found = judged
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    for doc_id, _, lang, *_ in rows[:380]:
        assert by_id[doc_id].lang_pred == lang
        assert by_id[doc_id].held_out == (crc32(str(doc_id).encode()) % 3 == 1)
    assert [by_id[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert [by_id[k].score for k in (900, 901, 902)] == [0.0] * 3
    assert by_id[903].lang_pred == "bb"
    assert by_id[904].lang_pred == "cc"
    assert by_id[905].lang_pred == "cc"
    assert by_id[None].lang_pred == "bb" and by_id[None].held_out is False
    assert all(0 <= row.score <= 1 for row in found)


def test_held_out_documents_teach_nothing(spark):
    rows = [(k, text("aa", 20, k), "aa") for k in range(60)]
    rows += [(k, text("bb", 20, k), "bb") for k in range(60, 200) if crc32(str(k).encode()) % 3 == 1]
    found = language_cnn.predicted(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert {(row.lang_pred, row.score) for row in found.collect()} == {("aa", 1.0)}


def test_nothing_learned_and_nothing_read(spark, judged):
    table = spark.createDataFrame(judged[0], SCHEMA)
    unlabelled = language_cnn.predicted(table.selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {(row.lang_pred, row.score) for row in unlabelled.collect()} == {("und", 0.0)}
    assert language_cnn.predicted(table.limit(0)).collect() == []


def test_windows_cover_whole_texts_once():
    for size in (0, 1, 3, 4, 252, 253, 256, 257, 1000, language_cnn.SEGMENT, language_cnn.SEGMENT + 5):
        data = np.random.default_rng(size).integers(1, 256, size, dtype=np.uint8).tobytes()
        grams = set()
        added = 0
        for windows, bytes_added in language_cnn.windows_of(data):
            assert windows.shape == (len(bytes_added), language_cnn.WINDOW)
            added += bytes_added.sum()
            if size <= 1000:
                grams |= {w.tobytes()[i : i + 4] for w in windows for i in range(253)}
        assert abs(added - size) <= 3 * (1 + size // language_cnn.SEGMENT)
        if size <= 1000:
            assert {data[i : i + 4] for i in range(size - 3)} <= grams


def test_tabulated_responses_equal_the_convolution():
    net = language_cnn.Network.fresh(["a", "b", "c"], seed=3)
    windows = np.random.default_rng(1).integers(0, 256, (70, language_cnn.WINDOW), dtype=np.uint8)
    peaks = [language_cnn._responses(filters, windows).max(0) for filters in net.filters]
    features = np.maximum(np.hstack(peaks) + net.bias, 0)
    expected = language_cnn._softmax(features @ net.weights + net.offsets)
    assert np.allclose(language_cnn.Reader(net).probabilities(windows), expected, atol=1e-5)


def test_gradients_equal_differences():
    net = language_cnn.Network.fresh(["a", "b"], seed=4)
    for k, p in enumerate(net.parameters()):
        p += np.random.default_rng(k).normal(0, 0.05, p.shape).astype(np.float32)
    windows = np.random.default_rng(1).integers(1, 256, (6, language_cnn.WINDOW), dtype=np.uint8)
    answers = np.array([0, 1, 0, 1, 1, 0])
    keep = np.ones((6, len(net.bias)), np.float32)

    def loss():
        peaks = [language_cnn._responses(filters, windows).max(0) for filters in net.filters]
        z = np.maximum(np.hstack(peaks) + net.bias, 0).astype(np.float64) @ net.weights + net.offsets
        return -np.log(language_cnn._softmax(z)[np.arange(6), answers]).mean()

    gradients = language_cnn._gradients(net, windows, answers, keep)
    for p, g in zip(net.parameters(), gradients):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 0.002
        up = loss()
        p[at] -= 0.004
        down = loss()
        p[at] += 0.002
        assert (up - down) / 0.004 == pytest.approx(g[at], rel=0.05)


def test_held_out_accuracy_on_the_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    joined = op12_language_cnn(spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    right = [row.lang == row.lang_pred for row in joined]
    assert sum(right) >= 0.98 * len(right)
