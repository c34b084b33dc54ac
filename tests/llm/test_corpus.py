"""Corpus operators on small hand-made tables, against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from strikeloom.llm import (
    compact_windows,
    decontamination,
    kneser_ney,
    line_dedup,
    packing,
    pii,
    quality_rules,
    simhash,
    suffix_dedup,
    suffix_runs,
    warc,
)
from strikeloom.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, line string, n bigint"
WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te") for b in ("n", "sta", "vo", "r", "lim", "do")]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40) * (pick.random() < 0.2) or "") for _ in range(n))


def odd_texts():
    long = prose(1, 4000)
    return [
        None,
        "",
        " \n\t",
        "one",
        long,
        long,
        prose(2, 300),
        prose(3, 100) + "\n" + prose(2, 300),
        "Ünï " * 300,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text, "en" if k % 2 else None, "x", 1) for k, text in enumerate(odd_texts())]
    rows += [(None, "nameless text", None, None, None), rows[6], rows[6]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_every_operator_takes_odd_rows_and_empty_tables(spark, docs, nothing):
    items = spark.createDataFrame([(1, prose(2, 40)), (2, None), (None, "x")], "item_id bigint, text string")
    ids = spark.createDataFrame([(4,), (6,), (None,)], "doc_id bigint")
    for table in (docs, nothing):
        n = table.count()
        assert simhash.near_duplicates(table).count() == n
        assert quality_rules.ledger(table).count() == n
        assert line_dedup.without_repeated_lines(table).count() == n
        assert suffix_dedup.without_repeats(table).count() == n
        assert pii.find_personal_data(table).count() == n
        assert kneser_ney.classified(table, ids).count() == n
        assert decontamination.contaminated(table, items).count() == (n and 4)
        assert decontamination.contaminated(table, items.limit(0)).count() == 0
        assert packing.packed(table).count() == sum(
            -(-len((text or "").split()) // 2048) for (text,) in table.select("text").collect()
        )
        found = compact_windows.near_passages(table).select("doc_id").distinct().collect()
        assert {row.doc_id for row in found} == ({5, 7} if n else set())


def test_fingerprints_link_within_two_bits(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    for row in rows:
        near = [r for r in rows if bin((r.fp ^ row.fp) & (1 << 64) - 1).count("1") <= 2]
        assert {r.component_id for r in near} == {row.component_id}
        assert row.component_id == min(
            (r.doc_id for r in rows if r.component_id == row.component_id and r.doc_id is not None),
            default=None,
        )


def test_anchors_meet_for_every_pair_within_two_bits(spark):
    pick = random.Random(5)
    pairs = []
    for _ in range(200):
        fp = pick.getrandbits(64)
        pairs.append((fp, fp ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64))))
    values = np.array(pairs, np.uint64).view(np.int64)
    fps = spark.createDataFrame([(int(v),) for v in values.ravel()], "fp bigint").distinct()
    links = {tuple(sorted(r)) for r in simhash.compared(simhash.anchored(fps, 2), 2).collect()}
    assert links == {tuple(sorted(map(int, p))) for p in values if p[0] != p[1]}
    large = np.arange(3000, dtype=np.int64) << 3
    a, b = simhash._group_links(large, 2)
    assert len(set(a.tolist())) == 2999 and set(b.tolist()) == {0}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    rows = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert rows == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}}


def test_repeated_windows_by_lookup_and_by_sorting(spark):
    texts = ["a b c d a b c", "x " * 500, prose(1, 300) + " " + prose(1, 300), "a b", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in quality_rules.ledger(frame).collect():
        words = texts[row.doc_id].split()
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        assert row.n_repeat_words == len(covered)


def test_ablation_equals_recounting(spark, docs):
    ledger = quality_rules.ledger(docs)
    masks = [row.failures for row in ledger.collect()]
    for row in quality_rules.ablation(ledger, [quality_rules.BASE, quality_rules.FULL]).collect():
        policy = {p.version: p for p in (quality_rules.BASE, quality_rules.FULL)}[row.policy]
        bit = 1 << list(quality_rules.RULES).index(row.rule)
        assert row.n_rejected == sum(m & policy.mask() != 0 for m in masks)
        assert row.n_only == sum(m & policy.mask() == bit for m in masks)


def test_lines_one_edit_apart_go(spark):
    line = "the quick brown fox jumps over the lazy dog again and again"
    edits = [line[:k] + "#" + line[k + 1 :] for k in range(0, len(line), 5)]
    edits += [line[:k] + line[k + 1 :] for k in (0, 15, 16, 31, 32, len(line) - 1)]
    edits += [line[:k] + "@" + line[k:] for k in (0, 16, 33, len(line))]
    far = [line[:3] + "##" + line[5:], "short line"]
    texts = [line, *edits, *far, "short line"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.n_removed for r in line_dedup.without_repeated_lines(frame).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for k, text in enumerate(texts):
        near = len(text) >= 20 and any(
            distance(text, other) <= 1 for other in texts[:k] if len(other) >= 20
        )
        assert rows[k] == near, text


def test_repeated_bytes_equal_brute_force(spark):
    shared = prose(8, 60)
    texts = [prose(9, 80) + shared + "é" + prose(10, 20), shared, "z" * 700, prose(11, 50) + "q" + shared[40:]]
    texts += [shared[:350], prose(12, 90)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    data = [t.encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    for row in suffix_dedup.without_repeats(frame).collect():
        own = data[row.doc_id]
        gone = {i + k for i in range(len(own) - 199) if seen[own[i : i + 200]] > 1 for k in range(200)}
        assert bytes(row.kept) == bytes(b for i, b in enumerate(own) if i not in gone)


def test_merged_runs_are_sorted_with_their_common_prefixes():
    pick = random.Random(3)
    runs = [sorted(bytes(pick.choices(b"ab", k=pick.randrange(12))) for _ in range(n)) for n in (9, 0, 1, 30, 4)]
    source = [suffix_runs.decoded(suffix_runs.front_coded(run)) for run in runs]
    at, out = [0] * len(runs), []
    for run, known in suffix_runs.merged(source):
        string = runs[run][at[run]]
        at[run] += 1
        assert not out or known == suffix_runs.common_prefix(out[-1], string, 0)
        out.append(string)
    assert out == sorted(sum(runs, []))


def test_items_are_found_across_passage_borders(spark):
    item = "what is the name of that river in the north. it is called the long cold river of stones."
    texts = [prose(20 + k, n) + " " + item.upper() + " " + prose(40, 30) for k, n in enumerate((0, 55, 63, 64, 120))]
    texts += [prose(30, 200), item.split(".")[0] + " and nothing else"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(k, prose(60 + k, 40)) for k in range(40)] + [(99, item)], "item_id bigint, text string")
    found = decontamination.contaminated(frame, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, 99) for k in range(5)}


def test_personal_data_equals_the_patterns():
    text = "a@b.cd_e@f.gh @x.y 1.2.3.4.5.6.7.8 1.2.3.256 x 4111 1111 1111 1111 x 4111111111111112 x +1 (212) 555-0100 +12"
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    address = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    spans = pii.base_spans(text)
    assert [(i, j) for i, k, j in spans if k == 0] == [m.span() for m in email.finditer(text)]
    assert [(i, j) for i, k, j in spans if k == 1] == [
        m.span() for m in address.finditer(text) if max(map(int, m.group().split("."))) <= 255
    ]
    assert [text[i:j] for i, k, j in spans if k == 2] == ["4111 1111 1111 1111"]
    assert [text[i:j] for i, k, j in spans if k == 3] == ["+1 (212) 555-0100"]


def test_labelers_agree_on_secrets(spark):
    rows = [(k, f'the token = "{hashlib.sha1(bytes([k])).hexdigest()}" of page {k}') for k in range(50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for row in pii.find_personal_data(frame).collect():
        assert [s.split(":")[0] for s in row.spans.split(",")] == ["secret"]


def test_probabilities_add_up_and_rank_noise_last(spark):
    rows = [(k, prose(k, 200), "en", True) for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, trusted boolean")
    asked = frame.unionByName(frame.selectExpr("doc_id", "'zz' AS text", "lang", "false AS trusted"))
    table = kneser_ney.log_probabilities(kneser_ney.ngram_counts(asked)).toPandas()
    context = table.assign(c=table["key"].to_numpy(np.int64).view(np.uint64) >> np.uint64(16))
    sums = (2.0 ** -context["bits"]).groupby([context["lang"], context["c"]]).sum()
    assert (sums <= 1 + 1e-9).all() and sums.max() > 0.9
    noise = spark.createDataFrame([(100, "%%%&&& " * 40, "en"), (3, prose(3, 200), "en")], "doc_id bigint, text string, lang string")
    docs = frame.select("doc_id", "text", "lang").unionByName(noise.limit(1))
    verdicts = {r.doc_id: r.kept for r in kneser_ney.classified(docs, frame.select("doc_id")).collect()}
    assert not verdicts[100] and sum(verdicts.values()) >= 19


def test_boundaries_are_optimal():
    pick = random.Random(2)
    counts = {n: pick.randrange(1, 50) for n in pick.sample(range(1, 65), 20)}
    edges = packing.boundaries(counts, buckets=3, step=8, top=64)

    def cost(chosen):
        return sum(c * min(e for e in chosen if e >= n) for n, c in counts.items())

    every = range(8, 65, 8)
    assert cost(edges) == min(cost([a, b, 64]) for a in every for b in every)


def test_batches_keep_their_budget(spark, docs):
    rows = packing.packed(docs, max_tokens=64, step=8, budget=256).collect()
    places = Counter((r.bucket_tokens, r.batch, r.slot) for r in rows)
    assert set(places.values()) == {1}
    assert all(r.slot < max(1, 256 // r.bucket_tokens) and r.n_tokens <= r.bucket_tokens for r in rows)


def test_archives_come_back_whole(spark):
    pages = [(k, "u", "x" * (k * 9000) + "\r\n\r\nWARC/1.1\r\n" + "é") for k in range(5)]
    pages += [(5, None, ""), (6, "u", None), (7, "u", pages[4][2]), (None, "u", pages[4][2]), (7, "u", pages[4][2])]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    for row in warc.archive_round_trip(frame).collect():
        same = [h for i, _, h in pages if i == row.page_id][0] or ""
        largest = max(i for i, _, h in pages if (h or "") == same and i is not None)
        assert row.payload_bytes == len(same.encode())
        assert row.payload_digest == warc.payload_digest(same.encode())
        assert row.refers_to == (None if row.page_id == largest else largest)
        assert row.record_type == ("response" if row.page_id == largest else "revisit")
    empty = warc.archive_round_trip(frame.limit(0))
    assert empty.count() == 0


def test_missing_segments_are_an_error(spark):
    parts = list(warc.records_of(1, "1", "u", b"x" * 50000, "00" * 20, None))
    assert len(parts) > 2
    rows = [warc._row(*next(iter(warc.parse_records(p + b"\r\n\r\n")))) for p in parts[:1] + parts[2:]]
    with pytest.raises(Exception, match="segments missing"):
        warc.reassembled(spark.createDataFrame(rows, warc.PARSED)).collect()


def words_of(seed, n):
    pick = random.Random(seed)
    return [f"w{pick.randrange(10**6)}" for _ in range(n)]


def runs_of(words):
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def alike(a, b):
    x, y = runs_of(a), runs_of(b)
    return len(x & y) / len(x | y)


def near_ids(spark, texts):
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    return compact_windows.near_passages(frame).collect()


@pytest.mark.parametrize("n", range(50, 91, 8))
def test_insertions_and_deletions_equal_brute_force(n):
    passage = words_of(n, n)
    for other in (passage[: n // 2] + ["new"] + passage[n // 2 :], passage[: n // 2] + passage[n // 2 + 1 :]):
        a, b = words_of(1, 40) + passage + words_of(2, 30), words_of(3, 20) + other + words_of(4, 50)
        for x, y in ((a, b), (b, a)):
            tokens = [compact_windows.shingles(" ".join(t)) for t in (x, y)]
            found = compact_windows.passages(*tokens, 46, 0.8)
            near = {
                i
                for i in range(len(x) - 49)
                for j in range(len(y) - 49)
                for size in range(50, 62)
                if alike(x[i : i + 50], y[j : j + size]) >= 0.8
            } if n == 50 else set()
            assert found and all(any(s <= i and i + 46 <= e for s, e, _, _ in found) for i in near)
            assert all(share >= 0.8 for *_, share in found)


def test_every_repeat_of_a_passage_is_found(spark):
    passage = words_of(1, 60)
    texts = [words_of(2, 30) + passage + words_of(3, 30)]
    texts.append(sum((words_of(k, 40) + passage for k in range(4, 9)), []))
    found = [(r.start_word, r.end_word) for r in near_ids(spark, texts)]
    for k in range(5):
        place = 40 + 100 * k
        assert any(i <= place and place + 60 <= j for i, j in found), k


def test_equal_passages_are_found_behind_an_earlier_variant(spark):
    texts = []
    for k in range(24):
        passage = words_of(k, 50)
        variant = passage[:40] + words_of(100 + k, 10)
        assert 0.6 < alike(passage, variant) < 0.8
        texts += [variant, passage, words_of(200 + k, 70) + passage]
    found = {(r.doc_id, r.partner_id) for r in near_ids(spark, texts)}
    near = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if set(b[:50]) <= set(a)}
    assert found == near and len(near) == 24


def test_closed_windows_stay_as_partners(spark):
    base = words_of(1, 50)
    texts = [base[:47] + words_of(2, 3), base, words_of(3, 3) + base[3:]]
    assert alike(texts[0], texts[1]) >= 0.8 > alike(texts[0], texts[2])
    assert alike(texts[1], texts[2]) >= 0.8
    assert {r.doc_id for r in near_ids(spark, texts)} == {1, 2}


def test_every_length_can_be_a_bucket():
    pick = random.Random(4)
    counts = {65: 1000, **{n: pick.randrange(1, 50) for n in pick.sample(range(1, 2049), 60)}}
    edges = packing.boundaries(counts, buckets=3)

    def cost(chosen):
        return sum(c * min(e for e in chosen if e >= n) for n, c in counts.items())

    assert cost(edges) == min(cost([a, b, 2048]) for a in counts for b in counts)
    assert packing.boundaries({65: 5, 2048: 1}) == [65, 2048]


def test_near_passages_of_hundreds_of_pairs(spark):
    pick = random.Random(9)
    texts, wanted = [], set()
    for k in range(240):
        passage = words_of(k, pick.choice((50, 60, 90)))
        other = list(passage)
        for _ in range(pick.randrange(3)):
            place = pick.randrange(len(other))
            other[place : place + pick.choice((0, 1))] = [f"new{pick.random()}"] * pick.choice((0, 1))
        texts += [words_of(1000 + k, 20) + passage, other + words_of(2000 + k, 35)]
        near = any(
            alike(passage[i : i + 50], other[j : j + size]) >= 0.8
            for i in range(len(passage) - 49)
            for j in range(max(0, i - 3), i + 4)
            for size in (49, 50, 51, 52)
            if 50 <= len(other[j : j + size])
        )
        wanted |= {(2 * k + 1, 2 * k)} if near else set()
    found = {(r.doc_id, r.partner_id) for r in near_ids(spark, texts)}
    assert len(wanted) > 150 and len(found & wanted) >= 0.97 * len(wanted)
    assert all(a // 2 == b // 2 for a, b in found)


def test_overlapping_windows_of_two_functions_equal_brute_force(spark):
    pick = random.Random(6)
    rows, wanted = [], set()
    for doc in range(4):
        for f in range(3):
            for place in sorted(pick.sample(range(400), 40)):
                first, last = max(0, place - pick.randrange(60)), place + pick.randrange(60)
                if last - first + 1 >= 20:
                    rows.append((place * 8 + f, doc, first, place, last))
    frame = spark.createDataFrame(rows, "key bigint, doc_id bigint, first int, place int, last int")
    for x in rows:
        for y in rows:
            if x[1] == y[1] and x[0] & 7 < y[0] & 7:
                low, high = max(x[2], y[2]), min(x[4], y[4])
                p, q = sorted((x[3], y[3]))
                if any(20 <= e - s + 1 <= 30 for s in range(low, p + 1) for e in range(q, high + 1)):
                    wanted.add((x[1], p, q, x[0], y[0]))
    found = compact_windows.joint_windows(frame, 20, 30).collect()
    assert sorted((r.doc_id, r.place, r.until) for r in found) == sorted(w[:3] for w in wanted)
    assert len({r.key for r in found}) > len(found) // 2


def test_candidates_of_long_unbroken_texts_take_linear_time():
    for text in ("7" + "x" * 10**6, "日本" * 500_000 + "1", "a@" * 300_000):
        found = list(pii.candidates(text, pii.base_spans(text)))
        assert [(c.start, c.end) for c in found] == [(0, len(text))]
    text = "x1y, =a.b@c.de; 12!"
    assert [c.token for c in pii.candidates(text, [])] == ["x1y", "a.b@c.de", "12"]
    assert [c.token for c in pii.candidates(text, [(6, 0, 14)])] == ["x1y", "12"]


def test_every_verified_item_is_retrieved(spark):
    pick = random.Random(12)
    items, texts = [], []
    for k in range(60):
        question, answer = words_of(5000 + k, pick.choice((3, 12, 40))), words_of(6000 + k, pick.choice((1, 6, 12)))
        question = [w if pick.random() < 0.5 else pick.choice(WORDS) for w in question]
        items.append((k % 50, " ".join(question) + "\n" + " ".join(answer)))
        for lost in (0, 1, 3):
            held = list(question)
            for place in pick.sample(range(len(held)), min(lost, len(held))):
                held[place] = "other"
            tail = answer if pick.random() < 0.7 else answer[:-1] + ["gone"]
            texts.append(prose(pick.random(), pick.randrange(90)) + " " + " ".join(held + tail) + " " + prose(k, 70))
    wanted = set()
    for d, text in enumerate(texts):
        passage = decontamination.words_of(text)
        for i, item in items:
            question, answer = decontamination.question_and_answer(item)
            asked = decontamination.overlap(question, passage, 5), decontamination.overlap(answer, passage, 2)
            if min(asked) >= 0.8:
                wanted.add((d, i))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = [(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, table).collect()]
    assert set(found) == wanted and len(found) == len(wanted) > 60


def test_gates_are_no_higher_than_any_accepted_loss():
    pick = random.Random(3)
    for _ in range(40):
        words = [pick.choice("abcdefghijklmnop") for _ in range(pick.randrange(5, 14))]
        weight = {w: pick.random() for w in sorted(set(words))}
        bound = decontamination.heaviest_missing(words, weight, 3, 0.6)
        for mask in range(1 << len(weight)):
            gone = {w for k, w in enumerate(sorted(weight)) if mask >> k & 1}
            left = [w if w not in gone else "-" for w in words]
            runs = decontamination.grams(words, 3)
            if len(runs & decontamination.grams(left, 3)) / len(runs) >= 0.6:
                assert sum(weight[w] for w in gone) <= bound + 1e-9


def test_near_passages_of_three_variants_are_linked_pairwise(spark):
    passage = words_of(1, 90)
    variants = [list(passage) for _ in range(3)]
    variants[1][20] = "other"
    variants[2][70] = "another"
    copy = list(variants[1])
    texts = [words_of(10 + k, 20) + v for k, v in enumerate(variants)] + [words_of(11, 20) + copy]
    found = {(r.doc_id, r.partner_id) for r in near_ids(spark, texts)}
    # The passage of 2 lies in one shared with 0, and is one shared with 1 all the same; 3 is a copy of 1.
    assert found == {(1, 0), (2, 0), (2, 1), (3, 1)}


def test_rows_that_share_a_key_are_made_once(spark, tmp_path):
    def made(batches):
        with (tmp_path / "made").open("a") as log:
            log.write("x")
        yield from batches

    rows = [(k % 7, k % 3 if k % 7 else 5, k) for k in range(42)] + [(0, 5, 1), (None, 1, 2), (None, 2, 3)]
    frame = spark.createDataFrame(rows, "key bigint, doc_id bigint, place int").coalesce(1)
    found = compact_windows.shared(frame.mapInArrow(made, frame.schema))
    wanted = [r for r in rows if r[0]]
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
    assert (tmp_path / "made").read_text() == "x"


def family(n, words, seed):
    """Texts of one passage, each with a word of its own."""
    base = words_of(seed, words)
    return [base[:k] + [f"own{seed}x{k}"] + base[k + 1 :] for k in range(0, 7 * n, 7)]


def test_texts_of_near_copies_travel_once_to_be_compared(spark, monkeypatch):
    texts = family(12, 150, 1) + family(9, 120, 2)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    pairs = [(a, b) for a in range(21) for b in range(a) if (a < 12) == (b < 12)]
    table = spark.createDataFrame(pairs, "doc_id bigint, partner_id bigint")
    held = compact_windows.sketched(table, frame, 46)
    for tokens, several, most in ((10**6, 10**3, 1), (300, 10**3, 10), (10**6, 4, 10)):
        monkeypatch.setattr(compact_windows, "TOKENS_IN_BLOCK", tokens)
        monkeypatch.setattr(compact_windows, "PAIRS_IN_BLOCK", several)
        placed = compact_windows.blocks(table, held).collect()
        assert sorted((r.doc_id, r.partner_id) for r in placed) == sorted(pairs)
        sent = {(r.block, r.part, d) for r in placed for d in (r.doc_id, r.partner_id)}
        assert len(sent) == 21 if most == 1 else len({s[1] for s in sent}) > 10
        assert {(r.doc_id, r.partner_id) for r in near_ids(spark, texts)} == set(pairs)


def test_pairs_without_enough_shared_tokens_are_left_out_before_their_texts_meet(spark):
    line = words_of(1, 14)
    texts = [words_of(10 + k, 100) + line + words_of(50 + k, 100) for k in range(20)] + family(5, 150, 3)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    pairs = [(a, b) for a in range(25) for b in range(a)]
    table = spark.createDataFrame(pairs, "doc_id bigint, partner_id bigint")
    kept = compact_windows.promising_pairs(table, compact_windows.sketched(table, frame, 46), 46, 0.8)
    near = {(a, b) for a in range(20, 25) for b in range(20, a)}
    found = {tuple(r) for r in kept.collect()}
    assert near <= found and len(found) <= len(near) + 5


def test_texts_of_repeated_lines_compare_few_stretches(monkeypatch):
    asked = []
    shares = compact_windows.Pair.shares

    def counted(pair, starts, begins):
        asked.append(len(starts))
        return shares(pair, starts, begins)

    monkeypatch.setattr(compact_windows.Pair, "shares", counted)
    pick = random.Random(8)
    lines = [words_of(k, 12) for k in range(6)]
    a, b = (sum((pick.choice(lines) for _ in range(n)), []) for n in (30, 150))
    passage = words_of(99, 60)
    x, y = a + passage + a, b + passage[:30] + ["new"] + passage[30:] + b
    found = compact_windows.passages(*(compact_windows.shingles(" ".join(t)) for t in (x, y)), 46, 0.8)
    assert any(i <= len(a) and len(a) + 56 <= j for i, j, _, _ in found)
    # Alignments, of which most cannot reach the similarity, are far more.
    assert sum(asked) < 10_000


def test_documents_that_share_many_keys_are_paired_once(spark, monkeypatch):
    rows = [(key, doc) for key in range(400) for doc in range(30)] + [(9000 + key, key % 7) for key in range(70)]
    rows += [(500, 3), (500, 40), (501, 40), (501, 40), (502, 41), (None, 42), (None, 43)]
    frame = spark.createDataFrame(rows, "key bigint, doc_id bigint")
    wanted = {(a, b) for a in range(30) for b in range(a)} | {(40, 3)}
    # The 400 keys have one set of documents, which is in the table of pairs once.
    assert compact_windows.alike_sets(frame).count() == 32
    for marked in (compact_windows.PAIRS_MARKED, 50):
        monkeypatch.setattr(compact_windows, "PAIRS_MARKED", marked)
        found = compact_windows.candidates(frame)
        assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
        assert "SortMergeJoin" not in found._jdf.queryExecution().toString()
    names = frame.selectExpr("key", "concat('d', lpad(doc_id, 3, '0')) AS doc_id")
    found = compact_windows.candidates(names).collect()
    assert {(int(r.doc_id[1:]), int(r.partner_id[1:])) for r in found} == wanted


def test_a_text_goes_once_to_a_block_to_be_tested_on_sketches(spark, monkeypatch):
    texts = family(12, 150, 1) + family(9, 120, 2)
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    pairs = [(a, b) for a in range(21) for b in range(a) if (a < 12) == (b < 12)]
    table = spark.createDataFrame(pairs, "doc_id bigint, partner_id bigint")
    monkeypatch.setattr(compact_windows, "PAIRS_TESTED", 5)
    held = compact_windows.sketched(table, frame, 46)
    placed = compact_windows.blocks(table, held, tested=True).collect()
    assert sorted((r.doc_id, r.partner_id) for r in placed) == sorted(pairs)
    sent = {(r.block, r.part, r.doc_id) for r in placed}
    assert len(sent) == len({(r.block, r.doc_id) for r in placed}) == 19 and len({s[:2] for s in sent}) > 8
    kept = compact_windows.promising_pairs(table, held, 46, 0.8)
    assert sorted(tuple(r) for r in kept.collect()) == sorted(pairs)


def test_texts_are_compared_with_a_partner_together_as_each_alone(monkeypatch):
    pick = random.Random(11)
    lines = [words_of(700 + k, 12) for k in range(5)]
    texts = family(14, 130, 5) + [words_of(900 + k, 30) + f for k, f in enumerate(family(6, 70, 5))]
    texts += [sum((pick.choice(lines) for _ in range(n)), []) for n in (6, 30, 80)] + [words_of(1, 20), ["a"] * 300]
    texts += [texts[0] + texts[20] + texts[3], list(texts[2])]
    tokens = [compact_windows.shingles(" ".join(t)) for t in texts]
    made = []
    start = compact_windows.Pair.__init__
    monkeypatch.setattr(compact_windows.Pair, "__init__", lambda self, *a: made.append(0) or start(self, *a))
    for at_once in (compact_windows.MATCHES_AT_ONCE, 300):
        monkeypatch.setattr(compact_windows, "MATCHES_AT_ONCE", at_once)
        several = compact_windows.Texts(tokens, 46, 0.8)
        for other in range(len(texts)):
            made.clear()
            found = dict(several.passages(list(range(len(texts))), other))
            assert len(made) <= 1 or at_once == 300
            for own in range(len(texts)):
                assert found.get(own, []) == compact_windows.passages(tokens[own], tokens[other], 46, 0.8)
