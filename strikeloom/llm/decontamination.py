"""Benchmark decontamination: every passage queries a BM25 index of the test items."""

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikeloom.llm.identity import row_identity, without_rows

K1, B = 1.2, 0.75
SHINGLE, PAIR, MIN_OVERLAP = 5, 2, 0.8
BLOCK_ITEMS = 16
ITEMS_PER_SHARD = 20_000
HALF_WORDS = 64
WORDS_AT_ONCE = 500_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and in an item's last line, or last sentence where it has one line."""
    text = text.strip()
    head, _, tail = text.rpartition("\n")
    if not words_of(head) or not words_of(tail):
        parts = _SENTENCE.split(text)
        head, tail = " ".join(parts[:-1]), parts[-1]
    question, answer = words_of(head), words_of(tail)
    return (question, answer) if question and answer else (words_of(text), words_of(text))


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    """Runs of ``n`` words; the whole sequence where it is shorter."""
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def overlap(part: list[str], passage: list[str], n: int) -> float:
    wanted = grams(part, n)
    return len(wanted & grams(passage, min(n, len(part)))) / len(wanted) if wanted else 0.0


def heaviest_missing(words: list[str], weight: dict[str, float], n: int, verify: float) -> float:
    """The most weight of distinct words that a passage may lack and still hold ``verify`` of the runs.

    A lacking word takes every run that covers one of its places. Counted at its first place only,
    that is a choice of places of the most weight whose runs together are no more than may be
    missing: a dynamic programme over places, by runs taken so far.
    """
    n = min(n, len(words))
    runs = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    often = sorted(Counter(runs).values(), reverse=True)
    # Runs that occur twice are missing twice.
    room = sum(often[: int(len(often) * (1 - verify) + 1e-9)])
    seen: set[str] = set()
    # best[k]: most weight of places so far with k runs taken; by the last place taken.
    ended: list[tuple[int, np.ndarray]] = []
    whole = np.zeros(room + 1)
    for place, word in enumerate(words):
        value = 0.0 if word in seen else weight.get(word, 0.0)
        seen.add(word)
        if not value:
            continue
        first, last = max(0, place - n + 1), min(place, len(runs) - 1)
        best = np.full(room + 1, -np.inf)
        for before, row in [(-n, np.where(np.arange(room + 1) == 0, 0.0, -np.inf)), *ended]:
            cost = max(0, last - max(first, before + 1) + 1)
            if cost <= room:
                np.maximum(best[cost:], row[: room + 1 - cost] + value, out=best[cost:])
        near = [(b, row) for b, row in ended if b > place - n]
        # What ended further back no longer shares runs: only its best is kept.
        far = [row for b, row in ended if b <= place - n]
        if far:
            near.insert(0, (place - n, np.maximum.reduce(far)))
        ended = [*near, (place, best)]
        whole = np.maximum(whole, best)
    return float(whole.max(initial=0.0))


def gate(text: str, weight: dict[str, float], verify: float) -> float:
    """The least share of its score with which an item can pass verification.

    A passage that holds ``verify`` of the question's and of the answer's runs lacks at most the
    heaviest words that leave as many; a word of both counts to the question. It has at least one
    word of the item, so items of few words need their lightest.
    """
    question, answer = question_and_answer(text)
    lost = heaviest_missing(question, weight, SHINGLE, verify)
    if answer != question:
        asked = set(question)
        rest = {word: w for word, w in weight.items() if word not in asked}
        lost += heaviest_missing(answer, rest, PAIR, verify)
    return max(sum(weight.values()) - lost, min(weight.values())) * (1 - 1e-9)


def postings(items: DataFrame) -> DataFrame:
    """Rows (item_id, word, share): what each word adds to an item, as part of its highest score.

    Document frequencies and mean length are those of the whole benchmark. Items that repeat are
    weighed each; items without words have no postings.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words_of(text) for text in batch["text"].to_pylist()]
            yield pa.record_batch(
                {"item_id": batch["item_id"], "words": pa.array(found, pa.list_(pa.string()))}
            )

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, words array<string>")
    sized = rows.where(F.size("words") > 0).select("item_id", "words", F.size("words").alias("size"))
    whole = sized.agg(F.count(F.lit(1)).alias("items"), F.avg("size").alias("mean_size"))
    terms = sized.select("item_id", "size", F.explode("words").alias("word"))
    counts = terms.groupBy("item_id", "size", "word").agg(F.count(F.lit(1)).alias("tf"))
    frequencies = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    row = whole.first()
    n, mean = row["items"], row["mean_size"] or 1.0
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    damp = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / mean))
    scored = counts.join(frequencies, "word").select("item_id", "word", (idf * damp).alias("score"))
    totals = scored.groupBy("item_id").agg(F.sum("score").alias("total"))
    return scored.join(totals, "item_id").select(
        "item_id", "word", (F.col("score") / F.col("total")).alias("share")
    )


class Index:
    """Inverted index of one shard: postings by term, in blocks of items of similar length."""

    def __init__(self, rows: pd.DataFrame, texts: dict, verify: float):
        sizes = {item: len(words_of(text)) for item, text in texts.items()}
        self.items = sorted(sizes, key=lambda item: (sizes[item], str(item)))
        self.parts = [question_and_answer(texts[item]) for item in self.items]
        self.half = max([HALF_WORDS, *sizes.values()])
        place = {item: k for k, item in enumerate(self.items)}
        names = sorted(set(rows["word"]))
        self.vocabulary = {word: k for k, word in enumerate(names)}
        term = rows["word"].map(self.vocabulary).to_numpy(np.int64)
        item = rows["item_id"].map(place).to_numpy(np.int64)
        share = rows["share"].to_numpy(float)
        weights: list[dict[str, float]] = [{} for _ in self.items]
        for k, word, value in zip(item.tolist(), rows["word"], share.tolist()):
            weights[k][word] = value
        # An item is retrieved from a share of its own on: retrieval compares multiples of it with 1.
        gates = [gate(texts[i], w, verify) if w else 1.0 for i, w in zip(self.items, weights)]
        self.gate = np.array(gates)
        share = share / self.gate[item]
        order = np.lexsort((item, term))
        self.term, self.item, self.share = term[order], item[order], share[order]
        self.start = np.searchsorted(self.term, np.arange(len(names) + 1))
        # Block maxima: for each term and block the largest share.
        cell = self.term * (len(self.items) // BLOCK_ITEMS + 1) + self.item // BLOCK_ITEMS
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))[: len(cell)]
        self.block = self.item[first] // BLOCK_ITEMS
        self.block_max = np.maximum.reduceat(self.share, first) if len(first) else self.share
        self.block_start = np.searchsorted(self.term[first], np.arange(len(names) + 1))
        self.term_max = np.zeros(len(names))
        np.maximum.at(self.term_max, self.term, self.share)

    def retrieve(self, passage: np.ndarray, term: np.ndarray, least: float):
        """(passages, items, shares) of at least ``least``, for distinct (passage, term) rows.

        Three bounds in turn: the sum of term maxima per passage, of block maxima per passage and
        block, and last the scores themselves. What a bound rules out is not looked at again.
        """
        n = int(passage.max()) + 1 if len(passage) else 0
        bound = np.bincount(passage, self.term_max[term], n)
        alive = bound[passage] >= least
        passage, term = passage[alive], term[alive]
        p, at = _expanded(passage, self.block_start[term], self.block_start[term + 1])
        blocks = len(self.items) // BLOCK_ITEMS + 1
        pair, total, _ = _summed(p * blocks + self.block[at], self.block_max[at])
        open_pairs = pair[total >= least]
        alive = np.isin(passage, np.unique(open_pairs // blocks))
        p, at = _expanded(passage[alive], self.start[term[alive]], self.start[term[alive] + 1])
        inside = np.isin(p * blocks + self.item[at] // BLOCK_ITEMS, open_pairs)
        p, at = p[inside], at[inside]
        pair, total, _ = _summed(p * len(self.items) + self.item[at], self.share[at])
        hit = total >= least
        return pair[hit] // len(self.items), pair[hit] % len(self.items), total[hit]


def _expanded(rows: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Each row repeated for every posting from its start to its stop, with the posting's place."""
    n = stop - start
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(n) else 0) + np.repeat(start - (ends - n), n)
    return np.repeat(rows, n), at


def _summed(keys: np.ndarray, values: np.ndarray):
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, values, len(distinct)), inverse


def _matches(index: Index, texts: list[str | None], verify: float):
    """(row, item, share, question overlap, answer overlap) of every verified match of some texts."""
    lookup, half, least = index.vocabulary.get, index.half, 1.0
    words, block_of, term_of, first_block = [], [], [], [0]
    for text in texts:
        cut = words_of(text)
        ids = np.fromiter(map(lookup, cut, repeat(-1)), np.int64, len(cut))
        known = np.flatnonzero(ids >= 0)
        words.append(cut)
        block_of.append(first_block[-1] + known // half)
        term_of.append(ids[known])
        first_block.append(first_block[-1] + max(1, -(-len(cut) // half)))
    terms = max(1, len(index.vocabulary))
    # A passage is a block of words and the next one, so that each item lies whole in one.
    starts = np.array(first_block)
    pair = np.unique(np.concatenate(block_of) * terms + np.concatenate(term_of))
    block, term = pair // terms, pair % terms
    follows = ~np.isin(block, starts)
    ceiling = np.bincount(block, index.term_max[term], starts[-1] + 1)
    passage = np.concatenate((block, block[follows] - 1))
    term = np.concatenate((term, term[follows]))
    ends = np.zeros(starts[-1] + 1, bool)
    ends[starts[1:] - 1] = True
    most = ceiling + np.where(ends, 0, np.append(ceiling[1:], 0))
    open_ = most[passage] >= least
    pair = np.unique(passage[open_] * terms + term[open_])
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for p, item, share in zip(*index.retrieve(pair // terms, pair % terms, least)):
        row = int(np.searchsorted(starts, p, "right")) - 1
        at = int(p - starts[row]) * half
        passage_words = words[row][at : at + 2 * half]
        question, answer = index.parts[item]
        found = overlap(question, passage_words, SHINGLE)
        if found < verify:
            continue
        tail = overlap(answer, passage_words, PAIR)
        if tail >= verify:
            key = (row, int(item))
            share = float(share * index.gate[item])
            best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (share, found, tail))
    # Of texts of one id the best match.
    ids: dict[tuple, tuple] = {}
    for (row, item), value in best.items():
        name = (row, index.ids[item])
        ids[name] = max(ids.get(name, (item, 0.0, 0.0, 0.0)), (item, *value), key=lambda x: (x[1:], -x[0]))
    return [(row, item, *values) for (row, _), (item, *values) in ids.items()]


def contaminated(docs: DataFrame, items: DataFrame, verify: float = MIN_OVERLAP) -> DataFrame:
    """Which documents hold which test items.

    Every text is cut into passages of two blocks, each at least as long as the longest item, and
    each passage is a query against an inverted index of the items. Items are retrieved from that
    share of their highest BM25 score on that verification implies, each its own, and verified: the
    passage must hold ``verify`` of the five-word shingles of the item's question and of the word
    pairs of its answer. So retrieval loses nothing that would be verified.

    The index is handed out in shards of at most ITEMS_PER_SHARD items; one pass over the texts
    per shard, and no shuffle of texts.

    Returns doc_id, item_id, score_share, question_overlap, answer_overlap, once per input row and
    item. NULL and empty texts match nothing, and neither do items without words or id. Different
    texts of one item id are all searched, and the best match is given. NULL ids and repeated rows of
    documents are answered like others. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    # A text's name within the index: its id and the text itself.
    unique = rows.distinct().select(
        F.concat_ws(" ", F.xxhash64("item_id", "text"), F.sha2("text", 256)).alias("name"), "item_id", "text"
    )
    weights = postings(unique.select(F.col("name").alias("item_id"), "text"))
    shards = max(1, -(-unique.count() // ITEMS_PER_SHARD))
    kinds = [docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()]
    schema = (
        f"doc_id {kinds[0]}, item_id {kinds[1]}, "
        "score_share double, question_overlap double, answer_overlap double"
    )
    found = []
    for shard in range(shards):
        # Texts of one id share a shard, so that their best match is known there.
        mine = F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard
        own = unique.where(mine)
        listed = own.collect()
        texts, ids = {r.name: r.text for r in listed}, {r.name: r.item_id for r in listed}
        scored = weights.join(own.select(F.col("name").alias("item_id")), "item_id", "left_semi")
        index = Index(scored.toPandas(), texts, verify)
        index.ids = [ids[name] for name in index.items]
        handed = spark.sparkContext.broadcast(index)
        found.append(docs.select("doc_id", "text").mapInArrow(_searching(handed, verify), schema))
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def _searching(index, verify: float):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = pa.array(index.value.ids)
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"].to_pylist()
            for first, last in _portions(texts):
                rows = _matches(index.value, texts[first:last], verify)
                if not rows:
                    continue
                row, item, *values = zip(*rows)
                columns = [ids.take(pa.array([first + r for r in row])), items.take(pa.array(item))]
                columns += [pa.array(v, pa.float64()) for v in values]
                names = ["doc_id", "item_id", "score_share", "question_overlap", "answer_overlap"]
                yield pa.record_batch(columns, names=names)

    return searched


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of whole texts with a bounded number of characters, or one longer text."""
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text or "") > 6 * WORDS_AT_ONCE:
            yield first, k
            first, size = k, 0
        size += len(text or "")
    if first < len(texts):
        yield first, len(texts)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a test item, rows with a NULL id among them."""
    rows = docs.select(row_identity().alias("doc_id"), "text")
    return without_rows(docs, contaminated(rows, items).select(F.col("doc_id").alias("row")))
