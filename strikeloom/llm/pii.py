"""Personal data: exact patterns, and further spans from weak labelers whose votes are reconciled."""

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number", "contact")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, number of the kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Walks from one @ to the next, so that long runs of name characters stay linear."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", last if domain else at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts each from every dotted chain of numbers, from its left."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts = list(_DIGITS.finditer(text, chain.start(), chain.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(n := p.group().lstrip("0")) <= 3 and int(n or 0) <= 255 for p in four):
                yield four[0].start(), four[3].end()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns in code points, by start and kind; failing matches are dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [(i, 0, j) for i, j in _emails(text)]
    if _DIGIT.search(text):
        found += [(i, 1, j) for i, j in _addresses(text)]
        for match in _CARD.finditer(text):
            digits = _digits(match.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 9 <= len(_digits(match.group())) <= 15:
                    found.append((match.start(), 3, match.end()))
    return sorted(found)


# --- candidates, labelers and features -------------------------------------------------------

_MARK = re.compile(r"[0-9@]")
_INSIDE = re.compile(r"[^\s\"'<>()\[\]{}|,;:=]+")
_WORD = re.compile(r"[^\W\d_]+")
# What gazetteers and context labelers look for.
TOP_LEVEL = frozenset("com net org edu gov int mil info io de fr es uk us eu ch at it nl".split())
KEY_WORDS = frozenset("token key secret password passwd pwd apikey auth bearer credential".split())
CONTACT_WORDS = frozenset(
    "phone tel telephone call fax mobile card account iban ssn email mail contact passport".split()
)
PLAIN_WORDS = frozenset(
    "version license licence licensed copyright chapter page section figure table cc".split()
)
CONTEXT_CHARS = 40


class Candidate:
    """A token with a digit or an @, and what is known about it."""

    def __init__(self, text: str, start: int, end: int):
        self.start, self.end = start, end
        self.token = text[start:end]
        before = text[max(0, start - CONTEXT_CHARS) : start].lower()
        self.context = _WORD.findall(before)[-3:]
        self.digits = sum(c.isdigit() for c in self.token)
        self.hex = all(c in "0123456789abcdefABCDEF" for c in self.token)
        self.key = any(w in KEY_WORDS for w in self.context)
        self.contact = any(w in CONTACT_WORDS for w in self.context)
        self.plain = any(w in PLAIN_WORDS for w in self.context)

    def votes(self) -> list[int]:
        """One vote of each labeler: 1 personal, -1 not, 0 abstains."""
        token, n = self.token, len(self.token)
        tail = token.rpartition(".")[2].lower()
        numeric = self.digits + sum(c in ".-+" for c in token) == n
        return [
            1 if self.hex and n >= 32 else 0,  # regex: long hexadecimal
            1 if "@" in token[1:-1] and "." in token else 0,  # regex: loose address
            1 if numeric and self.digits >= 9 else 0,  # regex: long number
            -1 if numeric and self.digits <= 6 else 0,  # regex: short number
            -1 if "/" in token or token.startswith("www.") else 0,  # regex: link or path
            -1 if n < 6 else 0,  # regex: too short to identify anyone
            (1 if tail in TOP_LEVEL else -1) if "@" in token else 0,  # gazetteer: domains
            1 if token[:1] in "3456" and numeric and 13 <= self.digits <= 16 else 0,  # gazetteer
            1 if self.key else 0,  # context
            1 if self.contact else 0,  # context
            -1 if self.plain else 0,  # context
        ]

    def features(self) -> list[int]:
        """Binary features of the span classifier, by place."""
        n = len(self.token)
        share = self.digits / n
        return [
            n < 6,
            6 <= n < 12,
            12 <= n < 24,
            n >= 24,
            share < 0.3,
            0.3 <= share < 0.9,
            share >= 0.9,
            self.hex,
            "@" in self.token,
            "." in self.token,
            "-" in self.token,
            "/" in self.token,
            self.digits >= 9,
            self.key,
            self.contact,
            self.plain,
        ]

    def kind(self) -> int:
        name = "contact" if "@" in self.token else "secret" if self.key or (
            self.hex and len(self.token) >= 32
        ) else "number"
        return KINDS.index(name)


N_LABELERS, N_FEATURES = 11, 16


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Unbroken runs with a digit or an @, widened from the first one: linear, however long a run is."""
    end = 0
    while mark := _MARK.search(text, end):
        start = mark.start()
        while start > end and _INSIDE.match(text[start - 1]):
            start -= 1
        end = _INSIDE.match(text, mark.start()).end()
        yield start, end


def candidates(text: str, taken: list[Span]) -> Iterator[Candidate]:
    """Tokens that no base span touches, without full stops at their ends."""
    k = 0
    for start, end in _tokens(text):
        while end > start and text[end - 1] in ".!?%*$&#":
            end -= 1
        while k < len(taken) and taken[k][2] <= start:
            k += 1
        # Spans come by their starts; an earlier one that lasts longer hides no later one.
        touching = (e > start for s, _, e in takewhile(lambda span: span[0] < end, islice(taken, k, None)))
        if end > start and not any(touching):
            yield Candidate(text, start, end)


def _code(values: list[int], base: int) -> int:
    code = 0
    for value in values:
        code = code * base + int(value)
    return code


def _decode(codes: np.ndarray, n: int, base: int) -> np.ndarray:
    places = base ** np.arange(n - 1, -1, -1)
    return codes[:, None] // places[None, :] % base


def vote_counts(docs: DataFrame) -> DataFrame:
    """How often each pattern of votes meets each vector of features, over all documents.

    Both come from fixed sets, so the result has a bounded number of rows at any input size.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"]:
                text = text.as_py() or ""
                for c in candidates(text, base_spans(text)):
                    seen[_code([v + 1 for v in c.votes()], 3), _code(c.features(), 2)] += 1
            if seen:
                votes, features = zip(*seen)
                columns = {"votes": votes, "features": features, "n": list(seen.values())}
                yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in columns.items()})

    rows = docs.select("text").mapInArrow(counted, "votes bigint, features bigint, n bigint")
    return rows.groupBy("votes", "features").agg(F.sum("n").alias("n"))


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = 100):
    """Expectation-maximisation over vote patterns (values 0, 1, 2: against, abstains, for).

    Returns each pattern's probability of being personal data, the prior, and per class and
    labeler the probability of each vote. Starts from the majority vote.
    """
    total = (votes - 1).sum(axis=1)
    posterior = 1 / (1 + np.exp(-1.5 * total))
    for _ in range(rounds):
        weight = np.stack([n * (1 - posterior), n * posterior])
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        table = np.stack(
            [[(weight[c][:, None] * (votes == v)).sum(axis=0) + 0.1 for v in range(3)] for c in (0, 1)]
        )
        table /= table.sum(axis=1, keepdims=True)
        picked = np.take_along_axis(table.transpose(0, 2, 1)[:, None], votes[None, :, :, None], 3)
        score = np.log(prior)[:, None] + np.log(picked[..., 0]).sum(axis=2)
        updated = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(updated - posterior).max() < 1e-9:
            break
        posterior = updated
    return posterior, prior[1], table


def classifier(features: np.ndarray, labels: np.ndarray, n: np.ndarray, rounds: int = 25):
    """Weights (last: intercept) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))]).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - labels)) + w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def trained(docs: DataFrame) -> np.ndarray | None:
    """The span classifier of a corpus; None where it has no candidates."""
    rows = vote_counts(docs).orderBy("votes", "features").toPandas()
    if rows.empty:
        return None
    n = rows["n"].to_numpy(float)
    votes = _decode(rows["votes"].to_numpy(), N_LABELERS, 3)
    features = _decode(rows["features"].to_numpy(), N_FEATURES, 2)
    labels, _, _ = reliabilities(votes, n)
    return classifier(features, labels, n)


def all_spans(text: str, weights: np.ndarray | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base ones stay, accepted candidates are added."""
    base = base_spans(text)
    if weights is None:
        return base, base
    added = [
        (c.start, c.kind(), c.end)
        for c in candidates(text, base)
        if float(np.dot(c.features(), weights[:-1]) + weights[-1]) > 0
    ]
    return base, sorted(base + added)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text, one row per input row.

    The base patterns are matched leftmost and without overlap per kind. Labelers (patterns, word
    lists, context) vote on the other tokens with digits or an @; expectation-maximisation over
    the counts of vote patterns in the whole corpus estimates how reliable each labeler is, and a
    classifier trained on the resulting labels decides which tokens are added.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_spans, spans: kind:start:end
    in code points, end exclusive, comma-joined. NULL and empty texts have no spans. NULL ids and
    repeated rows get their rows; an empty table gives an empty result; other columns are ignored.
    """
    weights = trained(docs)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [all_spans(text.as_py() or "", weights) for text in batch["text"]]
            columns = {"doc_id": batch["doc_id"]}
            for kind, name in enumerate(BASE_KINDS):
                counts = [sum(s[1] == kind for s in base) for base, _ in pairs]
                columns[f"n_{name}"] = pa.array(counts, pa.int64())
            columns["base_spans"] = pa.array([_written(base) for base, _ in pairs], pa.string())
            columns["spans"] = pa.array([_written(spans) for _, spans in pairs], pa.string())
            yield pa.record_batch(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{name} bigint" for name in BASE_KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        found, f"doc_id {kind}, {counts}, base_spans string, spans string"
    )


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()


def masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps are merged."""
    out, last = [], 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= last:
            out += [text[last : int(start)], f"<{kind}>"]
        last = max(last, int(end))
    return "".join([*out, text[last:]])
