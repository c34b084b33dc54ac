"""Language of a text by a convolutional network over bytes, trained and applied in numpy.

A filter of width w has a weight for each of its places and each byte. Its largest response in a
window of fixed length, if positive, is one feature; a softmax over all features gives the
languages' probabilities. A text's probabilities are the mean over its windows, by their bytes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from strikeloom.llm.vectors import batch_of
from strikeloom.sinks.shared import stored

WIDTHS = (2, 3, 4)
FILTERS = 32
WINDOW = 256
# A window starts where no n-gram of the one before it reaches.
STRIDE = WINDOW - max(WIDTHS) + 1
# Windows whose responses are held at a time: 6 MB.
WINDOWS_AT_ONCE = 64
# Bytes of one text that are cut into windows at a time.
SEGMENT = STRIDE * 4096

# The fit's bound: at most this many distinct texts of a language, and windows of each.
TEXTS = 1000
PIECES = 4
EPOCHS = 6
BATCH = 64
RATE = 0.003
DECAY = 1e-4
DROPOUT = 0.2

UNDETERMINED = "und"


@dataclass
class Network:
    """Weights by width (place, byte, filter), biases of the filters, and the softmax."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def fresh(languages: list[str], seed: int = 0) -> "Network":
        random = np.random.default_rng(seed)
        filters = [random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for weights in filters:
            weights[:, 0] = 0.0
        features = FILTERS * len(WIDTHS)
        weights = random.normal(0, 0.1, (features, len(languages))).astype(np.float32)
        return Network(
            languages, filters, np.zeros(features, np.float32), weights, np.zeros(len(languages), np.float32)
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.weights, self.offsets]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _responses(filters: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Responses of one width (position, window, filter) at every position of the windows."""
    width = len(filters)
    places = windows.shape[1] - width + 1
    total = filters[0][windows[:, :places].T]
    for j in range(1, width):
        total += filters[j][windows[:, j : j + places].T]
    return total


def _gradients(net: Network, windows: np.ndarray, answers: np.ndarray, keep: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy, in the order of the parameters."""
    best, peaks = [], []
    for filters in net.filters:
        responses = _responses(filters, windows)
        at = responses.argmax(0)
        best.append(at)
        peaks.append(np.take_along_axis(responses, at[None], 0)[0])
    raw = np.hstack(peaks) + net.bias
    features = np.maximum(raw, 0) * keep
    error = _softmax(features @ net.weights + net.offsets)
    error[np.arange(len(answers)), answers] -= 1
    error /= len(answers)
    back = (error @ net.weights.T) * keep * (raw > 0)
    of_filters = []
    rows, columns = np.arange(len(windows))[:, None], np.arange(FILTERS)[None]
    for k, filters in enumerate(net.filters):
        gradient = np.zeros_like(filters)
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(len(filters)):
            np.add.at(gradient[j], (windows[rows, best[k] + j], columns), own)
        gradient[:, 0] = 0.0
        of_filters.append(gradient)
    return [*of_filters, back.sum(0), features.T @ error, error.sum(0)]


def fitted(pieces: list[bytes], answers: list[str], seed: int = 0) -> Network:
    """A network trained on labelled pieces, every language drawn equally often.

    Half of the pieces drawn are cut to a random length, so that short texts are learned too. The
    same pieces in the same order give the same network.
    """
    languages = sorted(set(answers))
    net = Network.fresh(languages, seed)
    if len(languages) < 2:
        return net
    random = np.random.default_rng(seed)
    windows = np.zeros((len(pieces), WINDOW), np.uint8)
    lengths = np.array([min(len(piece), WINDOW) for piece in pieces])
    for k, piece in enumerate(pieces):
        windows[k, : lengths[k]] = np.frombuffer(piece[:WINDOW], np.uint8)
    of = np.searchsorted(languages, answers)
    by_language = [np.flatnonzero(of == k) for k in range(len(languages))]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    steps = max(1, EPOCHS * len(pieces) // BATCH)
    for step in range(1, steps + 1):
        answer = random.integers(len(languages), size=BATCH)
        drawn = np.array([random.choice(by_language[a]) for a in answer])
        batch = windows[drawn].copy()
        cut = np.exp(random.uniform(np.log(6), np.log(WINDOW), BATCH)).astype(int)
        cut = np.where(random.random(BATCH) < 0.5, np.minimum(cut, lengths[drawn]), lengths[drawn])
        batch[np.arange(WINDOW) >= cut[:, None]] = 0
        keep = (random.random((BATCH, len(net.bias))) >= DROPOUT).astype(np.float32) / (1 - DROPOUT)
        rate = RATE * (1 - (step - 1) / steps)
        for p, g, m, v in zip(net.parameters(), _gradients(net, batch, answer, keep), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * p)
    return net


class Reader:
    """A network with its responses to pairs of bytes tabulated, for many windows."""

    def __init__(self, net: Network):
        self.net = net
        two, three, four = net.filters

        def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None] + b[None]).reshape(-1, FILTERS)

        self.heads = np.hstack([pairs(two[0], two[1]), pairs(three[0], three[1]), pairs(four[0], four[1])])
        self.third, self.tail = three[2], pairs(four[2], four[3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for start in range(0, len(windows), WINDOWS_AT_ONCE):
            rows = np.ascontiguousarray(windows[start : start + WINDOWS_AT_ONCE].T)
            pair = (rows[:-1].astype(np.int32) << 8) | rows[1:]
            total = self.heads[pair]
            peak2 = total[:, :, :FILTERS].max(0)
            three = total[:-1, :, FILTERS : 2 * FILTERS]
            three += self.third[rows[2:]]
            four = total[:-2, :, 2 * FILTERS :]
            four += self.tail[pair[2:]]
            raw = np.hstack([peak2, three.max(0), four.max(0)]) + self.net.bias
            out.append(_softmax(np.maximum(raw, 0) @ self.net.weights + self.net.offsets))
        return np.vstack(out)


def normalised(text: str) -> bytes:
    """Bytes that the network reads: UTF-8 of the lower-cased text, zero bytes as blanks."""
    return text.lower().encode("utf-8", "replace").replace(b"\0", b" ")


def windows_of(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows of a text, a bounded number at a time, and how many bytes each adds."""
    overlap = WINDOW - STRIDE
    for start in range(0, max(1, len(data) - overlap), SEGMENT):
        part = data[start : start + SEGMENT + overlap]
        n = max(1, -(-(len(part) - overlap) // STRIDE))
        held = np.zeros(n * STRIDE + overlap, np.uint8)
        held[: len(part)] = np.frombuffer(part, np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(held, WINDOW)[::STRIDE]
        added = np.minimum(STRIDE, len(part) - STRIDE * np.arange(n)).astype(np.float64)
        yield windows, added


def _judged(net: Network, schema: pa.Schema):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net)
        for batch in batches:
            texts = batch["text"].to_pylist()
            sums = np.zeros((len(texts), len(net.languages)))
            held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            waiting = 0

            def flush() -> None:
                if held:
                    windows, added, rows = (np.concatenate(part) for part in zip(*held))
                    np.add.at(sums, rows, reader.probabilities(windows) * added[:, None])
                    held.clear()

            for k, (text, known) in enumerate(zip(texts, batch["letters"].to_pylist())):
                if not known or not net.languages:
                    continue
                for windows, added in windows_of(normalised(text)):
                    held.append((windows, added, np.full(len(windows), k)))
                    waiting += len(windows)
                    if waiting >= 16 * WINDOWS_AT_ONCE:
                        flush()
                        waiting = 0
            flush()
            total = sums.sum(1)
            known = total > 0
            best = sums.argmax(1) if net.languages else np.zeros(len(texts), int)
            score = np.where(known, sums.max(1, initial=0.0) / np.where(known, total, 1.0), 0.0)
            named = [net.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            columns = {name: batch[name] for name in schema.names if name in batch.schema.names}
            yield batch_of({**columns, "lang_pred": named, "score": np.minimum(score, 1.0)}, schema)

    return judged


def _samples(labelled: DataFrame, texts: int, pieces: int) -> list[tuple[str, bytes]]:
    """Pieces of at most about ``texts`` distinct texts of each language, chosen by hash.

    Hashes alone are counted and ranked; only the chosen texts' pieces are gathered. A language's
    hashes are thinned to its share before they are ranked, so none meet in one task.
    """
    known = labelled.where("lang IS NOT NULL AND letters").withColumn("h", F.xxhash64("text"))
    hashes = stored(known.select("lang", "h").distinct())
    sizes = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    unit = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / float(1 << 30)
    thinned = hashes.join(sizes, "lang").where(unit <= 1.5 * texts / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))
    chosen = thinned.withColumn("rank", rank).where(F.col("rank") <= texts).select("lang", "h")
    span = F.greatest(F.lit(1), F.length("text") - WINDOW + 1)
    starts = [F.lit(1) + F.pmod(F.xxhash64("h", F.lit(k)), span).cast("int") for k in range(pieces)]
    cut = F.array_distinct(F.array(*[F.substring("text", start, F.lit(WINDOW)) for start in starts]))
    # Copies give the same pieces, so which of them is taken makes no difference.
    rows = known.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.first(cut).alias("pieces"))
    gathered = rows.select("lang", "h", F.explode("pieces").alias("piece")).collect()
    return [(row.lang, normalised(row.piece)) for row in sorted(gathered)]


def predicted(
    docs: DataFrame,
    held_out: Column | None = None,
    texts: int = TEXTS,
    pieces: int = PIECES,
    seed: int = 0,
) -> DataFrame:
    """Language of every document, one row per input row, learned from the labelled ones.

    ``docs`` has doc_id, text and lang; ``held_out`` marks documents that must not be learned
    from, by default those whose CRC-32 of the id in decimal leaves 1 when divided by 3. The fit
    takes up to ``pieces`` windows of at most ``texts`` distinct texts of each language, chosen by
    a hash of the text; the network passes to the tasks as weights of a few hundred kilobytes.
    Prediction reads whole texts, window by window, without any shuffle: lang, source and doc_id
    play no part in it.

    Returns doc_id, held_out, lang_pred and score, the mean probability of the answer from 0 to 1.
    A text that is NULL, empty or without a letter is ``und`` with score 0, as is every text where
    nothing can be learned; with one language learned, all others are that one with score 1. A NULL
    id is neither held out nor learned from, a NULL language teaches nothing. Of two languages
    equally likely the first by name is taken. Very long texts are read in bounded segments.
    Repeated rows get a row each. An empty table gives an empty result; other columns are ignored.
    """
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", "lang", held_out.alias("held_out"), letters.alias("letters"))
    learned = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    samples = _samples(learned, texts, pieces)
    net = fitted([piece for _, piece in samples], [lang for lang, _ in samples], seed)

    asked = rows.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text", "letters")
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema(
        [
            ("doc_id", to_arrow_type(kind)),
            ("held_out", pa.bool_()),
            ("lang_pred", pa.string()),
            ("score", pa.float64()),
        ]
    )
    return asked.mapInArrow(
        _judged(net, schema),
        f"doc_id {kind.simpleString()}, held_out boolean, lang_pred string, score double",
    )
