"""Quality by perplexity: an interpolated modified Kneser-Ney model of characters.

N-grams are four code points packed into one long, so counts, contexts and back-offs are joins and
aggregates on integers. Code points beyond the basic plane count as one character.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strikeloom.llm.identity import fresh_name
from strikeloom.sinks.shared import stored

ORDER = 4
BITS = 16
START = "\x02"
# Scored n-grams that one task holds at a time: 24 MB.
SHARD_ROWS = 2_000_000
# Characters whose n-grams a task holds in memory at a time.
CHARS_AT_ONCE = 1_000_000
# Trusted documents of a language outside these quantiles set the limits for all.
LOW, HIGH = 0.001, 0.995
# Languages with fewer trusted documents have no limits: nothing in them is rejected for its score.
LEAST_TRUSTED = 20
# With fewer than this many, the extremes seen are no quantiles yet and are widened.
MANY_TRUSTED = 200
# Texts are dealt to two halves by their hash; a model learns from one and scores the other.
HALF = "\x1f"


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 4-grams of the texts in one array, which of them are real, and where each text starts."""
    pad = START * (ORDER - 1)
    joined = pad + pad.join(texts) + pad if texts else pad
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.minimum(points, 0xFFFF).astype(np.uint64)
    keys = c[3:] | c[2:-1] << 16 | c[1:-2] << 32 | c[:-3] << 48
    lengths = np.array([len(text) for text in texts], np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - (lengths + ORDER - 1)
    real = np.ones(len(keys), bool)
    for k in range(ORDER - 1):
        real[(starts + lengths + k)[starts + lengths + k < len(keys)]] = False
    return keys, real, starts


def _portions(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of texts that are handled together: a bounded number of characters, or one text."""
    rows: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        if rows and size + len(text) > CHARS_AT_ONCE:
            yield rows
            rows, size = [], 0
        rows.append(k)
        size += len(text)
    if rows:
        yield rows


def half_of(text: str) -> int:
    """Which half a text belongs to: the same for copies."""
    return crc32(text.encode("utf-8", "replace")) & 1


def model_of(lang: str, half: int) -> str:
    """The name of the model that scores a half of a language, learned from the other one."""
    return f"{lang}{HALF}{half}"


def ngram_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, key, n): every 4-gram of the corpus and how often trusted documents have it.

    ``docs`` has lang, text and trusted. A language has two models: each is asked for the texts of
    one half and counts the trusted ones of the other, so that no text is scored by a model that
    has seen it. Each task counts before the shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[str, bool], list[str]] = {}
            for lang, text, trusted in zip(*(batch[n].to_pylist() for n in ("lang", "text", "trusted"))):
                lang, text = lang or "", text or ""
                half = half_of(text)
                groups.setdefault((model_of(lang, half), False), []).append(text)
                if trusted:
                    groups.setdefault((model_of(lang, 1 - half), True), []).append(text)
            portions = [
                (lang, trusted, [texts[i] for i in rows])
                for (lang, trusted), texts in groups.items()
                for rows in _portions(texts)
            ]
            for lang, trusted, texts in portions:
                keys, real, _ = packed(texts)
                found = pa.array(keys[real].view(np.int64)).value_counts()
                distinct, n = found.field("values"), found.field("counts")
                if not trusted:
                    n = pa.array(np.zeros(len(n), np.int64))
                langs = pa.array([lang]).take(pa.array(np.zeros(len(n), np.int64)))
                yield pa.record_batch({"lang": langs, "key": distinct, "n": n})

    rows = docs.select("lang", "text", "trusted").mapInArrow(
        counted, "lang string, key bigint, n bigint"
    )
    return rows.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _suffix(key: str, order: int) -> Column:
    """An n-gram without its first character."""
    return F.col(key).bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))


def _context(key: str) -> Column:
    """An n-gram without its last character."""
    return F.shiftrightunsigned(key, BITS)


def _discounts(counts: DataFrame) -> DataFrame:
    """The three discounts of each model from its counts of counts; 0.5, 1, 1.5 where undefined.

    They are undefined where no n-gram was seen exactly once, twice or three times.
    """
    n = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    of = counts.groupBy("lang").agg(*n)
    y = F.expr("try_divide(n1, n1 + 2D * n2)")
    found = [F.lit(k) - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
    fit = [
        F.when(F.expr("n1 > 0 AND n2 > 0 AND n3 > 0") & (d > 0) & (d < k), d).otherwise(k / 2)
        for k, d in enumerate(found, 1)
    ]
    return of.select("lang", *[d.alias(f"d{k}") for k, d in enumerate(fit, 1)])


def _order(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discounted counts (lang, key, kept) and contexts (lang, context, total, spare) of one order."""
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(
        F.col("d3")
    )
    rows = counts.join(F.broadcast(_discounts(counts)), "lang").select(
        "lang", "key", "n", discount.alias("d")
    )
    contexts = rows.groupBy("lang", _context("key").alias("context")).agg(
        F.sum("n").alias("total"), F.sum("d").alias("spare")
    )
    return rows.select("lang", "key", (F.col("n") - F.col("d")).alias("kept")), contexts


def log_probabilities(grams: DataFrame) -> DataFrame:
    """Rows (lang, key, bits): minus the binary logarithm of each 4-gram's last character's probability.

    The highest order uses counts, lower ones the number of distinct characters seen before an
    n-gram. Each n-gram of the corpus is looked up once per order by joins sharded on n-gram and
    context, however many documents hold it. A language without trusted text has no rows.
    """
    counts = {ORDER: grams.where("n > 0")}
    for order in range(ORDER - 1, 0, -1):
        longer = counts[order + 1]
        counts[order] = stored(
            longer.groupBy("lang", _suffix("key", order + 1).alias("key")).agg(
                F.count(F.lit(1)).alias("n")
            )
        )
    asked = {ORDER: grams.select("lang", "key")}
    for order in range(ORDER - 1, 0, -1):
        asked[order] = stored(
            asked[order + 1].select("lang", _suffix("key", order + 1).alias("key")).distinct()
        )

    letters = counts[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("letters"))
    lower = asked[1].join(F.broadcast(letters), "lang").select(
        "lang", "key", (1 / F.col("letters")).alias("p")
    )
    lower = _interpolated(asked[1], counts[1], lower, 1)
    for order in range(2, ORDER + 1):
        lower = _interpolated(asked[order], counts[order], stored(lower), order)
    return lower.select("lang", "key", (-F.log2("p")).alias("bits"))


def _interpolated(asked: DataFrame, counts: DataFrame, lower: DataFrame, order: int) -> DataFrame:
    kept, contexts = _order(counts)
    rows = asked.withColumns({"context": _context("key"), "suffix": _suffix("key", order)})
    if order == 1:
        rows = rows.withColumn("suffix", F.col("key"))
    below = lower.withColumnRenamed("key", "suffix")
    joined = rows.join(kept, ["lang", "key"], "left").join(contexts, ["lang", "context"], "left")
    joined = joined.join(below, ["lang", "suffix"])
    seen = F.coalesce("kept", F.lit(0.0)) / F.col("total") + F.col("spare") / F.col("total") * F.col("p")
    return joined.select("lang", "key", F.when(F.col("total") > 0, seen).otherwise(F.col("p")).alias("p"))


class Lookup:
    """Values of packed n-grams: a slot table for most of them, a sorted search for what collides."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.shift = np.uint64(64 - max(4, int(4 * max(1, len(keys))).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.float32)
        at = self.slots[self._slot(keys)]
        out = self.values[at]
        missed = np.flatnonzero(self.keys[at] != keys)
        if len(missed):
            sought = keys[missed]
            at = np.minimum(np.searchsorted(self.keys, sought), len(self.keys) - 1)
            out[missed] = np.where(self.keys[at] == sought, self.values[at], np.float32(0))
        return out


def with_bits(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``docs`` (doc_id, lang, text) with ``total``, the summed bits of their characters.

    The table is handed out in hash shards of a bounded size; a document collects what each shard
    knows in a pass of its own, without any shuffle of texts. Distinct 4-grams of an alphabet level
    off early, so that there is one shard for most corpora and few for any.
    """
    spark = docs.sparkSession
    table = stored(table)
    shards = max(1, -(-table.count() // SHARD_ROWS))
    rows = docs.select("doc_id", "lang", "text", F.lit(0.0).alias("total"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    for shard in range(shards):
        part = table
        if shards > 1:
            part = table.where(F.pmod(F.xxhash64("lang", "key"), F.lit(shards)) == shard)
        model = spark.sparkContext.broadcast(_by_language(part.select("lang", "key", "bits").toArrow()))
        rows = rows.mapInArrow(_adding(model), f"doc_id {kind}, lang string, text string, total double")
        if shard < shards - 1:
            rows = stored(rows)
    return rows


def _by_language(held: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """N-grams and bits of one shard by language, without a Python object per row."""
    langs = held["lang"].combine_chunks().dictionary_encode()
    which = langs.indices.to_numpy()
    keys = held["key"].to_numpy().view(np.uint64)
    bits = held["bits"].to_numpy().astype(np.float32)
    return {
        lang: (keys[which == k], bits[which == k]) for k, lang in enumerate(langs.dictionary.to_pylist())
    }


def _adding(model):
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {lang: Lookup(*table) for lang, table in model.value.items()}
        for batch in batches:
            texts = [text or "" for text in batch["text"].to_pylist()]
            langs = [
                model_of(lang or "", half_of(text)) for lang, text in zip(batch["lang"].to_pylist(), texts)
            ]
            total = batch["total"].to_numpy(zero_copy_only=False).copy()
            for lang in set(langs) & set(lookups):
                own = np.array([i for i, name in enumerate(langs) if name == lang])
                for portion in _portions([texts[i] for i in own]):
                    rows = own[portion]
                    keys, real, starts = packed([texts[i] for i in rows])
                    bits = np.where(real, lookups[lang](keys), np.float32(0)).astype(np.float64)
                    total[rows] += np.add.reduceat(bits, starts)
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "lang": batch["lang"], "text": batch["text"], "total": pa.array(total)}
            )

    return added


def limits(
    scored: DataFrame, low: float = LOW, high: float = HIGH, least: int = LEAST_TRUSTED, many: int = MANY_TRUSTED
) -> DataFrame:
    """Rows (lang, low_bits, high_bits): quantiles of the trusted documents' bits per character.

    Bits are rounded to three decimals and counted by value, so no language's documents meet in
    one task. Languages with fewer than ``least`` trusted documents have no row. Where there are
    fewer than ``many``, the distance of a limit from the median is doubled: of that few, a clean
    document easily lies beyond the most extreme one seen.
    """
    bins = scored.where("trusted AND bits IS NOT NULL").groupBy("lang", "bits").agg(
        F.count(F.lit(1)).alias("n")
    )
    upto = Window.partitionBy("lang").orderBy("bits")
    ranked = bins.withColumns(
        {"upto": F.sum("n").over(upto), "of": F.sum("n").over(Window.partitionBy("lang"))}
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("of"), F.col("bits")))

    found = ranked.groupBy("lang").agg(
        quantile(low).alias("low"), quantile(0.5).alias("middle"), quantile(high).alias("high"), F.max("of").alias("of")
    )
    further = F.when(F.col("of") < many, 2).otherwise(1)
    return found.where(F.col("of") >= least).select(
        "lang",
        *[
            F.round(F.col("middle") + (F.col(side) - F.col("middle")) * further, 3).alias(f"{side}_bits")
            for side in ("low", "high")
        ],
    )


def classified(
    docs: DataFrame,
    trusted: DataFrame,
    low: float = LOW,
    high: float = HIGH,
    least: int = LEAST_TRUSTED,
) -> DataFrame:
    """Perplexity and verdict of every document, one row per input row.

    ``trusted`` lists the doc_ids of the training text. Texts are dealt to two halves by their hash
    and each is scored by a model of its language that was trained on the trusted texts of the
    other half; so trusted documents, which set the limits, are scored as unseen as all others. A
    document is kept if its bits per character lie within the quantiles ``low`` and ``high`` of its
    language's trusted documents.

    Returns doc_id, lang, perplexity (per character), low_perplexity, high_perplexity, kept. Empty
    and NULL texts have no perplexity and are rejected. A NULL language is a language of its own,
    the empty one. Documents of a language without trusted text in the other half cannot be judged:
    NULL perplexity, kept. In a language with fewer than ``least`` trusted documents that have a
    perplexity there are no limits: all texts that are not empty are kept. NULL ids are never trusted. Repeated rows get a row each and count each in training. An
    empty table gives an empty result; other columns are ignored.
    """
    return _judged(docs, trusted, low, high, least).drop("text_hash")


def accepted(docs: DataFrame, trusted: DataFrame, least: int = LEAST_TRUSTED) -> DataFrame:
    """The rows of ``docs`` that ``classified`` keeps, with all their columns.

    A verdict goes by language and text, so rows are told apart by them and their id: different
    texts or languages under one id are judged each on its own, and rows without an id like others.
    """
    verdicts = _judged(docs, trusted, LOW, HIGH, least)
    number, language, digest = map(fresh_name, ("doc_id", "lang", "text_hash"))
    rejected = verdicts.where("NOT kept").select(
        F.col("doc_id").alias(number), F.col("lang").alias(language), F.col("text_hash").alias(digest)
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col(number))
        & (F.xxhash64("text") == F.col(digest))
        & (F.coalesce("lang", F.lit("")) == F.col(language))
    )
    return docs.join(rejected.distinct(), same, "left_anti")


def _judged(
    docs: DataFrame, trusted: DataFrame, low: float, high: float, least: int
) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = trusted.select(F.col("doc_id").cast(kind).alias("_id")).distinct()
    ids = ids.withColumn("_known", F.lit(True))
    lang = F.coalesce("lang", F.lit("")).alias("lang")
    rows = docs.select("doc_id", lang, "text")
    # A merge join at every size: the ids grow with the documents, so they are not broadcast.
    marked = rows.join(ids.hint("merge"), F.col("doc_id") == F.col("_id"), "left").select(
        "lang", "text", F.coalesce("_known", F.lit(False)).alias("trusted")
    )
    grams = stored(ngram_counts(marked))
    scored = with_bits(rows, log_probabilities(grams))
    length = F.length("text")
    small = stored(
        scored.select(
            "doc_id",
            "lang",
            F.xxhash64("text").alias("text_hash"),
            F.coalesce(length, F.lit(0)).alias("n_chars"),
            F.when((length > 0) & (F.col("total") > 0), F.round(F.col("total") / length, 3)).alias("bits"),
        )
    )
    judged = small.join(ids, F.col("doc_id") == F.col("_id"), "left").withColumn(
        "trusted", F.coalesce("_known", F.lit(False))
    )
    bounds = limits(judged, low, high, least)
    inside = F.col("bits").between(F.col("low_bits"), F.col("high_bits"))
    return judged.join(bounds, "lang", "left").select(
        "doc_id",
        "lang",
        "text_hash",
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), "low_bits").alias("low_perplexity"),
        F.pow(F.lit(2.0), "high_bits").alias("high_perplexity"),
        ((F.col("n_chars") > 0) & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
