"""Quality rules as a bitmask ledger: every rule once per document, policies and ablations from bits.

All of it is DataFrame expressions on single rows; only ablations aggregate, after grouping equal
masks on the map side.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_shouted",
)
# Fixed value: a window of repeated text has this many words.
WINDOW = 3
# More repeated windows than this are found by sorting instead of by looking each one up.
FEW = 64

# Rules by name, in the order of their bits; new rules are appended so that stored ledgers stay valid.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "10 * n_shouted > 3 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
}


@dataclass(frozen=True)
class Policy:
    """A version of the rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Mapping[str, str] = RULES) -> int:
        names = list(rules)
        return sum(1 << names.index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(RULES))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of each whole text; NULL counts as an empty text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.withColumns({"_words": words, "_lines": lines})
    n = F.size("_words")
    at = F.sequence(F.lit(0), n - WINDOW)
    window = F.transform(
        at, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])
    )
    counted = cut.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_shouted": F.regexp_count(
                text, F.lit(r"(?<!\p{L})\p{Lu}{2,}(?!\p{L})")
            ).cast("long"),
            "_windows": F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # Windows found twice are few in most texts: those are looked up. Where they are many, windows
    # are sorted together with their positions instead, so that no text takes quadratic time.
    ranked = counted.withColumn("_sorted", F.sort_array("_windows"))
    twice = F.filter("_sorted", lambda h, k: (k > 0) & (F.get("_sorted", k - 1) == h))
    listed = ranked.withColumn("_twice", F.array_distinct(twice))
    paired = F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    many = F.size("_twice") > FEW
    grouped = listed.withColumn("_pairs", F.when(many, paired))
    looked_up = F.filter(
        F.transform("_windows", lambda h, i: F.when(F.array_contains("_twice", h), i)),
        lambda i: i.isNotNull(),
    )
    neighbours = F.filter(
        "_pairs",
        lambda x, k: ((k > 0) & (F.get("_pairs", k - 1)["h"] == x["h"]))
        | F.coalesce(F.get("_pairs", k + 1)["h"] == x["h"], F.lit(False)),
    )
    starts = grouped.withColumn(
        "_starts",
        F.when(F.size("_twice") == 0, F.array().cast("array<int>"))
        .when(~many, looked_up)
        .otherwise(F.sort_array(F.transform(neighbours, lambda x: x["i"]))),
    )
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda s, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    done = starts.withColumn("n_repeat_words", covered.cast("long"))
    return done.drop("_words", "_lines", "_windows", "_sorted", "_twice", "_pairs", "_starts")


def failures(rules: Mapping[str, str] = RULES) -> Column:
    """The bits of the rules that a measured document fails."""
    bits = [
        F.when(F.expr(condition), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
        for bit, condition in enumerate(rules.values())
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Rows (doc_id, measures, failures), one per input row; texts are left out.

    Empty and NULL texts have zero measures and fail ``few_words``. NULL ids and repeated rows get
    their rows, an empty table an empty ledger; columns other than doc_id and text are ignored.
    Store the ledger once; policies and ablations need nothing else.
    """
    rows = measured(docs.select("doc_id", "text"))
    return rows.select("doc_id", *MEASURES, failures(rules).alias("failures"))


def failed(policy: Policy, rules: Mapping[str, str] = RULES) -> Column:
    """Whether a ledger row fails ``policy``."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def ablation(
    ledger_rows: DataFrame, policies: list[Policy], rules: Mapping[str, str] = RULES
) -> DataFrame:
    """What each rule adds to each policy, from the stored bits alone.

    Rows (policy, rule, n_docs, n_failing, n_rejected, n_only): documents in the ledger, those
    failing the rule, those the policy rejects, and those it would keep without the rule. Equal
    masks are counted first, so what follows handles at most 2^rules rows.
    """
    names = list(rules)
    pairs = F.array(
        *[
            F.struct(
                F.lit(policy.version).alias("policy"),
                F.lit(rule).alias("rule"),
                F.lit(policy.mask(rules)).cast("long").alias("mask"),
                F.lit(1 << names.index(rule)).cast("long").alias("bit"),
            )
            for policy in policies
            for rule in policy.rules
        ]
    )
    masks = ledger_rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    each = masks.select("failures", "n", F.explode(pairs).alias("p")).select("failures", "n", "p.*")
    hit = F.col("failures").bitwiseAND(F.col("mask"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        total(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failing"),
        total(hit != 0).alias("n_rejected"),
        total(hit == F.col("bit")).alias("n_only"),
    )
