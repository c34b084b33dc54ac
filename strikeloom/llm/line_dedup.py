"""Line deduplication by deletion neighbourhoods: equal lines and lines one edit apart.

DataFrame expressions only. Two lines are one edit apart if they become equal by deleting one
character from each at the same place (a replacement) or one from the longer (an insertion). So
lines are hashed with each of their characters left out, and equal hashes are joined. Variants that
cannot meet are not made: hashes of what lies outside an edit first show which lines can be one
edit apart, and where.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strikeloom.llm.identity import fresh_name
from strikeloom.sinks.shared import stored

MAX_EDITS = 1
# Lines shorter than this are not compared within an edit, which makes another word of them. Their
# exact repeats stay as well where no other minimum is given.
MIN_CHARS = 20
# An edit is narrowed down to a stretch of at most twice this length before variants are made.
STEP = 16


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Rows (doc_id, line_no, line) of the lines that take part, without white space at their ends."""
    named = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    each = named.select("doc_id", F.posexplode(_split(F.col("text"))).alias("line_no", "line"))
    trimmed = each.withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\x0c")))
    return trimmed.where(F.length("line") >= min_chars)


def _half_keys(min_chars: int) -> Column:
    """Hashes of a line's beginning and end, of which lines one edit apart share one.

    An edit leaves the first or the last half of a line as it was. The halves compared are as long
    as the largest ``min_chars / 2 * 2^j`` that fits; where that step lies between a line and one
    that is shorter by a character, the smaller half is given as well.
    """
    n = F.length("line")
    double = F.length(F.bin((n / min_chars).cast("long"))) - 1
    half = F.floor(F.lit(max(1, min_chars // 2)) * F.pow(F.lit(2), double)).cast("int")
    border = n == half * 2

    def pair(size: Column) -> list[Column]:
        return [
            F.xxhash64(F.lit(0), size, F.left("line", size)),
            F.xxhash64(F.lit(1), size, F.right("line", size)),
        ]

    smaller = F.floor(half / 2).cast("int")
    return F.when(border, F.array(*pair(half), *pair(smaller))).otherwise(F.array(*pair(half)))


def _seen(docs: DataFrame, shortest: int, min_chars: int) -> DataFrame:
    """Rows (h1, h2, doc_id, line_no, keys): each line's 128-bit identity, place and half keys.

    Texts are split once for all that needs no more of a line than its hashes.
    """
    keys = F.when(F.length("line") >= min_chars, _half_keys(min_chars))
    identity = {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line"), "keys": keys}
    lines = _lines(docs, shortest).withColumns(identity)
    return stored(lines.select("h1", "h2", "doc_id", "line_no", "keys"))


def _candidates(docs: DataFrame, seen: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows (doc_id, line_no, h1, line): first occurrences of lines that share half with another line."""
    keyed = seen.select("h1", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    meeting = keyed.join(shared.where("a <> b").select("key"), "key", "left_semi")
    found = firsts.join(meeting.select("h1").distinct(), "h1", "left_semi")
    wanted = found.groupBy(F.col("first.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), "h1")).alias("wanted")
    )
    # A document that is repeated shows its lines once.
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")
    each = texts.withColumn("split", _split(F.col("text"))).select(
        "doc_id", "split", F.explode("wanted").alias("w")
    )
    line = F.btrim(F.get("split", F.col("w.line_no")), F.lit(" \t\r\x0b\x0c"))
    rows = each.select("doc_id", "w.line_no", "w.h1", line.alias("line"))
    return rows.where(F.xxhash64("line") == F.col("h1")).dropDuplicates(["doc_id", "line_no", "h1"])


def _stretches(candidates: DataFrame) -> DataFrame:
    """Rows (h1, stretches): where in a line an edit between it and another can be, as (start, rest).

    Lines one edit apart agree before the stretch of STEP characters with their first difference,
    and after it up to a multiple of STEP from their end. The multiple follows from the shorter
    line's length, so each line gives its hash for its own length and for one character less.
    Lines stand for themselves by their hash here, so that their texts are not shuffled.
    """
    n = F.length("line")
    starts = F.sequence(F.lit(0), F.floor(n / STEP).cast("int") * STEP, F.lit(STEP))
    each = candidates.select("h1", "line", F.explode(starts).alias("start"))

    def rest(size: Column) -> Column:
        steps = F.floor((size - F.col("start") - STEP) / STEP).cast("int")
        return F.greatest(F.lit(0), steps * STEP)

    both = each.select("*", F.explode(F.array_distinct(F.array(rest(n), rest(n - 1)))).alias("rest"))
    outside = F.xxhash64("start", "rest", F.left("line", "start"), F.right("line", "rest"))
    keyed = stored(both.select("h1", "start", "rest", outside.alias("key")))
    shared = keyed.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    meeting = keyed.join(shared.where("a <> b").select("key"), "key", "left_semi")
    return meeting.groupBy("h1").agg(F.collect_set(F.struct("start", "rest")).alias("stretches"))


def _variants(candidates: DataFrame) -> DataFrame:
    """Rows (v, at, place): hashes of lines without the character ``at``, where an edit can be."""
    found = candidates.join(_stretches(candidates), "h1")
    n = F.length("line")
    places = F.transform(
        F.filter("stretches", lambda s: s["start"] < n - s["rest"]),
        lambda s: F.sequence(s["start"], n - s["rest"] - 1),
    )
    rows = found.select(
        "line",
        F.struct("doc_id", "line_no", "h1").alias("place"),
        F.explode(F.array_distinct(F.flatten(places))).alias("at"),
    )
    shorter = F.concat(F.left("line", F.col("at")), F.substr("line", F.col("at") + 2))
    return rows.select(F.xxhash64(shorter).alias("v"), "at", "place")


def _near_lines(candidates: DataFrame) -> DataFrame:
    """Rows (doc_id, line_no): first occurrences of lines one edit from an earlier line.

    Equal variants and the whole line that equals them meet in one shuffle. Each line is given its
    earliest partner only: of those whose variant at the same place is equal (a replacement), the
    line that its variant is (an insertion) and those whose variant is the line.
    """
    place = F.struct("doc_id", "line_no", "h1")
    whole = candidates.select(F.col("h1").alias("v"), F.lit(-1).alias("at"), place.alias("place"))
    met = stored(_variants(candidates)).unionByName(whole).repartition("v")
    same, at_place = Window.partitionBy("v"), Window.partitionBy("v", "at")
    of_variants = F.when(F.col("at") >= 0, F.col("place"))
    of_wholes = F.when(F.col("at") < 0, F.col("place"))
    earliest = F.when(
        F.col("at") >= 0, F.least(F.min("place").over(at_place), F.min(of_wholes).over(same))
    ).otherwise(F.min(of_variants).over(same))
    linked = met.withColumn("earliest", earliest).where("earliest < place")
    pairs = linked.groupBy("place").agg(F.min("earliest").alias("earliest"))

    texts = candidates.select(place.alias("p"), "line")
    later = pairs.join(texts, F.col("place") == F.col("p")).select(
        "place", "earliest", F.col("line").alias("later_line")
    )
    both = later.join(texts, F.col("earliest") == F.col("p"))
    near = both.where(F.levenshtein("later_line", "line", MAX_EDITS) >= 0)
    return near.select("place.doc_id", "place.line_no")


def dropped_lines(
    docs: DataFrame,
    max_edits: int = MAX_EDITS,
    min_chars: int = MIN_CHARS,
    min_exact: int | None = None,
) -> DataFrame:
    """Rows (doc_id, line_no) of the lines that repeat an earlier one, by document id and place."""
    if max_edits not in (0, 1):
        raise ValueError("lines are compared exactly or within one edit")
    shortest = min_chars if min_exact is None else max(1, min_exact)
    seen = _seen(docs, shortest, min_chars)
    firsts = stored(
        seen.groupBy("h1", "h2").agg(
            F.min(F.struct("doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("n")
        )
    )
    again = seen.join(firsts.where("n > 1"), ["h1", "h2"]).where(
        F.struct("doc_id", "line_no") > F.col("first")
    )
    drops = again.select("doc_id", "line_no")
    if max_edits:
        drops = drops.unionAll(_near_lines(stored(_candidates(docs, seen, firsts))))
    return drops


def without_repeated_lines(
    docs: DataFrame,
    max_edits: int = MAX_EDITS,
    min_chars: int = MIN_CHARS,
    min_exact: int | None = None,
) -> DataFrame:
    """``docs`` with lines removed from ``text`` that equal an earlier line or are one edit from it.

    A line's place is (doc_id, number in the text); white space at its ends does not count. Of
    equal lines the first stays; a line within ``max_edits`` edits of an earlier, different line
    goes with all its copies. Lines are judged on the input, also against lines that go
    themselves. Lines under ``min_chars`` characters are near no other; their exact repeats go from
    ``min_exact`` characters on (``min_chars`` where None). Blank lines stay.

    All columns stay; n_lines and n_removed are added (a column of that name is replaced). NULL
    texts stay NULL with zero lines; empty texts have one line. Rows with a NULL id are left as
    they are and repeat nothing. Rows repeated with the same id are one document, so they keep and
    lose the same places. An empty table gives an empty result.
    """
    drops = stored(dropped_lines(docs, max_edits, min_chars, min_exact))
    number, dropped = fresh_name("doc_id"), fresh_name("dropped")
    listed = drops.groupBy(F.col("doc_id").alias(number)).agg(
        F.collect_set("line_no").alias(dropped)
    )
    joined = docs.join(listed, F.col("doc_id") == F.col(number), "left")
    lines = _split(F.col("text"))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    # The lines are bound to a name: written into the inner function, they would be split for each number.
    kept = F.get(
        F.transform(
            F.array(lines),
            lambda own: F.transform(F.array_except(numbers, dropped), lambda i: F.get(own, i)),
        ),
        0,
    )
    counted = joined.withColumns(
        {
            "n_lines": F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
            "text": F.when(F.col(dropped).isNull(), F.col("text")).otherwise(
                F.array_join(kept, "\n")
            ),
        }
    )
    return counted.withColumn("n_removed", F.greatest("n_removed", F.lit(0))).drop(
        number, dropped
    )
