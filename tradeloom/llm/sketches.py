"""Document fingerprints: all shingle hashes below a fixed fraction of the hash space, sorted.

The fraction, not a number, bounds a sketch, so sketches of unequal documents are comparable as they are:
the sketch of two documents together is what ``merged`` makes of theirs, and the share of one sketch found in another
estimates the containment of the documents. A short text may have no hash in the fraction. It then keeps its least
one, which tells it from other texts but is not in the sketch of a longer text that holds it: containment of such
a text in a longer one is not estimated, but 0. Only built-in functions of Spark are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import text_of

SHINGLE_WORDS = 5
#: One of so many hashes is retained.
SCALE = 8
#: Signed hashes below this one are retained.
BELOW = -(2**63) + 2**64 // SCALE
_WHITE = r"[\x20\x09-\x0D]+"


def with_sketch(frame: DataFrame, text: str, sketch: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the sorted distinct hashes of word shingles that lie below 1/SCALE of the hash space.

    Words are lower-cased. A text of fewer words than a shingle is one shingle; a text without words has an
    empty sketch. If no hash is low enough the least one is retained, so that other texts have one.
    """
    words, hashes, all_ = f"_{sketch}_words", f"_{sketch}_hashes", f"_{sketch}_all"
    n, low = F.size(words), F.filter(all_, lambda x: x < F.lit(BELOW))
    shingle = F.transform(
        F.sequence(F.lit(0), n - shingle_words),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(shingle_words)]),
    )
    return (
        frame.withColumn(words, F.filter(F.split(F.lower(text), _WHITE), lambda w: w != ""))
        .withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(
            all_,
            F.when(n >= shingle_words, shingle)
            .when(n > 0, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>")),
        )
        .withColumn(sketch, low)
        .withColumn(
            sketch,
            F.when((F.size(sketch) == 0) & (n > 0), F.array(F.array_min(all_))).otherwise(
                F.array_sort(F.array_distinct(sketch))
            ),
        )
        .drop(words, hashes, all_)
    )


def merged(a: Column | str, b: Column | str) -> Column:
    """The sketch of both documents together: a least hash above the fraction goes once there is one below."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda x: x < F.lit(BELOW))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(part: Column | str, whole: Column | str) -> Column:
    """Estimated share of the shingles of one document that the other has; 1 if there are none."""
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(part, whole)) / F.size(part))


def likeness(a: str, b: str) -> Column:
    """Containment of the smaller sketch in the larger one. Two empty sketches are alike, one empty is not."""
    smaller = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(smaller > 0, shared / smaller).otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def encoded(sketch: str) -> Column:
    """16 hex digits a hash, in order."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _range_of(value: Column, bounds: list[float]) -> Column:
    """Number of bounds up to the value, by a look-up in two steps of about the square root of their number."""
    width = max(1, math.isqrt(len(bounds)))
    fine = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not fine:
        return F.lit(0)

    def literal(values):
        return F.array(*[F.lit(float(v)) for v in values])

    def up_to(array):
        return F.size(F.filter(array, lambda b: b <= value))

    group = up_to(literal([g[0] for g in fine]))
    inner = up_to(F.get(F.array(*[literal(g) for g in fine]), group - 1))
    return F.when(group > 0, (group - 1) * width + inner).otherwise(0)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the row with the next ``id``; the last row's next is the first.

    Ranges of ids, cut at quantiles that are ids themselves, are sorted side by side; the rows at the start of
    a range also go, as guests, to the end of the one before. Equal ids go by ``tie``, null ids come first.
    """
    spark = rows.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    value = F.col("id").cast("double")
    ids = rows.select("id", value.alias("value"))
    row = ids.agg(F.min("value"), F.count_if(F.col("id").isNull())).first()
    quantiles = []
    if row[0] is not None:
        quantiles = ids.approxQuantile("value", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    bounds = sorted({q for q in quantiles if q > row[0]})
    if row[1]:
        tie = rows.filter("id IS NULL").agg(F.min("tie")).first()[0]
        first = F.col("id").isNull() & (F.col("tie") == F.lit(tie))
    else:
        first = value == F.lit(row[0])
    ranged = rows.withColumn("range", F.when(value.isNull(), F.lit(0)).otherwise(_range_of(value, bounds)).cast("int"))
    here = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))
    back = F.struct((F.col("range") - 1).alias("at"), F.lit(True).alias("guest"))
    last = F.struct(F.lit(len(bounds)).alias("at"), F.lit(True).alias("guest"))
    starts = (F.col("range") > 0) & value.isin(bounds) if bounds else F.lit(False)
    stops = F.filter(
        F.array(here, F.when(starts, back), F.when(F.coalesce(first, F.lit(False)), last)), lambda s: s.isNotNull()
    )
    dealt = ranged.select("*", F.explode(stops).alias("stop"))
    dealt = dealt.select("*", "stop.at", "stop.guest").drop("stop", "range")
    order = Window.partitionBy("at").orderBy("guest", F.col("id").asc_nulls_first(), "tie")
    following = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return following.filter("NOT guest").drop("at", "guest")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the start of the next document's text, by id. Ids are
    numbers; rows with equal ids follow each other in the order of their texts' hashes, rows without an id come first.
    Null texts are empty; two documents without words are alike, one without words is like no other.
    A single row is its own next. An empty table gives no rows.
    """
    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    sketched = with_sketch(source.withColumn("tie", F.xxhash64("text")), "text", "sketch")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    pairs = with_next(sketched, ["text", "sketch"]).withColumn("edited", edited)
    both = with_sketch(pairs, "edited", "edited_sketch")
    return both.select(
        F.col("id").alias(id_column),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        encoded("sketch").alias("fingerprint"),
        encoded("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
    )
