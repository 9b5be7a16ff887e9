"""Document fingerprints: bottom-k sketches of shingle hashes, by column expressions alone.

A sketch is the ``K`` smallest distinct hashes (40 bits) of a text's shingles
of ``SHINGLE`` words, in ascending order. Sketches of parts merge into the
sketch of the whole, and estimate resemblance, containment and the number of
distinct shingles. Below ``K`` shingles the estimates are exact.

Defined results: null and blank texts have an empty sketch. Two empty sketches
are alike (1), an empty and a filled one are not (0). Fewer words than a
shingle make one shingle. Equal texts have equal sketches. Of rows with equal ids
the order is by a hash of the text; rows without an id come last. Every input
row gives one row; a single row is its own next row. Only key and text are read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermark.llm.shared import partitions

K = 128
SHINGLE = 5
BITS = 40
# For the bounds of ranges: hashed groups, and quantiles of each.
GROUPS = 64
FINE = 500


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text: ascending distinct hashes."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    # A one-element array keeps the word hashes as a variable, so they are computed once.
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)])
        )
        every = F.when(F.size(h) >= size, runs).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.transform(every, lambda x: F.shiftrightunsigned(x, 64 - BITS))

    found = F.get(F.transform(F.array(hashes), of), 0)
    return F.slice(F.sort_array(F.array_distinct(found)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of two sketched sets."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    exact = F.size(a).cast("double")
    return F.when(F.size(a) < k, exact).otherwise(F.lit(k - 1) * F.lit(float(1 << BITS)) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has too."""
    share = resemblance(a, b, k) * distinct_count(merged(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """A sketch as a string of hexadecimal numbers of equal length."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def range_bounds(rows: DataFrame, key: str, n: int) -> tuple[list, int]:
    """``n`` - 1 ascending bounds that split the keys about evenly, and into how many ranges rows without a key go.

    Rows are dealt to groups in turn; quantiles of each group first, then
    quantiles of those, so no task merges the summaries of all others. A bound
    that comes several times is a key with that share of the rows. Bounds
    decide how even the ranges are, not what is found in them.
    """
    fine = [i / FINE for i in range(FINE + 1)]
    group = F.pmod(F.monotonically_increasing_id(), F.lit(GROUPS)).alias("g")
    quantiles = rows.groupBy(group).agg(
        F.percentile_approx(key, fine, 2 * FINE).alias("q"), F.count(F.lit(1)).alias("n"), F.count(key).alias("filled")
    )
    shares = [i / n for i in range(1, n)] or [0.5]
    listed = quantiles.select(F.explode_outer("q").alias("q")).agg(F.percentile_approx("q", shares, 100 * n).alias("b"))
    total, filled = quantiles.agg(F.sum("n"), F.sum("filled")).first()
    return sorted(listed.first()["b"] or []), max(1, round(n * (1 - (filled or 0) / total)) if total else 1)


def range_of(key: Column, tie: Column, bounds: list, late: int) -> Column:
    """The number of a row's range, ascending by key and tie; rows without a key come last.

    A key that fills several ranges is cut evenly by the tie, a hash over all
    64-bit values. The search is one fold over the steps of a binary search, so
    the plan holds the bounds as one array, however many they are.
    """
    keys = sorted(set(bounds))
    repeats = Counter(bounds)
    slices = [repeats[k] if repeats[k] > 1 else 0 for k in keys]
    offsets = [0]
    for m in slices:
        offsets.append(offsets[-1] + 1 + m)

    def slice_of(m) -> Column:
        share = tie.cast("double") / F.lit(2.0**64) + F.lit(0.5)
        return F.least(F.floor(share * m).cast("int"), m - 1)

    without = F.lit(offsets[-1] + 1) + slice_of(F.lit(late))
    if not keys:
        return F.when(key.isNull(), without).otherwise(F.lit(0))
    listed = F.lit(keys)
    steps = F.lit([1 << i for i in reversed(range(len(keys).bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) < key, at + step).otherwise(at))

    if not any(slices):
        return F.when(key.isNull(), without).otherwise(below)

    def place(i: Column) -> Column:
        own = F.get(F.lit(slices), i)
        cut = (F.get(listed, i) == key) & (own > 0)
        return F.get(F.lit(offsets), i) + F.when(cut, slice_of(own) + 1).otherwise(0)

    return F.when(key.isNull(), without).otherwise(F.get(F.transform(F.array(below), place), 0))


def with_next(rows: DataFrame, key: str, carried: list[str], prepare=lambda df: df) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row that follows by ``key``, the first row's after the last.
    ``prepare`` adds columns to the rows just before they are dealt out.

    Rows are dealt to ranges of the key. Each range also gets the first row of
    the next one, so the following row is found within a range: one shuffle,
    and no task that holds more than a few ranges. A key that fills several ranges,
    or rows without one, are spread by a hash of the text; rows that are equal in both share a range.
    """
    # Several ranges for each partition, so that partitions come out even.
    bounds, late = range_bounds(rows, key, 4 * partitions(rows))
    tie = F.xxhash64("text")
    placed = rows.select(
        "*",
        range_of(F.col(key), tie, bounds, late).cast("int").alias("part"),
        tie.alias("tie"),
        F.col(key).isNull().alias("late"),
    )
    order = ["late", key, "tie"]
    firsts = placed.groupBy("part").agg(F.min(F.struct(*order)).alias("first"))
    # One row for each range; the first row of a range goes to the range before it, the very first to the last.
    few = Window.orderBy("part")
    before = F.coalesce(F.lag("part").over(few), F.max("part").over(Window.partitionBy()))
    targets = firsts.select(before.alias("target"), F.col("part").alias("home"), "first")
    same = (placed["part"] == targets["home"]) & F.struct(*[placed[c] for c in order]).eqNullSafe(targets["first"])
    heads = placed.join(F.broadcast(targets), same).dropDuplicates(["target"])
    heads = heads.select(*[F.col("target").alias("part") if c == "part" else placed[c] for c in placed.columns], F.lit(True).alias("extra"))
    window = Window.partitionBy("part").orderBy("extra", *order)
    every = prepare(placed.withColumn("extra", F.lit(False)).unionByName(heads))
    followed = every.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in carried])
    return followed.filter(~F.col("extra")).drop("part", "tie", "late", "extra")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per document row: sketch of the text, of its edited text, and their likeness.

    Edited: the last quarter of the characters is replaced by as many from the
    start of the next document.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = with_next(
        rows, "doc_id", ["text", "sketch"], lambda df: df.withColumn("sketch", sketch(F.col("text"), k))
    )
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited",
        F.expr("concat(substring(text, 1, n_chars - n_chars div 4), substring(next_text, 1, CAST(n_chars div 4 AS INT)))"),
    )
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
