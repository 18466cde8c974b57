"""Exact top-K threshold join of names within blocks.

A pair's score can be no more than twice the letters the two names share,
counted with repeats, over the sum of their lengths. So a pair matters only
where that bound reaches the score that the left name's K-th best partner has
already. Three steps, all exact:

1. `with_letters` gives every distinct name its letters (letter, how many-th),
   their 256-bit sketch, and its length;
2. `thresholds` scores a few close names per left name (names that share a
   minimum hash of three-letter pieces and stand next to it) and takes the K-th best of those
   scores: the left name's threshold, which can only be below its true K-th
   best score;
3. `bounded_pairs` forms the pairs of a block cell by cell and keeps those
   whose bound reaches the threshold, by length, then by sketch, then by the
   letters themselves. Only these are scored.

Blocks are cut into g x g cells, so a block that holds a third of all names is
spread over g * g tasks. `block` is a string key, never NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions.similarity import length_bound, name_len

Scorer = Callable[[Column, Column], Column]

SKETCH = ("s0", "s1", "s2", "s3")
# Minimum hashes of a name, and partners taken from the names that share one: those next to it in order.
HASHES = 4
SEEDS = 16
# A score may exceed the bound by rounding only.
SLACK = 1e-9


def letters(name: Column) -> Column:
    """One number per letter of the lower-cased name: letter and how many-th of its kind."""
    ordered = F.array_sort(F.filter(F.split(F.lower(name), ""), lambda x: x != ""))
    return F.transform(ordered, lambda x, i: F.ascii(x).cast("long") * (1 << 20) + i - F.array_position(ordered, x) + 1)


def _sketch(marks: Column, part: int) -> Column:
    """Bits of one quarter of the sketch: a bit per letter, several letters may share one."""
    place = lambda m: F.pmod(F.xxhash64(m), F.lit(256)).cast("int")
    return F.aggregate(marks, F.lit(0).cast("long"), lambda acc, m: F.when(
        F.shiftright(place(m), 6) == part, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place(m), F.lit(64)))))
        .otherwise(acc))


def with_letters(names: DataFrame, name_col: str = "name") -> DataFrame:
    """`names` with `len`, `letters` and the sketch columns."""
    out = names.withColumn("len", name_len(name_col)).withColumn("letters", letters(F.col(name_col)))
    return out.select("*", *[_sketch(F.col("letters"), i).alias(c) for i, c in enumerate(SKETCH)])


def bucket(length: Column) -> Column:
    """floor(log2(len)) for len >= 1; empty names get bucket -1."""
    return F.when(length == 0, F.lit(-1)).otherwise(F.floor(F.log2(length)).cast("int"))


def sketch_bound(a: str, b: str) -> Column:
    """Upper bound of the letter bound: a bit set on one side only is a letter the other lacks."""
    col = lambda side, c: F.col(f"{side}_{c}")
    lacks = lambda x, y: sum((F.bit_count(col(x, c).bitwiseAND(F.bitwise_not(col(y, c)))) for c in SKETCH), F.lit(0))
    shared = F.least(col(a, "len") - lacks(a, b), col(b, "len") - lacks(b, a))
    return _share(shared, col(a, "len") + col(b, "len"))


def letter_bound(a: str, b: str) -> Column:
    """2 * shared letters / total length, letters counted with repeats."""
    shared = F.size(F.array_intersect(f"{a}_letters", f"{b}_letters"))
    return _share(shared, F.col(f"{a}_len") + F.col(f"{b}_len"))


def _share(shared: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(1.0)).otherwise((shared * 2).cast("double") / total.cast("double"))


def _side(names: DataFrame, side: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return names.select("block", *extra, *[F.col(c).alias(f"{side}_{c}") for c in ("name", "len", "letters", *SKETCH)])


def bounded_pairs(left: DataFrame, right: DataFrame, slack: float = SLACK, tasks: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (block, l_name, r_name, threshold) whose letter bound reaches the left name's threshold,
    with the right names' columns `keep`.

    `left` and `right` come from `with_letters` and have `block`, `name`, `g`
    (cells per side of the block; with `h`, g rows of left names and h columns of right
    ones); `left` also has `threshold` (> 0). The cells are
    spread over `tasks` tasks where given: their work is in the pairs, not in the bytes read.
    """
    h = "h" if "h" in left.columns else "g"
    cells = lambda side: F.explode(F.sequence(F.lit(0), F.col(side) - 1).cast("array<bigint>"))
    reach = (F.lit(2.0) - F.col("threshold")) / F.col("threshold")  # longest/shortest length the threshold allows
    lo = F.when(F.col("l_len") == 0, F.lit(-1)).otherwise(
        bucket(F.greatest(F.lit(1), F.floor(F.col("l_len") / reach + slack).cast("int"))))
    hi = F.when(F.col("l_len") == 0, F.lit(-1)).otherwise(bucket(F.greatest(F.lit(1), F.ceil(F.col("l_len") * reach - slack).cast("int"))))
    sides = tuple(dict.fromkeys(("g", h)))
    lhs = (_side(left, "l", (*sides, "threshold")).withColumn("bucket", F.explode(F.sequence(lo, hi)))
           .withColumn("gr", F.pmod(F.xxhash64("l_name"), F.col("g").cast("bigint"))).withColumn("gc", cells(h)).drop(*sides))
    rhs = (_side(right, "r", (*sides, *keep)).withColumn("bucket", bucket(F.col("r_len")))
           .withColumn("gc", F.pmod(F.xxhash64("r_name"), F.col(h).cast("bigint"))).withColumn("gr", cells("g")).drop(*sides))
    least = F.col("threshold") - F.lit(slack)
    if tasks is not None:
        lhs, rhs = (side.repartition(tasks, "block", "bucket", "gr", "gc") for side in (lhs, rhs))
    return (lhs.join(rhs, ["block", "bucket", "gr", "gc"])
            .where(length_bound(F.col("l_len"), F.col("r_len")) >= least).where(sketch_bound("l", "r") >= least)
            .where(letter_bound("l", "r") >= least).select("block", "l_name", "r_name", "threshold", *keep))


def _hashes(name: Column) -> Column:
    low = F.lower(name)
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(low) - 2, F.lit(1))), lambda p: F.substring(low, p, F.lit(3)))
    return F.array(*[F.struct(F.lit(i).alias("i"), F.array_min(F.transform(pieces, lambda x, i=i: F.xxhash64(x, F.lit(i)))).alias("h"))
                     for i in range(HASHES)])


def _orders(name: Column) -> list[Column]:
    """An order of names per minimum hash: from the front, from the back, by their letters, from the middle."""
    low = F.lower(name)
    half = (F.char_length(low) / 2).cast("int")
    by_letter = F.array_join(F.array_sort(F.split(low, "")), "")
    return [low, F.reverse(low), by_letter, F.concat(F.substring(low, half + 1, F.char_length(low)), F.substring(low, F.lit(1), half))]


def close_pairs(left: DataFrame, right: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """Distinct (block, l_name, r_name) that share a minimum hash: per hash, the `seeds` right
    names around the left one in the hash's order of names, so an equal name is among them."""
    def keyed(df: DataFrame, is_left: bool) -> DataFrame:
        orders = F.array(*_orders(F.col("name")))
        return df.select("block", "name", F.lit(is_left).alias("is_left"), orders.alias("orders"), F.explode(_hashes(F.col("name"))).alias("k")).select(
            "block", "k.i", "k.h", "name", "is_left", F.get("orders", F.col("k.i")).alias("key"))

    # Place of a right name among its hash's right names; of a left name, how many stand before it (the equal one behind it).
    order = Window.partitionBy("block", "i", "h").orderBy("key", "name", F.col("is_left").desc()).rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed(left, True).unionByName(keyed(right, False)).withColumn("place", F.count_if(~F.col("is_left")).over(order))
    around = F.sequence(F.col("place") - (seeds // 2 - 1), F.col("place") + (seeds - seeds // 2))
    lefts = placed.where("is_left").select("block", "i", "h", F.col("name").alias("l_name"), F.explode(around).alias("place"))
    rights = placed.where("not is_left").select("block", "i", "h", F.col("name").alias("r_name"), "place")
    return lefts.join(rights, ["block", "i", "h", "place"]).select("block", "l_name", "r_name").distinct()


def thresholds(scored: DataFrame, entries: DataFrame, k: int, min_score: float) -> DataFrame:
    """(block, l_name, threshold): the score at which the scored partners of a left
    name hold `k` entries; absent where they do not.

    `scored`: block, l_name, r_name, similarity. `entries`: block, l_name,
    r_name, n (entries of the right name that are open to the left one)."""
    w = Window.partitionBy("block", "l_name").orderBy(F.col("similarity").desc(), "r_name").rowsBetween(Window.unboundedPreceding, 0)
    known = (scored.where(F.col("similarity") >= min_score).join(entries, ["block", "l_name", "r_name"])
             .withColumn("_n", F.sum("n").over(w)).where(F.col("_n") >= k))
    return known.groupBy("block", "l_name").agg(F.max("similarity").alias("threshold"))
