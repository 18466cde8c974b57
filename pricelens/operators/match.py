"""Cross-marketplace candidate matching.

For every retailer listing, the top `k` marketplace listings of the same
category (NULL categories match each other) by name similarity >= 0.25,
excluding pairs already scored; ties broken by marketplace listing id.

Plan (exact, no listing-by-listing pairs):
1. distinct (category, name) per source - similarity depends on names only;
2. a top-K threshold join of the names (`simjoin`): each retailer name gets a
   threshold from a few close names, and only pairs whose letters can reach it
   are scored (Arrow UDF or a native column). For the edit score without stored
   pairs, equal names come first, then names one and two edits apart (`editjoin`);
   only retailer names whose k-th entry could still be beaten go to that join;
3. stored pairs are taken out where they are few and cheap to look up: an id
   that every listing of a retailer name has been paired with is closed to
   that name. Per (retailer name, marketplace name) the closed ids usually are
   the first ones; their number is the frontier, and reading starts behind it.
   So K = k + the stored pairs of one listing that are not closed
   to its whole name, which stays k however many runs came before;
4. the first K open ids per scored pair, the best K (name, id) per retailer
   name;
5. expand to retailer listings, drop the remaining stored pairs, keep the top k.

A scorer's value must not exceed 2 * shared letters / total length (the letter bound),
which holds for both scores of `functions.similarity`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.functions.similarity import difflib_similarity, edit_similarity, length_bound, name_len
from pricelens.operators import editjoin as E
from pricelens.operators.numbering import number_rows
from pricelens.operators.simjoin import SLACK, Scorer, bounded_pairs, close_pairs, thresholds, with_letters
from pricelens.operators.simjoin import bucket as _bucket
from pricelens.session import materialize, shuffles_dropped


def matchable(listings: DataFrame) -> DataFrame:
    """Listings that take part: the two known sources, price 0 -> NULL."""
    return (listings.filter(F.col("source").isin(C.SOURCE_MARKETPLACE, C.SOURCE_RETAILER))
                    .select("id", "product_name", "source", "category",
                            F.nullif(F.col("price").cast("double"), F.lit(0.0)).alias("price")))


def name_blocks(listings: DataFrame, grid: int | None = None, pairs_per_cell: int = C.PAIRS_PER_CELL):
    """Distinct (category, source, name) rows of the two sources with the
    grid side g of their category, and an upper bound of the name pairs to
    score (sum over categories of retailer names x marketplace names).

    The distinct names and the per-category stats (one row per category) are
    written once; joins with the stats are planned by their file size.
    Returns (names DataFrame with column g, pair estimate).
    """
    lm = matchable(listings)
    names, _ = materialize(lm.select("category", "source", "product_name").distinct(), "match_names")
    stats = names.groupBy("category").agg(
        F.count_if(F.col("source") == C.SOURCE_RETAILER).alias("nb"),
        F.count_if(F.col("source") == C.SOURCE_MARKETPLACE).alias("ne"))
    pairs = F.col("nb").cast("double") * F.col("ne").cast("double")
    g = (F.lit(int(grid)) if grid is not None else
         F.greatest(F.lit(1), F.ceil(F.sqrt(pairs / F.lit(float(pairs_per_cell))))))
    stats = stats.select(F.col("category").alias("gcat"), g.cast("int").alias("g"), pairs.alias("pairs"))
    stats, _ = materialize(stats, "match_grid")
    estimate = int(stats.agg(F.sum("pairs")).first()[0] or 0)
    names = names.join(stats, names.category.eqNullSafe(stats.gcat)).drop("gcat", "pairs")
    return names, estimate


def pairs_in_blocks(names: DataFrame, min_sim: float = C.MIN_SIMILARITY) -> DataFrame:
    """Band join of the retailer and marketplace names of each block (see
    `name_pairs`)."""
    ratio_max = (2 - min_sim) / min_sim  # longest/shortest length the bound allows
    rb = (names.filter(F.col("source") == C.SOURCE_RETAILER)
               .select("category", F.col("product_name").alias("bestbuy_name"), "g")
               .withColumn("la", name_len("bestbuy_name")))
    eb = (names.filter(F.col("source") == C.SOURCE_MARKETPLACE)
               .select(F.col("category").alias("ecat"), F.col("product_name").alias("ebay_name"), "g")
               .withColumn("lb", name_len("ebay_name")))
    cells = F.explode(F.sequence(F.lit(0), F.col("g") - 1).cast("array<bigint>"))
    eb = (eb.withColumn("bucket", _bucket(F.col("lb")))
            .withColumn("gc", F.pmod(F.xxhash64("ebay_name"), F.col("g").cast("bigint")))
            .withColumn("gr", cells).drop("g"))
    lo = F.when(F.col("la") == 0, F.lit(-1)).otherwise(
        _bucket(F.greatest(F.lit(1), F.ceil(F.col("la") / F.lit(ratio_max)).cast("int"))))
    hi = F.when(F.col("la") == 0, F.lit(-1)).otherwise(
        _bucket(F.floor(F.col("la") * F.lit(ratio_max)).cast("int")))
    rb = (rb.withColumn("bucket", F.explode(F.sequence(lo, hi)))
            .withColumn("gr", F.pmod(F.xxhash64("bestbuy_name"), F.col("g").cast("bigint")))
            .withColumn("gc", cells).drop("g"))
    j = rb.join(eb, on=[rb.category.eqNullSafe(eb.ecat), rb.bucket == eb.bucket,
                        rb.gr == eb.gr, rb.gc == eb.gc])
    bound = length_bound(F.col("la"), F.col("lb"))
    return (j.filter(bound >= F.lit(min_sim))
             .select(rb.category, "bestbuy_name", "ebay_name", bound.alias("length_bound")))


def name_pairs(listings: DataFrame, min_sim: float = C.MIN_SIMILARITY, grid: int | None = None,
               pairs_per_cell: int = C.PAIRS_PER_CELL) -> DataFrame:
    """Distinct (category, retailer name, marketplace name) pairs whose
    length bound reaches `min_sim` (bound 1/4 -> lengths within 7x).

    Band join: a marketplace name sits in one length bucket; a retailer name
    is sent to every bucket its bound can reach. Each category's block is cut
    into g x g cells (retailer names hashed to rows, marketplace names to
    columns), so a hot category is spread over g^2 tasks while each side is
    copied only g times; every pair is formed in exactly one cell. g comes
    from the category's name counts (`pairs_per_cell`), or is fixed by
    `grid`. The distinct names are written once and read by both sides.
    """
    names, _ = name_blocks(listings, grid, pairs_per_cell)
    return pairs_in_blocks(names, min_sim)


def _score_tasks(spark, estimate: int, pairs_per_task: int = C.PAIRS_PER_SCORE_TASK) -> int:
    """Tasks for `estimate` pairs: all cores, no more than the driver can keep track of."""
    try:
        floor = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, min(C.MAX_SCORE_TASKS, -(-estimate // pairs_per_task)))


def max_exclusions(existing: DataFrame | None) -> int:
    """Largest number of stored pairs any retailer listing has (0 if none)."""
    if existing is None:
        return 0
    row = (existing.select("ebay_listing_id", "bestbuy_listing_id").distinct()
                   .groupBy("bestbuy_listing_id").count().agg(F.max("count")).first())
    return int(row[0] or 0)


def _block(category: Column) -> Column:
    """A category as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), category), F.lit(""))


def closed_ids(lm: DataFrame, existing: DataFrame) -> tuple[DataFrame | None, int]:
    """Ids that all listings of a retailer name are paired with already:
    (block, l_name, r_name, ebay_listing_id), None where there are none, and the
    most stored pairs of one listing beside them. `existing` holds distinct pairs."""
    b = lm.filter(F.col("source") == C.SOURCE_RETAILER).select(
        _block(F.col("category")).alias("block"), F.col("product_name").alias("l_name"), F.col("id").alias("bestbuy_listing_id"))
    e = lm.filter(F.col("source") == C.SOURCE_MARKETPLACE).select(
        _block(F.col("category")).alias("block"), F.col("product_name").alias("r_name"), F.col("id").alias("ebay_listing_id"))
    # Only pairs that could be candidates today count: both listings are there, in one category.
    stored, _ = materialize(existing.join(b, "bestbuy_listing_id").join(e, ["block", "ebay_listing_id"]), "match_stored")
    by_name = b.groupBy("block", "l_name").agg(F.count(F.lit(1)).alias("listings"))
    closed = (stored.groupBy("block", "l_name", "r_name", "ebay_listing_id").agg(F.count(F.lit(1)).alias("n"))
              .join(by_name, ["block", "l_name"]).filter(F.col("n") == F.col("listings")).drop("n", "listings"))
    closed, n_closed = materialize(closed, "match_closed")
    rest = (stored.join(closed, ["block", "l_name", "r_name", "ebay_listing_id"], "left_anti")
            .groupBy("bestbuy_listing_id").count().agg(F.max("count")).first())
    return (closed if n_closed else None), int(rest[0] or 0)


def frontiers(closed: DataFrame, ranked: DataFrame) -> DataFrame:
    """(block, l_name, r_name): `frontier`, how many of the right name's first ids
    are closed without a gap, and `beyond`, closed ids behind the gap."""
    order = Window.partitionBy("block", "l_name", "r_name").orderBy("place")
    return (closed.join(ranked.select("block", "r_name", "ebay_listing_id", "place"), ["block", "r_name", "ebay_listing_id"])
            .withColumn("_n", F.row_number().over(order))
            .groupBy("block", "l_name", "r_name").agg(F.count_if(F.col("_n") == F.col("place")).alias("frontier"),
                                                      F.count_if(F.col("_n") != F.col("place")).alias("beyond")))


def _search_sides(listings: DataFrame, grid: int | None) -> tuple[DataFrame, DataFrame, int]:
    """Retailer and marketplace names with letters and grid side, written once, and the pairs of their blocks."""
    names, estimate = name_blocks(listings, grid)
    lettered = with_letters(names.filter(F.col("product_name").isNotNull()).select(
        _block(F.col("category")).alias("block"), "source", F.col("product_name").alias("name"), "g"))
    lettered, _ = materialize(lettered, "match_letters")
    side = lambda source: lettered.filter(F.col("source") == source).drop("source")
    return side(C.SOURCE_RETAILER), side(C.SOURCE_MARKETPLACE), estimate


def _scored(pairs: DataFrame, scorer: Scorer, estimate: int) -> DataFrame:
    """Pairs with `similarity`, spread evenly before the CPU-bound score. The
    task count comes from the number of pairs: an explicit count is not
    coalesced by AQE, whose byte-based sizing would put many small rows of
    heavy Python work into a few tasks. Sorting by the marketplace name
    inside each task lets the scorer reuse its per-name index."""
    n_tasks = _score_tasks(pairs.sparkSession, estimate)
    return (pairs.repartition(n_tasks, F.xxhash64("l_name", "r_name")).sortWithinPartitions("r_name")
            .withColumn("similarity", scorer(F.col("l_name"), F.col("r_name"))))


@dataclass(frozen=True)
class NameSearch:
    """Scored name pairs that can hold a top-K entry, and what it took."""

    scored: DataFrame        # block, l_name, r_name, similarity
    pairs_formed: int        # name pairs of all blocks
    pairs_scored: int        # of these, pairs given to the scorer (seeds included)


def search_names(listings: DataFrame, k: int, min_sim: float = C.MIN_SIMILARITY, scorer: Scorer = difflib_similarity,
                 grid: int | None = None, closed: DataFrame | None = None) -> NameSearch:
    """Name pairs that reach the `k`-th best open entry of their retailer name."""
    if scorer is edit_similarity and closed is None and grid is None:
        return _search_by_edits(listings, k, min_sim)
    left, right, estimate = _search_sides(listings, grid)
    # Entries of a marketplace name that are open to a retailer name.
    market = matchable(listings).filter(F.col("source") == C.SOURCE_MARKETPLACE)
    block = _block(F.col("category")).alias("block")
    ids = market.groupBy(block, F.col("product_name").alias("r_name")).agg(F.count(F.lit(1)).alias("n"))
    if closed is None:
        # Every marketplace name has an open entry, its first id: the names of the best k of these hold the best k entries.
        firsts = market.groupBy(block, F.col("product_name").alias("name")).agg(_first_id(F.lit(True)).alias("first_id"))
        right = right.join(firsts, ["block", "name"])
    scored, n_scored = _search_by_bound(left, right, ids, estimate, k, min_sim, scorer, closed)
    return NameSearch(scored, estimate, n_scored)


def _first_id(where: Column) -> Column:
    """The first id of a group's listings `where`, NULL where there is a null id among them."""
    return F.when(F.count_if(where & F.col("id").isNull()) == 0, F.min(F.when(where, F.col("id"))))


def _search_by_bound(left: DataFrame, right: DataFrame, ids: DataFrame, estimate: int, k: int, min_sim: float, scorer: Scorer,
                     closed: DataFrame | None) -> tuple[DataFrame, int]:
    """(block, l_name, r_name, similarity), written, of names whose letters can reach the threshold, and the pairs scored.
    `ids`: the entries `n` of every right name; `right` has `first_id` where nothing is closed."""
    close, n_close = materialize(close_pairs(left, right), "match_close")
    seeds, _ = materialize(_scored(close, scorer, n_close), "match_seeds")
    entries = close.join(ids, ["block", "r_name"])
    if closed is not None:
        gone = closed.groupBy("block", "l_name", "r_name").agg(F.count(F.lit(1)).alias("_gone"))
        entries = (entries.join(gone, ["block", "l_name", "r_name"], "left")
                   .withColumn("n", F.col("n") - F.coalesce("_gone", F.lit(0))).drop("_gone"))
    limits = thresholds(seeds, entries, k, min_sim)
    left = (left.join(limits.withColumnRenamed("l_name", "name"), ["block", "name"], "left")
            .withColumn("threshold", F.greatest(F.coalesce("threshold", F.lit(min_sim)), F.lit(min_sim))))
    # Pairs are scored where they are formed, cell by cell, and never written or sent on.
    tasks = _score_tasks(left.sparkSession, estimate, C.PAIRS_PER_CELL)
    formed = Observation(f"pairs_formed_{uuid.uuid4().hex}")
    pairs = bounded_pairs(left, right, tasks=tasks, keep=("first_id",) * (closed is None)).observe(formed, F.count(F.lit(1)).alias("pairs"))
    scored = pairs.withColumn("similarity", scorer(F.col("l_name"), F.col("r_name"))).filter(F.col("similarity") >= F.col("threshold"))
    if closed is None:
        best = Window.partitionBy("block", "l_name").orderBy(F.col("similarity").desc(), "first_id")
        scored = scored.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k)
    scored, _ = materialize(scored.select("block", "l_name", "r_name", "similarity"), "match_scored")
    return scored, n_close + int(formed.get["pairs"])


# Names listed beyond the k best: room for pairs whose keys met by chance.
SPARE = 2


def _search_by_edits(listings: DataFrame, k: int, min_sim: float) -> NameSearch:
    """`search_names` by the edit score, all entries open. Each step is for the retailer names
    that the ones before leave open:

    1. names with `k` entries of equal names (1.0, which nothing beats);
    2. names at most one edit apart, then two: what is over e edits away scores len / (len + e + 1) at most;
    3. the search by letters."""
    retail, market = (F.col("source") == s for s in (C.SOURCE_RETAILER, C.SOURCE_MARKETPLACE))
    found, _ = materialize(
        matchable(listings).filter(F.col("product_name").isNotNull()).groupBy(_block(F.col("category")).alias("block"), F.col("product_name").alias("name"))
        .agg(F.count_if(retail).alias("listings"), F.count_if(market).alias("n"), _first_id(market).alias("first_id")), "match_names")
    # Numbered by first id, so that ties are settled by number.
    names, _ = number_rows(found, ["first_id"], "nid")
    names = names.withColumn("low", F.lower("name")).withColumn("len", name_len("name"))
    equal = names.filter(F.col("n") > 0).groupBy("block", "low").agg(F.sum("n").alias("equal"))
    is_open = (F.col("listings") > 0) & (F.coalesce("equal", F.lit(0)) < k)
    names, _ = materialize(names.join(equal, ["block", "low"], "left").withColumn("open", is_open), "match_numbered")
    right = names.filter(F.col("n") > 0)
    by_block = names.groupBy("block").agg(F.count_if(F.col("listings") > 0).alias("nb"), F.count_if(F.col("n") > 0).alias("ne"),
                                          F.count_if("open").alias("nopen"))
    by_block, _ = materialize(by_block, "match_blocks")
    n_open, pairs = by_block.agg(F.sum("nopen"), F.sum(F.col("nb").cast("double") * F.col("ne"))).first()
    pairs = int(pairs or 0)

    by_nid = Window.partitionBy("block", "low").orderBy("nid")
    firsts = right.withColumn("_r", F.row_number().over(by_nid)).filter(F.col("_r") <= k).select("block", "low", F.col("name").alias("r_name"))
    done = names.filter((F.col("listings") > 0) & ~F.col("open")).select("block", "low", F.col("name").alias("l_name"))
    scored, n_scored = materialize(_with_score(done.join(firsts, ["block", "low"])), "match_equal")
    if not n_open:
        return NameSearch(scored, pairs, n_scored)

    rest, n_rest = materialize(names.filter("open").select("nid", "block", "name"), "match_open")
    for edits in range(1, E.MAX_EDITS + 1):
        rest, near, n_near = _near_names(names, rest, edits, k, min_sim)
        scored, n_scored = scored.unionByName(near), n_scored + n_near
        rest, n_rest = materialize(rest, "match_rest")
        if not n_rest:
            break
    if n_rest:
        far, n_far = _search_rest(rest, right, by_block, k, min_sim)
        scored, n_scored = scored.unionByName(far), n_scored + n_far
    return NameSearch(scored, pairs, n_scored)


def _with_score(pairs: DataFrame) -> DataFrame:
    return pairs.select("block", "l_name", "r_name", edit_similarity(F.col("l_name"), F.col("r_name")).alias("similarity"))


def _search_rest(rest: DataFrame, right: DataFrame, by_block: DataFrame, k: int, min_sim: float) -> tuple[DataFrame, int]:
    """The search for the names `rest` (block, name), which may be few and their partners many; and the pairs scored."""
    counts, _ = materialize(rest.groupBy("block").agg(F.count(F.lit(1)).alias("nrest")).join(by_block, "block"), "match_rest_blocks")
    estimate, n_right = (int(x or 0) for x in counts.agg(F.sum(F.col("nrest").cast("double") * F.col("ne")), F.sum("ne")).first())
    # As many rows and columns of cells as send on the fewest copies.
    cells = F.greatest(F.lit(1.0), F.col("nrest") * F.col("ne").cast("double") / F.lit(float(C.PAIRS_PER_CELL)))
    rows = F.greatest(F.lit(1), F.round(F.sqrt(cells * F.col("nrest") / F.greatest("ne", F.lit(1)))).cast("int"))
    cut = counts.withColumn("g", rows).withColumn("h", F.ceil(cells / F.col("g")).cast("int")).select("block", "g", "h")
    left = rest.join(cut, "block").select("block", "name", "g", "h")
    partners = right.join(cut, "block").select("block", "name", "g", "h", "first_id")
    if estimate > C.PLAIN_PAIRS_PER_NAME * n_right:
        left, _ = materialize(with_letters(left), "match_left")
        partners, _ = materialize(with_letters(partners), "match_right")
        entries = right.select("block", F.col("name").alias("r_name"), "n")
        return _search_by_bound(left, partners, entries, estimate, k, min_sim, edit_similarity, None)
    of = lambda name, side: F.pmod(F.xxhash64(name), F.col(side).cast("bigint"))
    all_of = lambda side: F.explode(F.sequence(F.lit(0), F.col(side) - 1).cast("array<bigint>"))
    tasks = _score_tasks(rest.sparkSession, estimate, C.PAIRS_PER_CELL)
    lhs = left.select("block", F.col("name").alias("l_name"), of("name", "g").alias("gr"), all_of("h").alias("gc"))
    rhs = partners.select("block", F.col("name").alias("r_name"), "first_id", of("name", "h").alias("gc"), all_of("g").alias("gr"))
    pairs = lhs.repartition(tasks, "block", "gr", "gc").join(rhs.repartition(tasks, "block", "gr", "gc"), ["block", "gr", "gc"])
    best = Window.partitionBy("block", "l_name").orderBy(F.col("similarity").desc(), "first_id")
    scored = (pairs.withColumn("similarity", edit_similarity(F.col("l_name"), F.col("r_name"))).filter(F.col("similarity") >= min_sim)
              .withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k))
    return materialize(scored.select("block", "l_name", "r_name", "similarity"), "match_scored")[0], estimate


def _near_names(names: DataFrame, rest: DataFrame, edits: int, k: int, min_sim: float) -> tuple[DataFrame, DataFrame, int]:
    """Of the names `rest` (nid, block, name) those that names at most `edits` away do not settle; scored
    pairs of the others, and how many pairs were scored. `names`: nid, block, name, low, len, n."""
    near_by = names.filter(F.col("len") <= E.MAX_LEN).join(rest.select("block").distinct(), "block", "left_semi")
    left = F.col("in_rest").isNotNull() & (F.col("len") <= E.MAX_LEN - edits)
    dealt = (near_by.join(rest.select("nid", F.lit(True).alias("in_rest")), "nid", "left").filter(left | (F.col("n") > 0))
             .select("nid", F.xxhash64("block").alias("seed"), F.col("low").alias("name"), left.alias("is_left"), (F.col("n") > 0).alias("is_right"), "len"))
    dealt, n_names = materialize(dealt, "match_dealt")
    keys = int(dealt.agg(F.sum(E.key_count(F.col("len"), edits))).first()[0] or 0)
    best = k + SPARE
    near = E.near_pairs(dealt, edits, keys, min_sim, best, _score_tasks(names.sparkSession, n_names, E.BLOCK), materialize)

    side = lambda s, *extra: names.select(F.col("nid").alias(s), F.col("block").alias(f"{s}_block"), F.col("name").alias(f"{s}_name"), *extra)
    # The scorer has the last word: keys can meet by chance, also those of a pair that is near but not as near as they say.
    score = edit_similarity(F.col("l_name"), F.col("r_name"))
    same, beyond = F.col("l_block") == F.col("r_block"), F.col("len") / (F.col("len") + edits + 1)
    sure = same & (score == F.col("similarity"))
    lost = same & (score < F.col("similarity")) & (score > beyond - SLACK)
    upto = Window.partitionBy("l").orderBy(F.col("similarity").desc(), "r").rowsBetween(Window.unboundedPreceding, 0)
    pairs = near.join(side("l", "len"), "l").join(side("r", "n"), "r").withColumn("sure", sure).withColumn("lost", lost)
    pairs, n_pairs = materialize(pairs.withColumn("names", F.count_if("sure").over(upto))
                                 .withColumn("entries", F.sum(F.when(F.col("sure"), F.col("n"))).over(upto)), "match_near_names")
    # k names hold the best k entries. Fewer do if they are all there are; a full list may lack some of the last one's score.
    within = F.col("sure") & (F.col("similarity") > beyond + SLACK)
    settled = (pairs.groupBy("l").agg(F.count_if(within & (F.col("names") >= k)).alias("by_name"),
                                      F.count_if(within & (F.col("entries") >= k)).alias("by_entry"), F.count(F.lit(1)).alias("listed"),
                                      F.count_if("lost").alias("lost"))
               .filter((F.col("lost") == 0) & ((F.col("by_name") > 0) | ((F.col("by_entry") > 0) & (F.col("listed") < best)))).select("l"))
    settled, _ = materialize(settled, "match_settled")
    kept = pairs.filter(F.col("sure") & (F.col("names") <= k)).join(settled, "l", "left_semi")
    return (rest.join(settled, F.col("nid") == F.col("l"), "left_anti"),
            kept.select(F.col("l_block").alias("block"), "l_name", "r_name", "similarity"), n_pairs)


def candidates(listings: DataFrame, existing: DataFrame | None = None, k: int = C.MAX_CANDIDATES,
               min_sim: float = C.MIN_SIMILARITY, scorer: Scorer = difflib_similarity,
               grid: int | None = None, max_pairs: int | None = None) -> DataFrame:
    """Top-`k` marketplace candidates per retailer listing (see module doc).
    With `max_pairs`, only the first pairs of the run order are returned
    (`cap_pairs`), and only as many listings are searched as that takes.

    Columns: category, bestbuy_listing_id, bestbuy_name, bestbuy_price,
    ebay_listing_id, ebay_name, ebay_price, similarity, rank.
    """
    # Each table of the search is written from shuffles of its own, which are not needed after that.
    with shuffles_dropped(listings.sparkSession):
        # The five columns of the matching, written once: they are read for the names, the ids, the stored pairs and the expansion.
        lm, _ = materialize(matchable(listings), "match_listings")
        if max_pairs is not None:
            return _first_candidates(lm, existing, k, min_sim, scorer, grid, max_pairs)
        return _all_candidates(lm, existing, k, min_sim, scorer, grid)


def _first_candidates(lm: DataFrame, existing: DataFrame | None, k: int, min_sim: float, scorer: Scorer, grid: int | None,
                      max_pairs: int) -> DataFrame:
    """The first `max_pairs` candidates: searched for the first retailer listings in
    run order, for eight times as many where they do not fill the cap."""
    retail = lm.filter(F.col("source") == C.SOURCE_RETAILER)
    market = lm.filter(F.col("source") == C.SOURCE_MARKETPLACE)
    total, n = retail.count(), max(1, max_pairs)
    while True:
        first, _ = materialize(retail.orderBy(F.col("category").asc_nulls_last(), "id").limit(n), "match_first")
        blocks = first.select(_block(F.col("category")).alias("block")).distinct()
        partners = market.withColumn("block", _block(F.col("category"))).join(blocks, "block", "left_semi").drop("block")
        found = _all_candidates(first.unionByName(partners), existing, k, min_sim, scorer, grid)
        capped, rows = materialize(cap_pairs(found, max_pairs), "match_capped")
        if rows >= max_pairs or n >= total:
            return cap_pairs(capped, max_pairs)
        n *= 8


def _all_candidates(lm: DataFrame, existing: DataFrame | None, k: int, min_sim: float, scorer: Scorer, grid: int | None) -> DataFrame:
    ex = closed = None
    K = k
    if existing is not None:
        # Stored pairs, written once: read for what is closed and for the exclusion.
        ex, _ = materialize(existing.select("ebay_listing_id", "bestbuy_listing_id").distinct(), "match_existing")
        closed, beside = closed_ids(lm, ex)
        K = k + beside
    scored = search_names(lm, K, min_sim, scorer, grid, closed).scored

    # The marketplace names' ids by place. Without stored pairs the first K
    # are enough: a partial WindowGroupLimit before the shuffle keeps a hot name cheap.
    e = lm.filter(F.col("source") == C.SOURCE_MARKETPLACE).select(
        _block(F.col("category")).alias("block"), F.col("product_name").alias("r_name"),
        F.col("id").alias("ebay_listing_id"), F.col("price").alias("ebay_price"))
    by_id = Window.partitionBy("block", "r_name").orderBy("ebay_listing_id")
    if closed is None:
        first = e.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= K).drop("place")
        cand = scored.join(first, ["block", "r_name"])
    else:
        touched = closed.select("block", "r_name").distinct()
        ranked, _ = materialize(
            e.join(touched, ["block", "r_name"], "left_anti").withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= K)
            .unionByName(e.join(touched, ["block", "r_name"], "left_semi").withColumn("place", F.row_number().over(by_id))), "match_places")
        # From the frontier on, K places and as many more as are closed among them.
        behind = scored.join(frontiers(closed, ranked), ["block", "l_name", "r_name"], "left")
        f, more = (F.coalesce(c, F.lit(0)) for c in ("frontier", "beyond"))
        places = F.explode(F.sequence(f + 1, f + K + more).cast("array<int>"))
        cand = (behind.withColumn("place", places).join(ranked, ["block", "r_name", "place"])
                .join(closed, ["block", "l_name", "r_name", "ebay_listing_id"], "left_anti").drop("place", "frontier", "beyond"))
    wb = Window.partitionBy("block", "l_name").orderBy(F.col("similarity").desc(), F.col("ebay_listing_id"))
    name_top = cand.withColumn("_r", F.row_number().over(wb)).filter(F.col("_r") <= K).drop("_r")

    # Expand to retailer listings. The per-name candidate list has at most
    # K rows per distinct retailer name: written once to the shared checkpoint
    # folder (the scorer runs once, and a lost executor does not re-score),
    # broadcast when its bytes are within Spark's threshold; in a shuffle join AQE splits a hot name.
    name_top, _ = materialize(name_top, "match_name_top")
    b = lm.filter(F.col("source") == C.SOURCE_RETAILER).select(
        "category", _block(F.col("category")).alias("block"), F.col("product_name").alias("l_name"),
        F.col("id").alias("bestbuy_listing_id"), F.col("price").alias("bestbuy_price"))
    per_listing = b.join(name_top, ["block", "l_name"])
    if ex is not None:
        per_listing = per_listing.join(ex, ["ebay_listing_id", "bestbuy_listing_id"], "left_anti")
        wl = Window.partitionBy("bestbuy_listing_id").orderBy(F.col("similarity").desc(), F.col("ebay_listing_id"))
        top = per_listing.withColumn("rank", F.row_number().over(wl)).filter(F.col("rank") <= k)
    else:
        # Every listing of a name has the name's list, in its order: the rank is known by name.
        wn = Window.partitionBy("block", "l_name").orderBy(F.col("similarity").desc(), F.col("ebay_listing_id"))
        top = b.join(name_top.withColumn("rank", F.row_number().over(wn)), ["block", "l_name"])
    return top.select("category", "bestbuy_listing_id", F.col("l_name").alias("bestbuy_name"), "bestbuy_price", "ebay_listing_id",
                      F.col("r_name").alias("ebay_name"), "ebay_price", "similarity", F.col("rank").cast("bigint").alias("rank"))


def cap_pairs(cands: DataFrame, max_pairs: int = C.MAX_PAIRS_PER_RUN) -> DataFrame:
    """The first `max_pairs` candidates in run order: category (NULL last),
    retailer listing id, rank. The cap is the per-run scoring budget."""
    return (cands.orderBy(F.col("category").asc_nulls_last(), F.col("bestbuy_listing_id"), F.col("rank"))
                 .limit(max_pairs))


def to_pairs(cands: DataFrame) -> DataFrame:
    """Candidate rows as scorer input pairs."""
    return cands.select("ebay_listing_id", "bestbuy_listing_id",
                        F.col("ebay_name").alias("ebay_title"), F.col("bestbuy_name").alias("bestbuy_title"),
                        "ebay_price", "bestbuy_price", "category")
