"""Mixing sources to target weights by Pareto order sampling.

A source's share of the mix follows its weight, up to ``most`` times its own words; what a source
can't give goes to the others by weight. A source that is to give ``rate`` times its words gives
``floor(rate)`` whole copies of each document for certain. The rest is a sample of fixed size: with
inclusion probability p (the rate's fraction) and a random u of the document, documents are ranked
by their random odds over their inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in this
order until the source's words are reached, as near as whole documents allow.

The cut of a source is found without ordering its documents in one task: words are summed by rank
bucket, sums run over the buckets, and only the bucket that holds the cut is ordered by document.
The decision is then a comparison in each row. The list of sources (not their documents) is
ordered in one task to deal out weights.

Defined cases: a null text has 0 words and takes 0; a null source is a source of its own, the last
in order; documents of equal rank are ordered by doc_id (null first) and text, and rows that
repeat in all of these are taken together; an empty table gives an empty mix; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .packed import ready, stored

WEIGHTS = (5, 2, 1)
MOST = 3
HALF_BUCKETS = 8192  # rank buckets below and above even odds
WORD = r"[^\x20\x09-\x0D]+"
_SCALE = float(2**52)


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(seed: str) -> Column:
    """A number between 0 and 1 that depends on seed and doc_id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(_SCALE)


def _size_columns(seed: str) -> list[Column]:
    return [
        F.col("doc_id").alias("m_doc"), F.col("source").cast("string").alias("m_source"), words().alias("m_size"),
        uniform(seed).alias("m_u"), F.xxhash64("text").alias("m_text"),
    ]


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds m_target to one row a source (m_source, m_total)."""
    order = W.orderBy(F.col("m_source").asc_nulls_last())
    listed = totals.withColumn("m_i", (F.row_number().over(order) - 1) % len(weights))
    listed = listed.withColumn("m_weight", F.element_at(F.array(*map(F.lit, weights)), F.col("m_i") + 1).cast("bigint"))
    listed = listed.withColumn("m_cap", F.col("m_total") * most).withColumn("m_fill", F.col("m_cap") / F.col("m_weight"))
    # Sources fill up in the order of cap over weight; the level is where the first one doesn't.
    filling = W.orderBy("m_fill", F.col("m_source").asc_nulls_last())
    before, on = filling.rowsBetween(W.unboundedPreceding, -1), filling.rowsBetween(0, W.unboundedFollowing)
    everything = filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("m_total").over(everything) - F.coalesce(F.sum("m_cap").over(before), F.lit(0))
    listed = listed.withColumn("m_level", left / F.sum("m_weight").over(on))
    level = F.min(F.when(F.col("m_level") <= F.col("m_fill"), F.struct("m_fill", "m_level"))).over(everything)["m_level"]
    target = F.least(F.col("m_cap").cast("double"), level * F.col("m_weight"))
    return listed.select("m_source", "m_total", target.alias("m_target"))


def _rates(targets: DataFrame) -> DataFrame:
    rate = F.when(F.col("m_total") > 0, F.col("m_target") / F.col("m_total")).otherwise(F.lit(0.0))
    rated = targets.withColumn("m_rate", rate).withColumn("m_whole", F.floor("m_rate"))
    return rated.withColumn("m_p", F.col("m_rate") - F.col("m_whole")).withColumn(
        "m_rest", F.col("m_target") - F.col("m_whole") * F.col("m_total")
    )


def _ranked(sized: DataFrame, rates: DataFrame) -> DataFrame:
    named = rates.withColumnRenamed("m_source", "r_source")
    joined = sized.join(named, F.col("m_source").eqNullSafe(F.col("r_source")), "left").drop("r_source")
    odds = F.col("m_u") / (F.lit(1.0) - F.col("m_u"))
    rank = F.when(F.col("m_p") > 0, odds * ((F.lit(1.0) - F.col("m_p")) / F.col("m_p")))
    low = F.floor(F.col("m_rank") * HALF_BUCKETS)
    high = 2 * HALF_BUCKETS - F.floor(F.lit(float(HALF_BUCKETS)) / F.col("m_rank"))
    return joined.withColumn("m_rank", rank).withColumn("m_bucket", F.when(F.col("m_rank") <= 1, low).otherwise(high))


def _place() -> Column:
    return F.struct("m_rank", "m_doc", "m_text")


def _cuts(ranked: DataFrame, rates: DataFrame) -> DataFrame:
    """The rates and, for each source that takes a part of its documents, the place of the last one taken."""
    some = ranked.filter("m_rank IS NOT NULL")
    sums = some.groupBy("m_source", "m_bucket").agg(
        F.sum("m_size").alias("m_in"), F.first("m_rest").alias("m_rest"), F.max(_place()).alias("m_last")
    )
    running = W.partitionBy("m_source").orderBy("m_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("m_before", F.coalesce(F.sum("m_in").over(running), F.lit(0)))
    # A bucket that ends within the rest is taken whole; the next one holds the cut.
    whole = sums.filter("m_before + m_in <= m_rest").groupBy("m_source").agg(F.max("m_last").alias("m_cut"))
    split = sums.filter("m_before <= m_rest AND m_before + m_in > m_rest")
    split = split.select(F.col("m_source").alias("c_source"), F.col("m_bucket").alias("c_bucket"), "m_before")
    same = F.col("m_source").eqNullSafe(F.col("c_source")) & (F.col("m_bucket") == F.col("c_bucket"))
    one = some.join(split, same)
    within = W.partitionBy("m_source").orderBy("m_rank", "m_doc", "m_text").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("m_before") + F.coalesce(F.sum("m_size").over(within), F.lit(0)) + F.col("m_size") / 2
    taken = one.withColumn("m_middle", middle).filter("m_middle <= m_rest").groupBy("m_source").agg(F.max(_place()).alias("m_cut"))
    cuts = whole.unionByName(taken).groupBy(F.col("m_source").alias("c_source")).agg(F.max("m_cut").alias("m_cut"))
    return rates.join(cuts, F.col("m_source").eqNullSafe(F.col("c_source")), "left").drop("c_source")


def _decided(ranked: DataFrame) -> DataFrame:
    extra = F.when(F.col("m_rank").isNotNull() & F.col("m_cut").isNotNull() & (_place() <= F.col("m_cut")), 1).otherwise(0)
    return ranked.withColumn("m_copies", F.coalesce(F.col("m_whole"), F.lit(0)) + extra)


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix"):
    """Sizes and ranks of all documents, and the rates and cuts of their sources."""
    ready(docs.sparkSession)
    sized = stored(docs.select(*_size_columns(seed)), "mix-sizes")
    rates = _rates(source_targets(sized.groupBy("m_source").agg(F.sum("m_size").alias("m_total")), weights, most))
    rates = stored(rates, "mix-rates")
    return sized, stored(_cuts(_ranked(sized, rates), rates), "mix-cuts")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken (words, repeats counted), copies, source."""
    sized, cuts = plan_mix(docs, **options)
    return _decided(_ranked(sized, cuts)).select(
        F.col("m_doc").alias("doc_id"), F.col("m_size").alias("size"), F.col("m_total").alias("source_size"),
        F.col("m_target").alias("target"), (F.col("m_size") * F.col("m_copies")).cast("bigint").alias("taken"),
        F.col("m_copies").alias("copies"), F.col("m_source").alias("source"),
    )


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, cuts = plan_mix(docs, seed=seed, **options)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("m_row")
    named = docs.select(row, *_size_columns(seed))
    chosen = _decided(_ranked(named, cuts)).filter("m_copies > 0")
    return chosen.withColumn("m_copy", F.explode(F.sequence(F.lit(1), F.col("m_copies").cast("int")))).select("m_row.*")
