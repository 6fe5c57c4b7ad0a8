"""Mixing sources to target weights by Pareto order sampling.

Targets. The sources, by code point with null last, weigh 3, 1, 2 and so on, and share `share` of all words. No
source gives more than `most` times its words; what is left is shared again by weight among the others.
With r = most * size / weight in rising order, the level is
(total - limits of the sources before) / (weights from here on) at the first source where it doesn't
exceed r, and a target is the smaller of limit and level * weight.

Sampling. A document is wanted `copies` times. Whole copies are certain. For the rest, with inclusion
probability p, it gets a random number u from its identifier, and the rank u / (1 - u) : p / (1 - p). Along
the ranks documents are taken while the half of each still fits into the words that are left to
take, so a sample is fixed in size but for half a document. Reruns agree.

Cases. A null text has no words and is taken 0 words. Ties in rank go by identifier, then size; equal rows are
interchangeable. A text of any length is counted whole. Null sources are one source. A source without words has target 0. Empty table: no rows.
`mixed` reads only the columns named.

Plan. Ranks fall into bins by their logarithm, 512 to a unit. It is logistic for each p, its density at most 1/4, so about
1/2048 of a source's rows or fewer share a bin, whatever p is. Rows without a rank are spread over `BINS` bins of their own,
which add no words. Words before a bin are sums over the bins of a source, words within it a window by source and bin, so
no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import load, text_of, words_in

WEIGHTS, SHARE, MOST, BINS, UNIT, SEED = (3, 1, 2), 1.5, 2, 4096, 512, "mix"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, place, source_size and target from one row of source and source_size for each source."""
    ordered = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    limited = ordered.withColumns({"weight": weight, "cap": F.col("source_size") * most})
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = limited.withColumn("level", (F.lit(share) * F.sum("source_size").over(everything) - before) / after)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select(
        "source", "place", "source_size",
        F.coalesce(F.least(F.col("cap").cast("double"), level * F.col("weight")), F.col("cap").cast("double")).alias("target"),
    )


def uniform(key: Column, seed: str) -> Column:
    """A number above 0 and below 1 that the key fixes."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":" + seed))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(2**52)


def sampled(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """Whole copies `times` of each row; rows has doc_id, size, place (the group) and copies, 0 or more.

    The copies may differ within a group.
    """
    whole, odds = F.floor("copies").cast("bigint"), F.col("p") / (1 - F.col("p"))
    u = uniform(F.col("doc_id"), seed)
    ranked = (
        rows.withColumn("whole", whole).withColumn("p", F.col("copies") - F.col("whole"))
        .withColumn("rank", F.when(F.col("p") > 0, (u / (1 - u)) / odds))
        .withColumn("bin", F.when(F.col("rank").isNotNull(), F.floor(F.log("rank") * UNIT)).otherwise(F.pmod(F.xxhash64("doc_id", "size"), F.lit(BINS))))
        .withColumn("words", F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0))
        .withColumn("wanted", F.round(F.col("p") * F.col("size") * 1e6).cast("bigint"))
    )
    bins = ranked.groupBy("place", "bin").agg(F.sum("words").alias("words"), F.sum("wanted").alias("wanted"))
    group = Window.partitionBy("place").orderBy("bin")
    starts = bins.select(
        "place", "bin",
        F.coalesce(F.sum("words").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.sum("wanted").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("room"),
    )
    inside = Window.partitionBy("place", "bin").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    twice = 2 * (F.col("start") + F.coalesce(F.sum("words").over(inside), F.lit(0))) + F.col("size")
    return (
        ranked.drop("wanted").join(starts, ["place", "bin"])
        .withColumn("extra", F.col("rank").isNotNull() & (twice * 500_000 <= F.col("room")))
        .withColumn("times", F.col("whole") + F.col("extra").cast("bigint")).drop("words")
    )


def mixed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every row."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), words_in(text_of(text_column)).alias("size")
    )
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    wanted = (
        rows.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    )
    return sampled(wanted).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(load(spark, folder, "documents"))


SQL = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes),
limited AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * {MOST} AS cap FROM placed),
levels AS (
  SELECT *, cap::DOUBLE / weight AS r,
         ({SHARE}::DOUBLE * sum(source_size) OVER ()::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM limited),
aims AS (
  SELECT source, place, source_size,
         least(cap::DOUBLE, coalesce((SELECT level FROM levels WHERE level <= r ORDER BY r, place LIMIT 1) * weight, cap)) AS target
  FROM levels),
wanted AS (
  SELECT docs.doc_id, docs.size, aims.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS copies,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{SEED}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE AS u
  FROM docs JOIN aims ON docs.source IS NOT DISTINCT FROM aims.source),
odds AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p FROM wanted),
ranks AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank, round(p * size * 1e6)::BIGINT AS want FROM odds),
runs AS (
  SELECT *, sum(want) OVER (PARTITION BY place) AS room,
         coalesce(sum(size) OVER (PARTITION BY place ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM ranks)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rank IS NOT NULL AND (2 * start + size) * 500000 <= room THEN 1 ELSE 0 END))::BIGINT AS taken
FROM runs
"""

QUERIES = {"op5_mixing": op5_mixing}
ORACLE_SQL = {"op5_mixing": SQL}
