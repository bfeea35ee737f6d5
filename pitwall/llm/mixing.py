"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Within a source, documents are taken in key order until the source's
budget of words is used up; budgets over the source's size repeat it (epochs). The order's prefix sums are
two-level: sizes are summed per (source, key range), the offsets of the ranges are prefix sums over that small
table, and rows are only ordered within their range of about ``range_rows`` rows. So a source with a third of
all rows is spread over as many tasks as its share.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; null ids share one
key; equal keys are ordered by id and size; repeated rows count each; an empty table gives an empty result; texts of any
length are counted whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """(source, source_size) -> the same with ``target``: ``share`` of all sizes dealt by weight, at most ``epochs`` times a size.

    Sources fill up in the order of cap over weight: a source is at its cap when the level that the rest of the
    budget allows for it and all later ones reaches its cap. One row per source meets in the window.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_source) - 1) % len(weights)
    ranked = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int")).cast("long").alias("weight"),
        (F.lit(float(share)) * F.sum("source_size").over(whole)).alias("budget"),
        (F.lit(int(epochs)) * F.col("source_size")).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    filled = ranked.withColumn(
        "full", F.col("cap") * F.sum("weight").over(after)
        <= (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) * F.col("weight"))
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    shares = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    return filled.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(rest * F.col("weight") / F.when(shares > 0, shares)).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, epochs: int = 2,
        range_rows: int = 4096) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words that the mix takes, repeats counted) of every document.

    A source's taken words are exactly the whole part of its target: the document at the cut gives only its
    first words. Weights go to sources in code point order, null last, and repeat.
    """
    sized = checkpointed(docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key")))
    ranges = max(1, -(-sized.count() // range_rows))
    place = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    sized = sized.withColumn("part", F.floor(place * F.lit(float(ranges))).cast("long"))
    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, epochs)
    goals = goals.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long").alias("rounds"))
    goals = goals.withColumn("rest", F.floor("target") - F.col("rounds") * F.col("source_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("source"), "part", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("part_start"))
    starts = starts.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumnsRenamed({"source": "_source", "part": "_part"})
    rows = sized.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
    inner = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("part_start") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("rounds") * F.col("size") + last).cast("long").alias("taken"))


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1 to 150 % of all words, no source above two epochs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, 2 * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources),
filled AS (
  SELECT *, (cap * sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
            <= (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) * weight AS is_full
  FROM ranked),
goals AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE
              ELSE (budget - (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::DOUBLE) * weight
                   / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM filled),
cuts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END::BIGINT AS rounds FROM goals),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized)
SELECT p.doc_id, p.size, c.source_size, c.target,
       (c.rounds * p.size + greatest(0, least(p.size, floor(c.target)::BIGINT - c.rounds * c.source_size - p.start)))::BIGINT AS taken
FROM placed p JOIN cuts c ON p.source IS NOT DISTINCT FROM c.source
"""
