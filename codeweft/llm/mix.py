"""Mix sources to target weights by hash-threshold histograms.

A document is taken a whole number of times, once more if its hash lies at or below
its source's threshold. Thresholds come from sums of words by source and leading
bits of the hash: the bucket in which the budget runs out is found from running sums
over at most 4096 buckets, and only its documents are summed again, by the next
bits. Nothing is sorted by hash; as budgets grow, the documents taken are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeweft.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
_BITS = 12
_LEVELS = 5  # 60 bits in all
_FEW = 10_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_key(doc_id: str = "doc_id") -> Column:
    """60 bits by which a document is above or below a threshold; same in every run."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target``. ``sources`` has a row per source, and only
    such rows meet in the windows here."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    ranked = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    behind, ahead = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    # Sources that fill up first give what they can't take to the rest.
    ranked = ranked.withColumn(
        "level",
        (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("cap").over(behind), F.lit(0.0)))
        / F.sum("weight").over(ahead),
    )
    level = ranked.where("level <= ratio").agg(F.min_by("level", F.struct("ratio", F.col("source").isNull(), "source")).alias("found"))
    return ranked.crossJoin(F.broadcast(level)).select(  # one row
        "source", "source_size", F.coalesce(F.least("cap", F.col("found") * F.col("weight")), "cap").alias("target")
    )


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target, copies, last``: documents of a source are
    taken ``copies`` times, and once more where their key is at most ``last``."""
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = keep(goals.withColumn("copies", whole.cast("bigint")), "goals")
    open_ = goals.where("source_size > 0").select(
        "source", F.lit(0).cast("bigint").alias("prefix"), (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget")
    )
    found = None
    for level in range(1, _LEVELS + 1):
        shift = _BITS * (_LEVELS - level)
        rows = sized.select("source", "size", "key", F.shiftright("key", shift).alias("bucket"))
        sums = rows.join(_small(open_), rows["source"].eqNullSafe(open_["source"]) & (F.shiftright(rows["bucket"], _BITS) == open_["prefix"]))
        sums = sums.groupBy(rows["source"], "bucket", "budget").agg(
            F.sum("size").alias("words"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("end", running).withColumn("begin", F.col("end") - F.col("words"))
        edge = keep(sums.where("begin <= budget AND budget < end").select(
            "source", F.col("bucket").alias("prefix"), (F.col("budget") - F.col("begin")).alias("budget"), "words", "low", "high"
        ), "edge")
        done = edge.where("low = high").select(
            "source", F.when(2 * F.col("budget") > F.col("words"), F.col("low")).otherwise(F.col("low") - 1).alias("last")
        )
        found = done if found is None else found.union(done)
        open_ = edge.where("low < high").select("source", "prefix", "budget")
        if open_.isEmpty():
            break
    found = found.withColumnRenamed("source", "own")
    return keep(
        goals.join(found, goals["source"].eqNullSafe(found["own"]), "left")
        .select("source", "source_size", "target", "copies", F.coalesce("last", F.lit(-1).cast("bigint")).alias("last")),
        "thresholds",
    )


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table of one row per source, if it is small indeed; else Spark
    joins as it sees fit, and splits hot sources."""
    return F.broadcast(df) if len(df.select(F.lit(1)).take(_FEW + 1)) <= _FEW else df


def with_copies(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """``docs`` with ``source_size, target, copies``; they need ``key`` and ``source``."""
    limits = limits.withColumnRenamed("source", "own").withColumnRenamed("copies", "whole")
    out = docs.join(_small(limits), docs["source"].eqNullSafe(limits["own"]))
    return out.withColumn("copies", F.col("whole") + (F.col("key") <= F.col("last")).cast("bigint")).drop("own", "whole", "last")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row.

    Sizes are words; null and empty texts have none and are taken at no cost. A null
    source is the last one. Rows with the same id, and a null id as if it were empty,
    share a hash: they go above or below a threshold together. Where the budget
    ends inside such a group, it is taken if that brings the source nearer to its
    target. No rows: no rows. Other columns are not read.
    """
    sized = keep(docs.select("doc_id", "source", word_count().alias("size"), mix_key().alias("key")), "sized")
    out = with_copies(sized, thresholds(sized))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    names = docs.columns
    sized = keep(docs.select("source", word_count().alias("size"), mix_key().alias("key")), "sized")
    rows = docs.select(F.struct(*names).alias("row"), "source", mix_key().alias("key"))
    taken = with_copies(rows, thresholds(sized)).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth")).select("row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT *, row_number() OVER w AS pos,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM filled WINDOW w AS (ORDER BY ratio, source NULLS LAST)),
goals AS (
  SELECT source, source_size,
         coalesce(least(cap, (SELECT min_by(level, pos) FROM levels WHERE level <= ratio) * weight), cap) AS target
  FROM levels),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM goals),
placed AS (
  SELECT s.*, g.source_size, g.target, CAST(g.copies AS BIGINT) AS copies, g.target - g.copies * g.source_size AS budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY key) AS ends,
         sum(size) OVER (PARTITION BY s.source, key) AS own
  FROM sized s JOIN wholes g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (copies + CASE WHEN ends <= budget OR (ends - own <= budget AND 2 * (budget - (ends - own)) > own)
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""
