"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]: ``target * (1 + a * (2t - 1))`` per unit of
time, so its integral up to t is ``target * (t + a * (t*t - t))`` and reaches the target at t = 1. The words of a
source form one line: its documents in the order of ``md5(doc_id)``, walked again (up to ``cap`` times) when the
target asks for more than there is. Inverting the integral turns a document's place on that line into its
training position; documents are finally range-sorted by position.

Places on the line are prefix sums. They are computed in two levels, (source, leading md5 digits) and within
those. The number of digits follows the number of rows, so that a group holds about BUCKET_ROWS of them even if one
source has them all; it never changes a place.

Edge cases: a null text has size 0; the null source is a source of its own, last in order; a row without doc_id is dealt by
its text instead; documents of size 0 are kept with ``taken`` 0 and no position; equal rows get neighbouring places; an
empty table gives no rows; very long texts are rows as any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fathomline.llm.common import WORD, staged, text_or_empty

#: Rows of a group aimed at, and its hexadecimal digits at most: 16 ** MOST_DIGITS sums of a source are added up in one task.
BUCKET_ROWS, MOST_DIGITS = 500, 5


def bucket_digits(rows: int) -> int:
    """How many leading digits deal ``rows`` rows into groups of about BUCKET_ROWS, or MOST_DIGITS."""
    return next((d for d in range(1, MOST_DIGITS) if rows <= BUCKET_ROWS * 16**d), MOST_DIGITS)


def word_count(name: str = "text"):
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int, slopes: tuple[float, ...]) -> DataFrame:
    """One row per source: size, target by capped proportional shares, slope of its schedule.

    The table has a row per source only; ranking the sources needs them in one place.
    Shares are found by sorting on cap / weight: sources are capped one after the other until
    the level (what is left over the weights that are left) lies below the next cap.
    """
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("rank") % len(xs) + 1).cast("int"))
    src = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    src = src.select("*", pick(weights).alias("weight"), pick(slopes).cast("double").alias("slope"), (F.col("source_size") * cap).alias("most"))
    order = W.orderBy((F.col("most") / F.col("weight")).asc(), F.col("rank").asc())
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    src = src.select(
        "*",
        F.row_number().over(order).alias("ord"),
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
            / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
        ).alias("level"),
    )
    capped = F.col("most") / F.col("weight") <= F.col("level")
    src = src.withColumn("final", F.min_by("level", F.when(~capped, F.col("ord"))).over(everything))
    target = F.when(capped, F.col("most").cast("double")).otherwise(F.col("final") * F.col("weight"))
    return src.select("skey", "source_size", "slope", target.alias("target"), F.floor(target + 0.5).alias("goal"))


def mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, slopes=(-0.5, 0.0, 0.5), carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, position, and of each of ``cap`` passes its words
    (``passes``) and position (``places``).

    ``carry`` names further columns of ``docs`` to keep (they travel through one shuffle).
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.md5(text_or_empty().cast("binary"))).cast("binary"))
    skey = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    extra = [F.col(c).alias(f"carry_{c}") for c in carry]
    slim = docs.select("doc_id", "source", skey.alias("skey"), word_count().alias("size"), digest.alias("key"), *extra)
    slim = staged(slim, "mix-sizes")
    slim = slim.withColumn("bucket", F.substring("key", 1, bucket_digits(slim.count())))
    src = staged(source_targets(slim, weights, cap, slopes), "mix-sources")

    sums = slim.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("skey").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("skey", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")).join(F.broadcast(src) if src.count() < 10_000 else src, "skey")
    inner = W.partitionBy("skey", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    # Sums of a bucket first: both sides of this join are dealt by (skey, bucket), as the window needs.
    placed = slim.join(sums, ["skey", "bucket"]).withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(inner), F.lit(0)))

    def words(p: int):  # of pass p: the part of [p * source_size + start, + size) that lies before the goal
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("goal") - p * F.col("source_size") - F.col("start")))

    def place(p: int):  # the inverse of the schedule's integral at the pass's first word
        u, a = (F.col("start") + p * F.col("source_size")) / F.col("goal"), F.col("slope")
        return F.when(words(p) > 0, F.round(2 * u / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u)), 9))

    taken = sum((words(p) for p in range(1, cap)), words(0))
    return placed.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), place(0).alias("position"),
        F.array(*[words(p) for p in range(cap)]).alias("passes"), F.array(*[place(p) for p in range(cap)]).alias("places"), *[F.col(f"carry_{c}") for c in carry],
    )


def mixed(docs: DataFrame, columns: tuple[str, ...], **how) -> DataFrame:
    """The mix itself: a row for each pass of each document it takes, whole columns carried, in training order.

    A pass that ends inside a document has its first words; documents without words are in no pass.
    """
    carry = tuple(c for c in columns if c != "doc_id")
    rows = mix(docs, carry=carry, **how)
    rows = rows.select("doc_id", "size", *[F.col(f"carry_{c}").alias(c) for c in carry], F.explode(F.arrays_zip("passes", "places")).alias("mix_pass")).where("mix_pass.passes > 0")
    start = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1), F.lit(1), F.col("mix_pass.passes").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("mix_pass.passes") == F.col("size"), F.col("text")).otherwise(start))
    return rows.orderBy("mix_pass.places", "doc_id").select(*columns)


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(F.col("position").asc_nulls_last(), "doc_id")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, rank % 3 + 1 AS weight, CAST(rank % 3 - 1 AS DOUBLE) * 0.5 AS slope, 3 * source_size AS most FROM s
), l AS (
  SELECT *, row_number() OVER o AS ord, CAST(most AS DOUBLE) / weight AS ratio,
         CAST((SELECT sum(source_size) FROM s) - coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / weight, rank)
), t AS (
  SELECT *, CASE WHEN ratio <= level THEN CAST(most AS DOUBLE)
                 ELSE (SELECT arg_min(level, ord) FROM l WHERE ratio > level) * weight END AS target FROM l
), p AS (
  SELECT d.doc_id, size, source_size, slope, target, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - source_size - start))
          + greatest(0, least(size, goal - 2 * source_size - start)) AS taken,
         CASE WHEN goal > 0 THEN CAST(start AS DOUBLE) / goal END AS u FROM p
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(2 * u / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)), 9) END AS position
FROM q
"""
