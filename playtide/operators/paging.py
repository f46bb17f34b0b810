"""Whether the pages of a list cover it: gaps, overlaps and repeated pages.

A page covers the positions from its offset on, as many as it has items. Pages are reduced to
different intervals with a count before they are shuffled; an interval then opens at its start and
closes behind its end, and a running sum of openings says how often each stretch is covered. No
list of positions is made, neither per album nor at all.

Defined results: a null offset is 0; a page without items covers nothing but counts as a
repeat if it comes again. The length of a list is the largest total that one of its pages states,
and without any, the last covered position, so that only inner gaps show. Pages beyond the stated length
are not gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_gaps(pages: DataFrame, by: str = "album_id", offset: str = "offset", items: str = "items",
              total: str = "total") -> DataFrame:
    """``by, kind, start, stop, copies``: what is wrong with the pages of each list.

    ``gap``: positions on no page (copies 0); ``overlap``: positions on ``copies`` different pages, two or more;
    ``repeat``: a page that came ``copies`` times. ``stop`` is exclusive.
    """
    size = F.coalesce(F.array_size(F.col(items)), F.lit(0)).cast("bigint")
    start = F.coalesce(F.col(offset), F.lit(0)).cast("bigint")
    known = pages.where(F.col(by).isNotNull()).groupBy(by, start.alias("start"), size.alias("size")).agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.col(total).cast("bigint")).alias("total"))
    stop = F.col("start") + F.col("size")
    repeats = known.where("copies > 1").select(by, F.lit("repeat").alias("kind"), "start", stop.alias("stop"), "copies")

    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # The list's own ends, without an opening, so that stretches before the first and behind the last page exist.
    marks = known.select(by, "total", F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.when(F.col("size") > 0, one).otherwise(zero).alias("opens")),
        F.struct(stop.alias("at"), F.when(F.col("size") > 0, -one).otherwise(zero).alias("opens")),
        F.struct(zero.alias("at"), zero.alias("opens")),
        F.struct(F.col("total").alias("at"), zero.alias("opens")))).alias("mark"))
    points = marks.where("mark.at is not null").groupBy(by, "mark.at").agg(F.sum("mark.opens").alias("opens"))
    ends = known.groupBy(by).agg(F.coalesce(F.max("total"), F.max(stop)).alias("length"))
    along = W.partitionBy(by).orderBy("at")
    stretches = (points.withColumn("covered", F.sum("opens").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
                 .withColumn("stop", F.lead("at").over(along)).where("stop is not null")
                 .join(ends, by).withColumn("stop", F.when(F.col("covered") == 0, F.least("stop", "length")).otherwise(F.col("stop")))
                 .where("(covered = 0 or covered > 1) and at < stop"))
    # Neighbouring stretches of one cover are one.
    begins = F.when((F.lag("stop").over(along) == F.col("at")) & (F.lag("covered").over(along) == F.col("covered")), 0).otherwise(1)
    whole = (stretches.withColumn("begins", begins)
             .withColumn("run", F.sum("begins").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
             .groupBy(by, "run").agg(F.min("at").alias("start"), F.max("stop").alias("stop"), F.max("covered").alias("copies")))
    kind = F.when(F.col("copies") == 0, F.lit("gap")).otherwise(F.lit("overlap"))
    return whole.select(by, kind.alias("kind"), "start", "stop", "copies").unionByName(repeats)
