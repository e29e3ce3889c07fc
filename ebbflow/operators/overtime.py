"""M7 by the rule: the waybill that takes a driver over the limit.

Every waybill opens a period of ``window_hours``; work started inside it is clipped at its end.  In a period with more
than ``limit_hours`` of work the violating waybill is the first one (by start, then id) with which the
work cumulated since the period's start passes the limit.  It is dated by its own start.

The search needs no self join.  The running total of work ``P`` grows along a driver's waybills, so the waybill that
passes the limit of a period opened by ``s`` is the first one whose ``P`` exceeds ``P(before s) + limit``: periods
and waybills are merged in the order of these values, and each period takes the next waybill, within
buckets of the value and from the head of the next bucket (as in :mod:`ebbflow.operators.windows`, so that a hot
driver is spread).

Clipping changes the answer only where a waybill up to the one found lasts beyond the period's end, which is impossible
if the found one starts at least the driver's longest duration before it.  The other periods are settled by a join
on (driver, day) with the waybills inside them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions.expr import epoch_micros
from ebbflow.operators.intervals import rolling_clipped_sum
from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS, running_sums

HOUR_US = 3_600_000_000


def first_over_limit(shifts: DataFrame, driver: str = "driver_pers_num", ident: str = "waybill_id", start: str = "work_start_dt",
                     end: str = "work_end_dt", limit_hours: int = 8, window_hours: int = 24,
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``driver, period_start, worked_us`` of the periods over the limit, with ``waybill`` and ``waybill_start`` of the
    violating waybill.  Waybills without a driver, start or end, or that end before they start, are left out."""
    limit, window = limit_hours * HOUR_US, window_hours * HOUR_US
    s = shifts.select(F.col(driver).alias("driver"), F.col(ident).alias("waybill"), F.col(start).alias("st"), F.col(end).alias("en")) \
        .filter(F.col("driver").isNotNull() & (F.col("en") >= F.col("st")))
    over = rolling_clipped_sum(s, ["driver"], "st", "en", "waybill", window, bucket_seconds=bucket_seconds) \
        .filter(F.col("worked_us") > limit)
    s = s.withColumn("us", epoch_micros("en") - epoch_micros("st"))
    total = running_sums(s, ["driver"], ["st", "waybill"], {"p": F.col("us")}, bucket_seconds=bucket_seconds)
    longest = s.groupBy("driver").agg(F.max("us").alias("longest_us"))

    # one list per driver in the order of the running total; of equal values waybills come first: they do not exceed it
    events = total.select("driver", F.col("p").alias("value"), F.lit(0).alias("kind"), F.struct("st", "waybill", "p").alias("e"),
                          F.lit(None).cast(total.schema["waybill"].dataType).alias("opened_by"))
    # a period holds every waybill that starts with the one that opens it
    before = over.join(total.groupBy("driver", "st").agg(F.min(F.col("p") - F.col("us")).alias("before")), ["driver", "st"])
    asks = before.select("driver", (F.col("before") + limit).alias("value"), F.lit(1).alias("kind"),
                         F.lit(None).cast(events.schema["e"].dataType).alias("e"), F.col("waybill").alias("opened_by"))
    listed = events.unionByName(asks).withColumn("b", F.floor(F.col("value") / F.lit(8 * limit)).cast("long"))
    # read backwards, so that the frame grows row by row
    order = [F.desc("value"), F.desc("kind"), F.desc("e.st"), F.desc("e.waybill")]
    ahead = Window.partitionBy("driver", "b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    heads = listed.groupBy("driver", "b").agg(F.min(F.when(F.col("kind") == 0, F.struct("value", "e"))).alias("head"))
    later = Window.partitionBy("driver").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("driver", "b", F.last("head.e", ignorenulls=True).over(later).alias("next_head"))
    found = listed.withColumn("inside", F.last("e", ignorenulls=True).over(ahead)).filter("kind = 1") \
        .join(heads, ["driver", "b"]).select("driver", "opened_by", F.coalesce("inside", "next_head").alias("hit"))

    periods = over.withColumnRenamed("waybill", "opened_by").join(found, ["driver", "opened_by"]).join(longest, "driver") \
        .select("driver", "opened_by", F.col("st").alias("period_start"), "worked_us", "hit",
                (epoch_micros("hit.st") + F.col("longest_us") <= epoch_micros("st") + window).alias("sure"))
    sure = periods.filter("sure").select("driver", "opened_by", "period_start", "worked_us", F.col("hit.waybill").alias("waybill"),
                                         F.col("hit.st").alias("waybill_start"))
    return sure.unionByName(_settle(periods.filter("NOT sure"), s, limit, window))


def _settle(periods: DataFrame, shifts: DataFrame, limit: int, window: int) -> DataFrame:
    """The first waybill over the limit of each period, with every waybill clipped at the period's end."""
    close = F.timestamp_micros(epoch_micros("period_start") + window).cast("timestamp_ntz")
    p = periods.select("driver", "opened_by", "period_start", "worked_us", close.alias("close"))
    p = p.withColumn("day", F.explode(F.sequence(F.to_date("period_start"), F.to_date("close"))))
    inside = p.join(shifts.withColumn("day", F.to_date("st")), ["driver", "day"]) \
        .filter((F.col("st") >= F.col("period_start")) & (F.col("st") <= F.col("close"))) \
        .withColumn("part", epoch_micros(F.least("en", "close")) - epoch_micros("st"))
    # waybills with the opening one's start but a smaller id precede it in the list and still count for the period
    by = Window.partitionBy("driver", "opened_by").orderBy("st", "waybill").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = inside.withColumn("so_far", F.sum("part").over(by)).filter(F.col("so_far") > limit)
    return over.groupBy("driver", "opened_by", "period_start", "worked_us") \
        .agg(F.min(F.struct("st", "waybill")).alias("w")) \
        .select("driver", "opened_by", "period_start", "worked_us", F.col("w.waybill").alias("waybill"), F.col("w.st").alias("waybill_start"))
