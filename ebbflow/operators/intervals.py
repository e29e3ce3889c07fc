"""Interval workloads without self joins.

:func:`rolling_clipped_sum` answers, for every interval ``s`` of a key,

    G(s) = sum over intervals t of the key with s.start <= t.start <= s.start + W
           of (min(t.end, s.start + W) - t.start)

i.e. the work started inside the window that opens at ``s.start``, clipped
at the window end.  The obvious plan is a band self join, whose pair count
grows with the square of a key's density.  Here it is a sweep instead: the
intervals become start/end events, each window is two query events, and
running sums over the merged event stream (see
:func:`ebbflow.operators.windows.running_sums`, split by time bucket) give
every term:

    G = [P(x, <=) - P(s, <)] - [A(x) - B(s)]         with x = s + W
    P(q)  = sum of durations of intervals starting before q
    A(x)  = sum of (end - x) over intervals active at x            (start <= x < end)
    B(s)  = sum of (end - W - s) over intervals with start < s and end - W > s
            (only intervals longer than W can qualify)

All quantities are integer microseconds; sums are DECIMAL(38,0) so they
cannot overflow.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.expr import epoch_micros
from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS, running_sums

D = "decimal(38,0)"


def rolling_clipped_sum(
    intervals: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    ident: str,
    window_us: int,
    *,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Return ``keys, ident, start, worked_us`` (``G`` in microseconds,
    DECIMAL).  ``start`` and ``end`` must be non-NULL with ``end >= start``."""
    keys = list(keys)
    base = intervals.select(
        *keys, ident, start,
        epoch_micros(start).alias("_st"), epoch_micros(end).alias("_en"),
    )
    zero = F.lit(0).cast(D)

    def ev(src, time_us, rank, **vals):
        cols = {n: zero for n in ("cnt_st", "sum_en", "sum_dur", "cnt_en", "sum_en_end",
                                  "l_cnt_st", "l_sum_en", "l_cnt_end", "l_sum_end")}
        cols.update({k: v.cast(D) for k, v in vals.items()})
        return src.select(
            *keys, F.col(ident).alias("_id"),
            time_us.alias("_t"), F.lit(rank).alias("_rank"),
            *[c.alias(n) for n, c in cols.items()],
        )

    one = F.lit(1)
    st, en = F.col("_st"), F.col("_en")
    long_ = (en - st) > F.lit(window_us)
    enp = en - F.lit(window_us)
    # ranks order events of equal time: ends, query at s, starts, query at x
    starts = ev(base, st, 2, cnt_st=one, sum_en=en, sum_dur=en - st,
                l_cnt_st=F.when(long_, one).otherwise(0), l_sum_en=F.when(long_, enp).otherwise(0))
    ends = ev(base, en, 0, cnt_en=one, sum_en_end=en)
    long_ends = ev(base.filter(long_), enp, 0, l_cnt_end=one, l_sum_end=enp)
    q_s = ev(base, st, 1)                       # sees starts < s, ends <= s
    q_x = ev(base, st + F.lit(window_us), 3)    # sees starts <= x, ends <= x
    stream = starts.unionByName(ends).unionByName(long_ends).unionByName(q_s).unionByName(q_x)
    stream = stream.withColumn("_ts", F.timestamp_micros("_t").cast("timestamp_ntz"))

    names = ["cnt_st", "sum_en", "sum_dur", "cnt_en", "sum_en_end", "l_cnt_st", "l_sum_en", "l_cnt_end", "l_sum_end"]
    run = running_sums(
        stream, keys, ["_ts", "_rank", "_id"],
        {f"r_{n}": F.col(n) for n in names},
        bucket_seconds=bucket_seconds,
    ).filter(F.col("_rank").isin(1, 3))

    t = F.col("_t").cast(D)
    a_x = (F.col("r_sum_en") - F.col("r_sum_en_end")) - t * (F.col("r_cnt_st") - F.col("r_cnt_en"))
    b_s = (F.col("r_l_sum_en") - F.col("r_l_sum_end")) - t * (F.col("r_l_cnt_st") - F.col("r_l_cnt_end"))
    # per window: x-row contributes P(x) - A(x), s-row contributes -(P(s) - B(s))
    part = F.when(F.col("_rank") == 3, F.col("r_sum_dur") - a_x).otherwise(-(F.col("r_sum_dur") - b_s))
    g = run.groupBy(*keys, "_id").agg(F.sum(part).cast(D).alias("_g"))
    return base.select(*keys, ident, start).join(
        g.withColumnRenamed("_id", ident), keys + [ident]
    ).withColumnRenamed("_g", "worked_us")
