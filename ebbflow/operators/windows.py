"""Skew-safe ordered window primitives.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task.  When a single key holds a large share of the data (one client,
one driver, one card) that task becomes the job.  The primitives below
give the *exact* results of the plain window while partitioning the work by
``(key, time bucket)``:

* :func:`shift_within_key` - ``lead``/``lag`` by 1..n rows.  Each bucket is
  windowed on its own; the last ``n`` rows of each bucket are answered by a
  second window over the first and last ``n`` rows of all buckets (so its
  size is bounded by the number of non-empty buckets, not by the number of
  rows).  Both read the same exchange, so the input is evaluated once.
* :func:`within_horizon` - any window over the rows of a bounded time before
  each row: the rows near a bucket's end are copied into the next bucket.
* :func:`running_sums` - running (prefix) sums in the window order.  Each
  bucket computes local running sums; bucket totals are prefix-summed per
  key (again one row per non-empty bucket) and added back.

The bucket width only changes how the work is split, never the result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ebbflow.functions.expr import time_bucket

DEFAULT_BUCKET_SECONDS = 86_400


def _order_cols(order: Sequence[str], descending: bool) -> list[Column]:
    if descending:
        return [F.col(c).desc_nulls_last() for c in order]
    return [F.col(c).asc_nulls_first() for c in order]


def shift_within_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    n: int,
    *,
    lag: bool = False,
    prefix: str | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add ``{prefix}_{i}_{col}`` = lead/lag(col, i) for i in 1..n.

    ``order`` must be non-null and unique within a key (include a
    tie-breaker); its first column is the timestamp used for bucketing.
    Missing neighbours are NULL, exactly as with ``F.lead``/``F.lag``.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    prefix = prefix or ("lag" if lag else "lead")
    names = [(i, c, f"{prefix}_{i}_{c}") for i in range(1, n + 1) for c in cols]
    b = time_bucket(order[0], bucket_seconds)
    # lag == lead in the mirrored order: negate the bucket, sort descending.
    # partition on struct(keys): never NULL itself, NULL fields compare equal,
    # so a NULL key stays one group
    df = df.withColumn("_b", -b if lag else b).withColumn("_kk", F.struct(*keys))
    sort = _order_cols(order, lag)
    w = Window.partitionBy("_kk", "_b").orderBy(*sort)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = df.withColumn("_pos", F.row_number().over(w)).withColumn("_cnt", F.count(F.lit(1)).over(w_all))
    last = F.col("_cnt") - F.col("_pos") < n  # some of the n following rows are in later buckets

    # All n followers in the bucket: the bucket's own window answers.
    inside = inner
    for i, c, name in names:
        inside = inside.withColumn(name, F.lead(c, i).over(w))
    # The last n rows of a bucket: their followers are among the first n rows
    # of the buckets after it, so the first and last n rows of every bucket,
    # taken together in key order, have the right neighbours.
    b_order = F.col("_b").asc_nulls_last() if lag else F.col("_b").asc_nulls_first()
    across = Window.partitionBy("_kk").orderBy(b_order, F.col("_pos"))
    edges = inner.filter((F.col("_pos") <= n) | last)
    for i, c, name in names:
        edges = edges.withColumn(name, F.lead(c, i).over(across))
    return inside.filter(~last).unionByName(edges.filter(last)).drop("_b", "_kk", "_pos", "_cnt")


def within_horizon(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    horizon_seconds: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    *,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add ``name: expression(window)`` computed over the key's earlier rows of at least the last ``horizon_seconds``.

    The window is partitioned by (key, time bucket); every row is copied into the buckets that begin within the
    horizon after it, as context only.  One exchange and one sort serve all columns.  A row's window holds, without
    gaps, its bucket's rows up to it and all those within the horizon before the bucket: ``lag``, ``last`` and the
    like are exact as long as the row they speak of lies within the horizon; else they may be NULL.
    ``order`` must be non-null and unique within a key.
    """
    keys, order = list(keys), list(order)
    first, last = time_bucket(order[0], bucket_seconds), time_bucket(F.col(order[0]) + F.expr(f"INTERVAL {horizon_seconds} SECONDS"), bucket_seconds)
    rows = df.select("*", F.struct(*keys).alias("_kk"), first.alias("_own"), F.explode(F.sequence(first, last)).alias("_b"))
    w = Window.partitionBy("_kk", "_b").orderBy(*_order_cols(order, False))
    rows = rows.select("*", *[f(w).alias(name) for name, f in columns.items()])
    return rows.filter(F.col("_b") == F.col("_own")).drop("_kk", "_own", "_b")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    *,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add running sums ``name = sum(expr) over (keys order by order rows
    unbounded preceding .. current row)`` for each ``name: expr``.

    ``order`` must be a total order within a key; its first column is the
    timestamp used for bucketing.
    """
    keys, order = list(keys), list(order)
    df = df.withColumn("_b", time_bucket(order[0], bucket_seconds)).withColumn("_kk", F.struct(*keys))
    for name, expr in values.items():
        df = df.withColumn(f"_v_{name}", expr)
    part = ["_kk", "_b"]
    w = Window.partitionBy(*part).orderBy(*_order_cols(order, False)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = df
    for name in values:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(w))
    totals = df.groupBy(*part).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    tw = Window.partitionBy("_kk").orderBy(F.col("_b").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *part, *[F.coalesce(F.sum(f"_t_{n}").over(tw), F.lit(0)).alias(f"_o_{n}") for n in values]
    )
    out = local.join(offsets, part, "left")
    for name in values:
        out = out.withColumn(name, F.col(f"_l_{name}") + F.col(f"_o_{name}"))
    drop = ["_b", "_kk"] + [f"_{p}_{n}" for n in values for p in ("v", "l", "o")]
    return out.drop(*drop)


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                  *, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``row_number()`` over ``(keys order by order)``, computed skew-safely."""
    out = running_sums(df, keys, order, {name: F.lit(1).cast("long")}, bucket_seconds=bucket_seconds)
    return out


def last_known_within_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    known: Column,
    prefix: str,
    *,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add ``{prefix}_{col}``: the values of ``cols`` at the key's last earlier row for which ``known`` holds.

    Each bucket is windowed on its own; what comes from earlier buckets is the last known row of each bucket
    (a partial aggregate), carried over buckets that have none.  ``order`` must be non-null and unique within a key.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    df = df.withColumn("_b", time_bucket(order[0], bucket_seconds)).withColumn("_kk", F.struct(*keys)) \
        .withColumn("_kn", F.when(known, F.struct(*cols)))
    part = ["_kk", "_b"]
    before = Window.partitionBy(*part).orderBy(*_order_cols(order, False)).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_in", F.last("_kn", ignorenulls=True).over(before))
    last = df.groupBy(*part).agg(F.max(F.when(F.col("_kn").isNotNull(), F.struct(*order, "_kn"))).alias("_l"))
    earlier = Window.partitionBy("_kk").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    halo = last.select(*part, F.last("_l._kn", ignorenulls=True).over(earlier).alias("_h"))
    out = inner.join(halo, part, "left").withColumn("_in", F.coalesce("_in", "_h"))
    for c in cols:
        out = out.withColumn(f"{prefix}_{c}", F.col("_in")[c])
    return out.drop("_b", "_kk", "_kn", "_in", "_h")
