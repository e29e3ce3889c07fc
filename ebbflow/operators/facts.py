"""Fact-loading operators: idempotent append, event pivot, fragment merge,
range-join assignment."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_append(batch: DataFrame, fact: DataFrame, key: Sequence[str]) -> DataFrame:
    """rows of ``batch`` (one per key) whose key is not yet in ``fact``."""
    key = list(key)
    return batch.dropDuplicates(key).join(fact.select(*key), key, "left_anti")


def pivot_events(events: DataFrame, entity: str, event_col: str, ts_col: str,
                 outputs: dict[str, Sequence[str]], carry: Sequence[str] = ()) -> DataFrame:
    """one row per entity with ``max(ts)`` of each event group, e.g.
    ``{"ride_start_dt": ["BEGIN"], "ride_end_dt": ["END", "CANCEL"]}``.
    Hash aggregate with a map-side partial step, so a hot entity never
    gathers its rows in one place."""
    aggs = [F.max(F.when(F.col(event_col).isin(*vals), F.col(ts_col))).alias(name) for name, vals in outputs.items()]
    aggs += [F.max(c).alias(c) for c in carry]
    return events.groupBy(entity).agg(*aggs)


def completed(df: DataFrame, end_col: str) -> DataFrame:
    """completeness gate."""
    return df.filter(F.col(end_col).isNotNull())


def merge_fragments(fragments: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """fold partial rows of one document (``max`` per column)."""
    return fragments.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def assign_by_range(
    points: DataFrame,
    ranges: DataFrame,
    *,
    point_keys: Sequence[str],
    equi: str,
    at: str,
    start: str,
    end: str,
    rank_by: Sequence[str],
    take: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """for every (distinct) point, the first range (by ``rank_by``) with the same
    ``equi`` value and ``start <= at <= end``.

    The range side is exploded to one row per calendar day it covers, so the
    join runs on (equi, day): a hot equi value (one car, one driver) is
    spread over its days instead of landing in one task, and the BETWEEN
    test becomes a residual filter.  The planner's estimate does not count the
    explode, so the join is asked to merge: a broadcast would send the days of
    all ranges through the driver.  The winner is picked with a ``min``
    over a struct (a hash aggregate with a partial step), not a sort.
    """
    point_keys = list(point_keys)
    r = ranges.select(
        F.col(equi).alias("_eq"), F.col(start).alias("_rs"), F.col(end).alias("_re"),
        *[F.col(c).alias(f"_rk_{c}") for c in rank_by if c not in (start,)],
        *[F.col(c).alias(f"_tk_{c}") for c in take],
    ).withColumn("_day", F.explode(F.sequence(F.to_date("_rs"), F.to_date("_re"))))
    p = points.withColumn("_day", F.to_date(at))
    cond = (
        (p[equi] == r["_eq"]) & (p["_day"] == r["_day"])
        & (p[at] >= r["_rs"]) & (p[at] <= r["_re"])
    )
    j = p.join(r.hint("merge"), cond, how)
    rank_fields = [F.col("_rs") if c == start else F.col(f"_rk_{c}") for c in rank_by]
    best = F.when(F.col("_rs").isNotNull(), F.struct(*rank_fields, *[F.col(f"_tk_{c}") for c in take]))
    keep = point_keys + [c for c in points.columns if c not in point_keys]
    g = j.groupBy(*keep).agg(F.min(best).alias("_w"))
    return g.select(*keep, *[F.col(f"_w._tk_{c}").alias(c) for c in take])


def top1_by_rank(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``row_number() = 1`` per partition (planned as WindowGroupLimit)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
