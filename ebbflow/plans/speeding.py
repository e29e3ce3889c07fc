"""M6 as a daily run: speeding violations of one day from that day and what earlier runs left.

A run reads the day's positions, the last position of every driver before it and the driver's violation count so
far.  It gives the day's violations and the state for the next run.  Both states hold one row per driver, so a
run's cost does not grow with the history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS
from ebbflow.plans.taxi import SPEED_LIMIT, driver_violations, trips

POSITION = ["personnel_num", "ts", "ride", "distance_val"]


@dataclass(frozen=True)
class SpeedingDay:
    violations: DataFrame
    #: ``personnel_num, ts, ride, distance_val``: each driver's last position.
    positions: DataFrame
    #: ``personnel_num, violations_cnt``: each driver's count so far.
    counts: DataFrame


def last_positions(events: DataFrame) -> DataFrame:
    """The last position of each driver (a partial aggregate)."""
    last = events.groupBy("personnel_num").agg(F.max(F.struct("ts", "ride", "distance_val")).alias("p"))
    return last.select("personnel_num", "p.ts", "p.ride", "p.distance_val")


def last_counts(mart: DataFrame) -> DataFrame:
    """The violation count that the accumulated mart has reached for each driver."""
    return mart.groupBy("personnel_num").agg(F.max("violations_cnt").alias("violations_cnt"))


def speeding_day(day_events: DataFrame, positions: DataFrame, counts: DataFrame, limit_kmh: int = SPEED_LIMIT,
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> SpeedingDay:
    """The violations of trips that end in the day; counts go on from ``counts``.

    ``day_events`` are the positions of the day, ``positions`` those left by the run before it: the trip that
    began before the day and ended in it is measured from there.
    """
    events = day_events.select(*POSITION).unionByName(positions.select(*POSITION))
    today = driver_violations(trips(events, bucket_seconds), limit_kmh=limit_kmh, bucket_seconds=bucket_seconds)
    before = counts.select("personnel_num", F.col("violations_cnt").alias("_before"))
    violations = today.join(before, "personnel_num", "left") \
        .withColumn("violations_cnt", F.col("violations_cnt") + F.coalesce("_before", F.lit(0))).drop("_before")
    reached = violations.select("personnel_num", "violations_cnt").unionByName(counts.select("personnel_num", "violations_cnt"))
    return SpeedingDay(violations, last_positions(events), last_counts(reached))
