"""Taxi warehouse marts: driver payouts, speeding, overtime, client metrics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions.expr import elapsed_seconds, epoch_micros, plus_interval, strip_blanks
from ebbflow.operators import facts
from ebbflow.operators.intervals import rolling_clipped_sum
from ebbflow.operators.scd2 import current
from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS, running_count, shift_within_key

# Fixed values of the payout rule: service fee 20 %, fuel 47.26 per litre at
# 7 litres per 100 km, car depreciation 5 per km.
DRIVER_SHARE = Decimal("0.8")
FUEL_PRICE = Decimal("47.26")
FUEL_PER_100KM = Decimal("7")
DEPRECIATION_PER_KM = Decimal("5")
SPEED_LIMIT = 85
# Fixed values of the movement feed: event names.
READY, BEGIN, END, CANCEL = "READY", "BEGIN", "END", "CANCEL"
RIDE_EVENTS = {"ride_arrival_dt": [READY], "ride_start_dt": [BEGIN], "ride_end_dt": [END, CANCEL]}
HOUR_US = 3_600_000_000


def ride_pivot(rides: DataFrame, movement: DataFrame) -> DataFrame:
    """movement events -> arrival / start / end times per ride; the
    events are aggregated before they meet the ride table."""
    ev = facts.pivot_events(
        movement, "ride", "event", "dt",
        RIDE_EVENTS, carry=["car_plate_num"],
    )
    return rides.join(ev, rides["ride_id"] == ev["ride"], "left").select(
        "ride_id", "client_phone", "distance", "price", "car_plate_num",
        "ride_arrival_dt", "ride_start_dt", "ride_end_dt",
    )


def driver_assignment(arrivals: DataFrame, waybills: DataFrame, how: str = "left") -> DataFrame:
    """each ride gets the driver of the earliest waybill of its car whose
    work period contains the arrival time."""
    return facts.assign_by_range(
        arrivals, waybills,
        point_keys=["ride_id", "ride_line"], equi="car_plate_num", at="ride_arrival_dt",
        start="work_start_dt", end="work_end_dt",
        rank_by=["work_start_dt", "waybill_num"], take=["waybill_num", "driver_pers_num"], how=how,
    )


def waybill_merge(fragments: DataFrame, drivers: DataFrame) -> DataFrame:
    """fold the partial rows of each waybill, resolve the driver by licence
    on the current driver versions."""
    merged = facts.merge_fragments(
        fragments, "waybill_num", ["driver_license", "car_plate_num", "work_start_dt", "work_end_dt", "issue_dt"]
    )
    d = current(drivers).select(F.col("driver_license_num").alias("driver_license"), "personnel_num")
    return merged.join(d, "driver_license", "left").select(
        "waybill_num", F.col("personnel_num").alias("driver_pers_num"), "car_plate_num",
        "work_start_dt", "work_end_dt", "issue_dt",
    )


def driver_payout(fact_rides: DataFrame, drivers: DataFrame, report_dt: str | None = None,
                  keep_unassigned: bool = False) -> DataFrame:
    """M5: payout per driver and day over rides that were not cancelled."""
    r = fact_rides.filter(F.col("ride_start_dt").isNotNull())
    if report_dt:
        r = r.filter(F.to_date("ride_arrival_dt") == F.lit(report_dt).cast("date"))
    if not keep_unassigned:
        r = r.filter(F.col("driver_pers_num").isNotNull())
    per_km = FUEL_PRICE * FUEL_PER_100KM / 100 + DEPRECIATION_PER_KM
    agg = r.groupBy("driver_pers_num", F.to_date("ride_arrival_dt").alias("report_dt")).agg(
        F.sum("price_amt").alias("_p"), F.sum("distance_val").alias("_d")
    )
    amount = (F.col("_p") * F.lit(DRIVER_SHARE) - F.col("_d") * F.lit(per_km)).cast("decimal(24,6)")
    d = current(drivers).select("personnel_num", "last_name", "first_name", "middle_name", "card_num")
    return agg.join(d, agg["driver_pers_num"] == d["personnel_num"], "left" if keep_unassigned else "inner").select(
        F.col("driver_pers_num").alias("personnel_num"), "last_name", "first_name", "middle_name", "card_num",
        amount.alias("amount"), "report_dt",
    )


def trips(events: DataFrame, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Consecutive positions of a driver -> trips with elapsed seconds."""
    t = shift_within_key(events, ["personnel_num"], ["ts", "ride"], ["ts"], 1, prefix="next",
                         bucket_seconds=bucket_seconds)
    return t.filter(F.col("next_1_ts").isNotNull()).select(
        "personnel_num", "ride", "distance_val",
        F.col("ts").alias("ride_start_dt"), F.col("next_1_ts").alias("ride_end_dt"),
        elapsed_seconds("ts", "next_1_ts").alias("ride_sec"),
    )


def ride_trips(fact_rides: DataFrame) -> DataFrame:
    """Trips of the ride fact: driven rides (not cancelled) of a known driver, with their elapsed seconds."""
    driven = F.col("ride_start_dt").isNotNull() & F.col("ride_end_dt").isNotNull() & F.col("driver_pers_num").isNotNull()
    return fact_rides.filter(driven).select(
        F.col("driver_pers_num").alias("personnel_num"), F.col("ride_id").alias("ride"), "distance_val",
        "ride_start_dt", "ride_end_dt", elapsed_seconds("ride_start_dt", "ride_end_dt").alias("ride_sec"),
    )


def driver_violations(trip_df: DataFrame, report_dt: str | None = None, limit_kmh: int = SPEED_LIMIT,
                      bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """M6: trips faster than the limit (speed rounded to km/h, as in the
    spec); ``violations_cnt`` counts the driver's violations so far, the
    first one is 1.  With ``report_dt`` only that day is reported (the count
    still includes all earlier days)."""
    speed = F.round(F.try_divide(F.col("distance_val"), F.col("ride_sec")) * 3600)
    v = trip_df.filter(F.col("ride_sec") > 0).withColumn("speed", speed).filter(F.col("speed") > limit_kmh)
    v = running_count(v, ["personnel_num"], ["ride_end_dt", "ride"], "violations_cnt", bucket_seconds=bucket_seconds)
    v = v.withColumn("report_dt", F.to_date("ride_end_dt"))
    if report_dt:
        v = v.filter(F.col("report_dt") == F.lit(report_dt).cast("date"))
    return v.select("personnel_num", "ride", "speed", "violations_cnt", "report_dt")


def partition_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """``count(*) over (partition by key)`` as partial aggregate + join
    (no per-key buffering)."""
    c = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    return df.join(c, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")  # a NULL key is a partition of its own


def first_value_anchor(shifts: DataFrame) -> DataFrame:
    """``first_value(start) over (driver, day order by start)``, i.e. the
    day's earliest start: a partial ``min`` aggregate joined back, so a busy
    driver-day is never buffered in one task."""
    day = F.to_date("work_start_dt")
    first = shifts.groupBy(F.col("driver_pers_num").alias("_driver"), day.alias("_first_day")).agg(F.min("work_start_dt").alias("anchor_dt"))
    same = F.col("driver_pers_num").eqNullSafe(F.col("_driver")) & F.col("_day").eqNullSafe(F.col("_first_day"))
    return shifts.withColumn("_day", day).join(first, same).drop("_day", "_driver", "_first_day")


def driver_overtime(shifts: DataFrame, report_dt: str, limit_hours: int = 8,
                    window: str = "24 hours") -> DataFrame:
    """M7: shifts starting on ``report_dt``; the 24 h period opens at the
    driver's first shift of the day, work is clipped at its end; drivers with
    more than ``limit_hours`` are reported (second precision)."""
    s = shifts.filter(F.to_date("work_start_dt") == F.lit(report_dt).cast("date"))
    s = first_value_anchor(s).withColumn("_wend", plus_interval("anchor_dt", window))
    worked = epoch_micros(F.least("work_end_dt", "_wend")) - epoch_micros("work_start_dt")
    g = s.groupBy("driver_pers_num", "anchor_dt").agg(F.sum(worked).alias("_us"))
    return g.filter(F.col("_us") > limit_hours * HOUR_US).select(
        F.col("driver_pers_num").alias("personnel_num"),
        F.col("anchor_dt").alias("start_work_dt"),
        (F.col("_us").cast("double") / 1e6).alias("working_time_sec"),
        F.to_date("anchor_dt").alias("report_dt"),
    )


def driver_overtime_rolling(shifts: DataFrame, limit_hours: int = 8, window_hours: int = 24,
                            bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """M7 (rolling): every shift opens a 24 h period; work started inside it
    is clipped at its end; periods with more than ``limit_hours`` are reported."""
    g = rolling_clipped_sum(shifts, ["driver_pers_num"], "work_start_dt", "work_end_dt", "waybill_id",
                            window_hours * HOUR_US, bucket_seconds=bucket_seconds)
    return g.filter(F.col("worked_us") > limit_hours * HOUR_US).select(
        F.col("driver_pers_num").alias("personnel_num"), "waybill_id",
        F.col("work_start_dt").alias("start_work_dt"),
        (F.col("worked_us").cast("double") / 1e6).alias("working_time_sec"),
        F.to_date("work_start_dt").alias("report_dt"),
    )


def shift_hours_having(shifts: DataFrame, limit_hours: int = 8) -> DataFrame:
    """A5: GROUP BY driver, day HAVING total shift time > limit."""
    worked = epoch_micros("work_end_dt") - epoch_micros("work_start_dt")
    g = shifts.groupBy("driver_pers_num", F.to_date("work_start_dt").alias("work_day")).agg(F.sum(worked).alias("_us"))
    return g.filter(F.col("_us") > limit_hours * HOUR_US).select(
        F.col("driver_pers_num").alias("personnel_num"), "work_day",
        (F.col("_us").cast("double") / 1e6).alias("working_time_sec"),
    )


def ride_aggregates(fact_rides: DataFrame) -> DataFrame:
    """A3: rides, cancellations and spend per client."""
    started = F.col("ride_start_dt").isNotNull()
    return fact_rides.groupBy("client_phone_num").agg(
        F.count("ride_start_dt").alias("rides_cnt"),
        F.count(F.when(~started, F.col("ride_id"))).alias("cancelled_cnt"),
        F.sum(F.when(started, F.col("price_amt"))).cast("decimal(22,2)").alias("spent_amt"),
    )


def payments_by_card(payments: DataFrame) -> DataFrame:
    """A4: received amount per card."""
    return payments.groupBy("card_num").agg(F.sum("transaction_amt").cast("decimal(22,2)").alias("paid_total"))


def client_metrics(clients: DataFrame, fact_rides: DataFrame, payments: DataFrame) -> DataFrame:
    """M8: know-your-client metrics per phone.  Debt = spend minus payments
    over the client's distinct cards (a card counts once per client)."""
    r = ride_aggregates(fact_rides)
    cards = clients.select("phone_num", strip_blanks("card_num").alias("card_num")).distinct()
    paid = cards.join(payments_by_card(payments), "card_num", "left").groupBy("phone_num").agg(
        F.sum("paid_total").alias("_paid")
    )
    phones = clients.select("phone_num").distinct()
    out = phones.join(r, phones["phone_num"] == r["client_phone_num"], "left").join(paid, "phone_num", "left")
    spent = F.coalesce(F.col("spent_amt"), F.lit(Decimal("0.00")))
    return out.select(
        "phone_num",
        F.coalesce("rides_cnt", F.lit(0).cast("long")).alias("rides_cnt"),
        F.coalesce("cancelled_cnt", F.lit(0).cast("long")).alias("cancelled_cnt"),
        spent.cast("decimal(22,2)").alias("spent_amt"),
        (spent - F.coalesce(F.col("_paid"), F.lit(Decimal("0.00")))).cast("decimal(22,2)").alias("debt_amt"),
    )


METRIC_COLS = ["rides_cnt", "cancelled_cnt", "spent_amt", "debt_amt"]
