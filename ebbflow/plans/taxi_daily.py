"""The taxi's daily run: sources, dimensions, ride and payment facts and the four marts of a day, published by one commit.

A run costs its own day: it reads the rides it touches (new orders and movements), not the fact.  A ride that finished before
and gets a late event is assembled again from all its events; the newest row of a ride counts, and the payout of every
arrival date it touches is written anew.  Speeding is judged in the run in which a ride finishes, and a driver's count
goes on from the accumulated mart.  A run that failed before its commit is repeated under its number; a committed run is not repeated.

Tables below ``root``: dimensions ``clients drivers cars client_metrics``; facts (a directory for each run) ``rides ride_parts
waybill_parts waybills fact_rides payments payments_rejects``; reports by date ``rep_payout rep_violations rep_overtime``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import facts
from ebbflow.operators.overtime import first_over_limit
from ebbflow.operators.scd2 import current
from ebbflow.plans import taxi
from ebbflow.plans.daily import Source, stage_dimensions
from ebbflow.sinks import tables
from ebbflow.sources.rejects import PAYMENT_FIELDS, parse_lines
from ebbflow.streaming.dimension import Dimension

RIDES = "ride_id BIGINT, client_phone STRING, distance DECIMAL(5,2), price DECIMAL(12,2)"
PARTS = "ride BIGINT, ride_arrival_dt TIMESTAMP_NTZ, ride_start_dt TIMESTAMP_NTZ, ride_end_dt TIMESTAMP_NTZ, car_plate_num STRING"
WAYBILL_PARTS = ("waybill_num STRING, driver_license STRING, car_plate_num STRING, work_start_dt TIMESTAMP_NTZ, work_end_dt TIMESTAMP_NTZ, "
                 "issue_dt TIMESTAMP_NTZ")
WAYBILLS = ("waybill_num STRING, driver_pers_num BIGINT, car_plate_num STRING, work_start_dt TIMESTAMP_NTZ, work_end_dt TIMESTAMP_NTZ, "
            "issue_dt TIMESTAMP_NTZ")
FACT = ("ride_id BIGINT, driver_pers_num BIGINT, car_plate_num STRING, client_phone_num STRING, price_amt DECIMAL(12,2), distance_val DECIMAL(5,2), "
        "ride_arrival_dt TIMESTAMP_NTZ, ride_start_dt TIMESTAMP_NTZ, ride_end_dt TIMESTAMP_NTZ")
PAYMENTS = "transaction_dt TIMESTAMP_NTZ, card_num STRING, transaction_amt DECIMAL(12,2)"
PAYOUT = ("personnel_num BIGINT, last_name STRING, first_name STRING, middle_name STRING, card_num STRING, amount DECIMAL(24,6), report_dt DATE")
VIOLATIONS = "personnel_num BIGINT, ride BIGINT, speed DOUBLE, violations_cnt BIGINT, report_dt DATE"
OVERTIME = "personnel_num BIGINT, waybill_num STRING, start_work_dt TIMESTAMP_NTZ, working_time_sec DOUBLE, report_dt DATE"


@dataclass(frozen=True)
class TaxiDay:
    """What a daily run is given: what the sources have new since the run before, and whole dimension sources."""

    report_dt: str
    #: Time of the run: that of logical deletes and of the metrics' versions.
    run_ts: str
    #: ``ride_id, client_phone, distance, price``
    rides: DataFrame
    #: ``ride, car_plate_num, event, dt``
    movement: DataFrame
    #: Partial rows of waybills.
    waybills: DataFrame
    #: Lines (``value``) of payments, tabs between the fields.
    payments: DataFrame
    #: ``clients`` (phone_num; card_num), ``drivers`` (personnel_num; names, card_num, driver_license_num), ``cars``.
    sources: dict[str, Source] = field(default_factory=dict)


def _newest(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Of the rows of a key those of the newest batch (a partial aggregate)."""
    rest = [c for c in cols if c != key]
    return df.groupBy(key).agg(F.max(F.struct("batch", *rest)).alias("_n")).select(key, *[F.col(f"_n.{c}").alias(c) for c in rest])


def _names(schema: str) -> list[str]:
    return [c.strip().split()[0] for c in schema.replace("(5,2)", "").replace("(12,2)", "").split(",")]


def fact_rides(spark: SparkSession, root: str, before: int) -> DataFrame:
    """The finished rides as the runs before ``before`` know them."""
    return _newest(tables.read_appended(spark, f"{root}/fact_rides", FACT, before_batch=before, with_batch=True), "ride_id", _names(FACT))


def waybills(spark: SparkSession, root: str, before: int) -> DataFrame:
    return _newest(tables.read_appended(spark, f"{root}/waybills", WAYBILLS, before_batch=before, with_batch=True), "waybill_num", _names(WAYBILLS))


def _load(spark: SparkSession, root: str, version: int, day: TaxiDay, drivers: DataFrame) -> None:
    """Append the day's rides, movements, waybills and payments, and the ride rows that they make or change."""
    read = lambda name, schema, **more: tables.read_appended(spark, f"{root}/{name}", schema, before_batch=version + 1, **more)
    new = lambda df: df.filter(F.col("batch") == version)
    loaded = tables.read_appended(spark, f"{root}/rides", RIDES, before_batch=version)
    tables.append_batch(facts.dedup_append(day.rides.select(*_names(RIDES)), loaded, ["ride_id"]), f"{root}/rides", version)
    moves = day.movement.filter(F.col("ride").isNotNull())
    parts = facts.pivot_events(moves, "ride", "event", "dt", taxi.RIDE_EVENTS, carry=["car_plate_num"])
    tables.append_batch(parts.select(*_names(PARTS)), f"{root}/ride_parts", version)

    tables.append_batch(day.waybills.select(*_names(WAYBILL_PARTS)), f"{root}/waybill_parts", version)
    every = read("waybill_parts", WAYBILL_PARTS, with_batch=True)
    touched = every.join(new(every).select("waybill_num").distinct(), "waybill_num", "left_semi").drop("batch")
    tables.append_batch(taxi.waybill_merge(touched, drivers).select(*_names(WAYBILLS)), f"{root}/waybills", version)

    feed = parse_lines(day.payments, PAYMENT_FIELDS, "\t")
    paid = tables.read_appended(spark, f"{root}/payments", PAYMENTS, before_batch=version)
    tables.append_batch(facts.dedup_append(feed.good.select(*_names(PAYMENTS)), paid, _names(PAYMENTS)), f"{root}/payments", version)
    tables.append_batch(feed.rejected.select("line", "reason"), f"{root}/payments_rejects", version)

    orders, known = read("rides", RIDES, with_batch=True), read("ride_parts", PARTS, with_batch=True)
    ids = new(orders).select("ride_id").unionByName(new(known).select(F.col("ride").alias("ride_id"))).distinct()
    times = known.join(ids.withColumnRenamed("ride_id", "ride"), "ride", "left_semi")
    times = times.groupBy("ride").agg(*[F.max(c).alias(c) for c in _names(PARTS)[1:]])
    done = orders.join(ids, "ride_id", "left_semi").drop("batch").join(facts.completed(times, "ride_end_dt").withColumnRenamed("ride", "ride_id"), "ride_id")
    first = done.agg(F.min("ride_arrival_dt")).first()[0]
    shifts = waybills(spark, root, version + 1).filter(F.col("work_start_dt").isNotNull() & F.col("work_end_dt").isNotNull())
    if first is not None:
        shifts = shifts.filter(F.col("work_end_dt") >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz"))
    points = done.select("ride_id", F.lit(0).alias("ride_line"), "car_plate_num", "ride_arrival_dt")
    driver = taxi.driver_assignment(points, shifts).select("ride_id", "driver_pers_num")
    rows = done.join(driver, "ride_id", "left").withColumnsRenamed({"client_phone": "client_phone_num", "price": "price_amt", "distance": "distance_val"})
    tables.append_batch(rows.select(*_names(FACT)), f"{root}/fact_rides", version)


def run(spark: SparkSession, root: str, version: int, day: TaxiDay) -> bool:
    """Run ``version`` for ``day``; False if that run is committed already."""
    if tables.has_manifest(spark, root, version):
        return False
    m = tables.latest_manifest(spark, root, before=version)
    marks = dict(m["watermarks"] or {}) if m is not None else {}
    staged, new_marks, dims = stage_dimensions(spark, root, version, day.sources, marks, day.run_ts)
    drivers = dims["drivers"].read()
    _load(spark, root, version, day, drivers)
    staged |= {n: version for n in ("rides", "ride_parts", "waybill_parts", "waybills", "payments", "fact_rides")}

    stored = tables.read_appended(spark, f"{root}/fact_rides", FACT, before_batch=version + 1, with_batch=True)
    today = stored.filter(F.col("batch") == version).drop("batch")
    # a ride pays on its arrival date, whenever it finishes
    dates = {day.report_dt} | {str(r[0]) for r in today.select(F.to_date("ride_arrival_dt")).distinct().collect() if r[0] is not None}
    arrived = stored.filter(F.to_date("ride_arrival_dt").isin([F.lit(d).cast("date") for d in dates]))
    payout = taxi.driver_payout(_newest(arrived, "ride_id", _names(FACT)), drivers)
    staged |= tables.write_report(payout, root, "rep_payout", version, sorted(dates))

    report_dt = F.lit(day.report_dt).cast("date")
    finished = today.join(stored.filter(F.col("batch") < version).select("ride_id").distinct(), "ride_id", "left_anti")
    found = taxi.driver_violations(taxi.ride_trips(finished)).withColumn("report_dt", report_dt)
    before = tables.read_report(spark, root, "rep_violations", VIOLATIONS).groupBy("personnel_num").agg(F.max("violations_cnt").alias("_before"))
    found = found.join(before, "personnel_num", "left").withColumn("violations_cnt", F.col("violations_cnt") + F.coalesce("_before", F.lit(0)))
    found = found.select("personnel_num", "ride", F.col("speed").cast("double").alias("speed"), "violations_cnt", "report_dt")
    staged |= tables.write_report(found, root, "rep_violations", version, [day.report_dt])

    # a waybill of the day may pass the limit of a period opened up to a day before
    work = waybills(spark, root, version + 1).filter((F.to_date("work_start_dt") >= F.date_sub(report_dt, 1)) & (F.to_date("work_start_dt") <= report_dt))
    over = first_over_limit(work, ident="waybill_num").filter(F.to_date("waybill_start") == report_dt)
    over = over.groupBy("driver", "waybill", "waybill_start").agg(F.max("worked_us").alias("us")).select(
        F.col("driver").alias("personnel_num"), F.col("waybill").alias("waybill_num"), F.col("waybill_start").alias("start_work_dt"),
        (F.col("us").cast("double") / 1e6).alias("working_time_sec"), report_dt.alias("report_dt"))
    staged |= tables.write_report(over, root, "rep_overtime", version, [day.report_dt])

    clients = current(dims["clients"].read(), include_deleted=False)
    metrics = taxi.client_metrics(clients, _newest(stored, "ride_id", _names(FACT)), tables.read_appended(spark, f"{root}/payments", PAYMENTS, before_batch=version + 1))
    changes = metrics.withColumn("change_ts", F.lit(day.run_ts).cast("timestamp_ntz"))
    history = Dimension(spark, root, "client_metrics", changes.schema, ["phone_num"], taxi.METRIC_COLS)
    history.stage(changes, version, clients.select("phone_num").distinct(), day.run_ts)
    tables.commit(spark, root, version, staged | history.staged, new_marks)
    return True
