"""Watermarks, JSON settings, cumulative file deltas, JSON extraction and
payout options."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ebbflow.operators import watermark
from ebbflow.plans import taxi
from ebbflow.sources import files as srcf
from ebbflow.sources import incremental as inc

T0 = dt.datetime(2024, 1, 1)


def test_watermarks_advance_but_never_move_back(spark):
    ctl = watermark.control_table(spark, {"a": "2024-01-05 00:00:00", "b": "2024-01-05 00:00:00",
                                          "c": "2024-01-05 00:00:00"})
    marks = spark.createDataFrame([("a", T0 + dt.timedelta(days=9)), ("a", T0 + dt.timedelta(days=7)),
                                   ("b", T0)], "source string, ts timestamp_ntz")
    got = {r.source: r.watermark for r in watermark.advance_watermarks(ctl, marks).collect()}
    assert got == {"a": T0 + dt.timedelta(days=9),    # advanced to the batch max
                   "b": T0 + dt.timedelta(days=4),    # an older batch never moves it back
                   "c": T0 + dt.timedelta(days=4)}    # empty batch keeps the mark
    assert watermark.read_watermark(ctl, "a") == T0 + dt.timedelta(days=4)
    assert watermark.read_watermark(ctl, "zzz", default="none") == "none"


def test_settings_defaults_and_serialisation(spark):
    settings = spark.createDataFrame([("w1", '{"last_loaded_id": 41}')], "workflow_key string, workflow_settings string")
    assert watermark.read_setting(settings, "w1", "last_loaded_id", -1, "long") == 41
    assert watermark.read_setting(settings, "w2", "last_loaded_id", -1, "long") == -1
    row = spark.range(1).select(*watermark.settings_row(F.lit("w1"), last_loaded_id=F.lit(42).cast("long"))).collect()[0]
    assert (row.workflow_key, row.workflow_settings) == ("w1", '{"last_loaded_id":42}')


def test_cumulative_file_delta_keeps_the_watermark_day(spark):
    d = dt.date
    file_rows = spark.createDataFrame([(d(2024, 1, 1), "P1"), (d(2024, 1, 5), "P2"), (d(2024, 1, 5), "P3"),
                                       (d(2024, 1, 6), "P4"), (d(2024, 1, 6), "P4")], "entry_dt date, passport string")
    loaded = spark.createDataFrame([(d(2024, 1, 5), "P2")], "entry_dt date, passport string")
    delta = srcf.cumulative_delta(file_rows, loaded, "entry_dt", "2024-01-05", ["passport", "entry_dt"])
    got = sorted(tuple(r) for r in delta.select("entry_dt", "passport").collect())
    # same-day row P3 is not lost (>=), P2 is already loaded, the repeated P4 appears once
    assert got == [(d(2024, 1, 5), "P3"), (d(2024, 1, 6), "P4")]


def test_json_extract_latest_row_per_object(spark):
    df = spark.createDataFrame([(1, 7, '{"name": "a", "login": "x"}'), (2, 7, '{"name": "b", "login": "y"}'),
                                (3, 8, '{"name": "c"}')], "id long, object_id long, object_value string")
    got = sorted(tuple(r) for r in inc.json_extract_batch(
        df, "id", 0, "object_value", {"user_name": "$.name", "user_login": "$.login"}, 100, key_col="object_id").collect())
    assert got == [(2, 7, "b", "y"), (3, 8, "c", None)]


def test_payout_keeps_unassigned_rides_only_when_asked(spark):
    rides = spark.createDataFrame([
        (1, None, Decimal("10.00"), Decimal("1.00"), T0, T0),
    ], "ride_id long, driver_pers_num long, price_amt decimal(12,2), distance_val decimal(5,2), "
       "ride_arrival_dt timestamp_ntz, ride_start_dt timestamp_ntz")
    drivers = spark.createDataFrame([], "personnel_num long, last_name string, first_name string, middle_name string, "
                                        "card_num string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
                                        "is_deleted boolean")
    assert taxi.driver_payout(rides, drivers).count() == 0
    kept = taxi.driver_payout(rides, drivers, keep_unassigned=True).collect()
    assert len(kept) == 1 and kept[0].personnel_num is None


def test_retired_keys_become_tombstones(spark):
    """Cars with finished_flg = 'Y' leave the live key snapshot."""
    from ebbflow.operators import scd2

    OPEN = scd2.open_end()
    dim = spark.createDataFrame([("A1", "m1"), ("B2", "m2")], "plate string, model string").select(
        "plate", "model", F.lit(T0).cast("timestamp_ntz").alias("effective_from"), OPEN.alias("effective_to"),
        F.lit(False).alias("is_deleted"))
    pool = spark.createDataFrame([("A1", "N"), ("B2", "Y")], "plate string, finished_flg string")
    live = inc.key_snapshot(pool, ["plate"], exclude=F.col("finished_flg") == "Y")
    stg = spark.createDataFrame([], "plate string, model string, change_ts timestamp_ntz")
    out = scd2.scd2_merge(dim, stg, ["plate"], ["model"], live_keys=live, batch_ts="2024-02-01 00:00:00")
    cur = {r.plate: r.is_deleted for r in scd2.current(out).collect()}
    assert cur == {"A1": False, "B2": True}


def test_violation_count_on_a_report_day_includes_earlier_days(spark):
    ev = spark.createDataFrame([
        (1, 1, T0, 100.0), (1, 2, T0 + dt.timedelta(minutes=1), 100.0),
        (1, 3, T0 + dt.timedelta(days=1), 100.0), (1, 4, T0 + dt.timedelta(days=1, minutes=1), 0.0),
    ], "personnel_num long, ride long, ts timestamp_ntz, distance_val double")
    day2 = taxi.driver_violations(taxi.trips(ev), report_dt="2024-01-02").collect()
    # ride 1 (day 1) is the first violation, ride 2 is slow; ride 3 is the 2nd
    assert [(r.ride, r.violations_cnt) for r in day2] == [(3, 2)]


def test_single_column_incremental_filter_reaches_the_scan(spark, tmp_dir):
    spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=2))], "id long, u timestamp_ntz").write.parquet(
        f"{tmp_dir}/src")
    df = inc.incremental_scan(spark.read.parquet(f"{tmp_dir}/src"), "u", "2024-01-02 00:00:00")
    assert "GreaterThan(u," in df._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in df.collect()] == [2]
