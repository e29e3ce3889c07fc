"""The taxi's daily run: three days with late events, a failed run and a repeated one; reports equal those of the whole history."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbflow.plans import daily, taxi, taxi_daily
from ebbflow.sinks import tables
from ebbflow.streaming.dimension import Dimension

OLD = dt.datetime(2024, 1, 1)
DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]
RIDES = {0: [(1, "+1", 40, 900), (2, "+2", 10, 500)], 1: [(3, "+1", 90, 2000), (1, "+1", 40, 900)], 2: [(4, "+2", 5, 100)]}
MOVES = {
    0: [(1, "A", "READY", "2024-03-01 09:00:00"), (1, "A", "BEGIN", "2024-03-01 09:10:00"), (1, "A", "END", "2024-03-01 09:30:00"),
        (2, "A", "READY", "2024-03-01 23:50:00"), (2, "A", "END", "2024-03-02 00:20:00")],  # the BEGIN comes a day late
    1: [(2, "A", "BEGIN", "2024-03-01 23:55:00"), (3, "B", "READY", "2024-03-02 10:00:00"), (3, "B", "BEGIN", "2024-03-02 10:00:00")],
    2: [(3, "B", "END", "2024-03-02 10:45:00"), (4, "A", "READY", "2024-03-03 08:00:00"), (4, "A", "CANCEL", "2024-03-03 08:05:00"), (None, "A", "END", "2024-03-03 08:05:00")],
}
WAYBILLS = {
    0: [("w1", "L1", "A", "2024-03-01 08:00:00", "2024-03-02 01:00:00"), ("w2", "L1", None, "2024-03-02 08:00:00", None)],
    1: [("w2", None, "B", None, "2024-03-02 18:00:00"), ("w3", "L2", "A", "2024-03-03 07:00:00", "2024-03-03 10:00:00")],
    2: [],
}
PAYMENTS = {0: ["01.03.2024 10:00:00\tc1\t500,00", ""], 1: ["01.03.2024 10:00:00\tc1\t500,00"], 2: ["03.03.2024 10:00:00\tc2\tx"]}


def _source(spark, rows, ddl, keys, retired=None):
    df = spark.createDataFrame([(*r, OLD, None) for r in rows], f"{ddl}, create_dt timestamp_ntz, update_dt timestamp_ntz")
    return daily.Source(df, keys, [c.split()[0] for c in ddl.split(", ") if c.split()[0] not in keys], retired)


def _ts(x):
    return None if x is None else dt.datetime.fromisoformat(x)


def _day(spark, k):
    sources = {
        "clients": _source(spark, [("+1", "c 1"), ("+2", "c 2")], "phone_num string, card_num string", ["phone_num"]),
        "drivers": _source(spark, [(11, "Iv", "An", None, "d1", "L1"), (12, "Pe", "Ol", "X", "d2", "L2")], "personnel_num long, last_name string, "
                           "first_name string, middle_name string, card_num string, driver_license_num string", ["personnel_num"]),
        "cars": _source(spark, [("A", "N"), ("B", "Y" if k == 2 else "N")], "plate_num string, finished_flg string", ["plate_num"], F.col("finished_flg") == "Y"),
    }
    rides = spark.createDataFrame([(i, p, Decimal(d), Decimal(a)) for i, p, d, a in RIDES[k]], "ride_id long, client_phone string, distance decimal(5,2), price decimal(12,2)")
    moves = spark.createDataFrame([(r, c, e, _ts(t)) for r, c, e, t in MOVES[k]], "ride long, car_plate_num string, event string, dt timestamp_ntz")
    ways = spark.createDataFrame([(n, d, c, _ts(a), _ts(b), None) for n, d, c, a, b in WAYBILLS[k]], taxi_daily.WAYBILL_PARTS)
    pays = spark.createDataFrame([(x,) for x in PAYMENTS[k]], "value string")
    return taxi_daily.TaxiDay(DAYS[k], f"{DAYS[k]} 23:59:00", rides, moves, ways, pays, sources)


def _payout(rows):
    return sorted((r.personnel_num, str(r.report_dt), float(r.amount)) for r in rows)


def test_three_days_with_late_events(spark, tmp_dir, monkeypatch):
    read = lambda name, schema: tables.read_report(spark, tmp_dir, name, schema).collect()
    assert taxi_daily.run(spark, tmp_dir, 1, _day(spark, 0))
    pay = lambda price, km: 0.8 * price - 47.26 * 7 / 100 * km - 5 * km
    assert _payout(read("rep_payout", taxi_daily.PAYOUT)) == [(11, "2024-03-01", pytest.approx(pay(900, 40)))]  # ride 2 looks cancelled
    assert [(r.personnel_num, r.ride, r.speed, r.violations_cnt) for r in read("rep_violations", taxi_daily.VIOLATIONS)] == [(11, 1, 120.0, 1)]
    assert [(r.personnel_num, r.waybill_num, r.working_time_sec) for r in read("rep_overtime", taxi_daily.OVERTIME)] == [(11, "w1", 17 * 3600.0)]

    with monkeypatch.context() as m:
        m.setattr(tables, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            taxi_daily.run(spark, tmp_dir, 2, _day(spark, 1))
    assert len(read("rep_payout", taxi_daily.PAYOUT)) == 1  # nothing of the failed run is seen
    assert taxi_daily.run(spark, tmp_dir, 2, _day(spark, 1))
    assert _payout(read("rep_payout", taxi_daily.PAYOUT)) == [(11, "2024-03-01", pytest.approx(pay(900, 40) + pay(500, 10)))]  # the late BEGIN pays
    assert taxi_daily.run(spark, tmp_dir, 3, _day(spark, 2))
    assert not taxi_daily.run(spark, tmp_dir, 3, _day(spark, 2))

    fact = taxi_daily.fact_rides(spark, tmp_dir, 4)
    assert sorted((r.ride_id, r.driver_pers_num, r.ride_start_dt is None) for r in fact.collect()) == [(1, 11, False), (2, 11, False), (3, 11, False), (4, 12, True)]
    drivers = Dimension(spark, tmp_dir, "drivers", "personnel_num long, last_name string, first_name string, middle_name string, card_num string, "
                        "driver_license_num string, change_ts timestamp_ntz", ["personnel_num"],
                        ["last_name", "first_name", "middle_name", "card_num", "driver_license_num"]).read()
    assert _payout(read("rep_payout", taxi_daily.PAYOUT)) == _payout(taxi.driver_payout(fact, drivers).collect())
    assert sorted((r.ride, r.violations_cnt, str(r.report_dt)) for r in read("rep_violations", taxi_daily.VIOLATIONS)) == [(1, 1, "2024-03-01"), (3, 2, "2024-03-03")]

    cars = Dimension(spark, tmp_dir, "cars", "plate_num string, finished_flg string, change_ts timestamp_ntz", ["plate_num"], ["finished_flg"])
    assert {r.plate_num: r.is_deleted for r in cars.open_versions().collect()} == {"A": False, "B": True}
    metrics = Dimension(spark, tmp_dir, "client_metrics", "phone_num string, rides_cnt long, cancelled_cnt long, spent_amt decimal(22,2), debt_amt decimal(22,2), "
                        "change_ts timestamp_ntz", ["phone_num"], taxi.METRIC_COLS)
    now = {r.phone_num: (r.rides_cnt, r.cancelled_cnt, int(r.spent_amt), int(r.debt_amt)) for r in metrics.open_versions().collect()}
    assert now == {"+1": (2, 0, 2900, 2400), "+2": (1, 1, 500, 500)}
    was = sorted((r.phone_num, str(r.effective_from)[:10], r.rides_cnt, r.cancelled_cnt) for r in metrics.read().collect())
    assert was == [("+1", "2024-03-01", 1, 0), ("+1", "2024-03-03", 2, 0), ("+2", "2024-03-01", 0, 1), ("+2", "2024-03-02", 1, 0), ("+2", "2024-03-03", 1, 1)]
    assert tables.read_appended(spark, f"{tmp_dir}/payments_rejects", "line STRING, reason STRING").count() == 2
