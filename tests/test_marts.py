"""Fraud rules with positive cases and counter-examples; interval sweep
against brute force; payout arithmetic."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ebbflow.plans import bank, taxi
from ebbflow.operators.intervals import rolling_clipped_sum

OPEN = dt.datetime(2262, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def _star(spark, rows):
    # card, client, fio, passport, valid_to, phone, account_valid_to
    return spark.createDataFrame(rows, "card_num string, client_id long, fio string, passport_num string, "
                                       "passport_valid_to date, phone string, account_valid_to date")


def _trans(spark, rows):
    return spark.createDataFrame(rows, "trans_id long, trans_date timestamp_ntz, card_num string, amt double, "
                                       "oper_result string, terminal string")


def _terms(spark, rows):
    return spark.createDataFrame([(t, c, T0, OPEN, False) for t, c in rows],
                                 "terminal_id string, terminal_city string, effective_from timestamp_ntz, "
                                 "effective_to timestamp_ntz, is_deleted boolean")


STAR = [("c1", 1, "A B C", "P1", dt.date(2024, 1, 10), "+1", dt.date(2024, 1, 20)),
        ("c2", 2, "D E ", "P2", None, "+2", dt.date(2024, 1, 5))]


def test_passport_rules(spark):
    star = _star(spark, STAR)
    bl = spark.createDataFrame([(dt.date(2024, 1, 3), "P2")], "entry_dt date, passport_num string")
    tr = _trans(spark, [
        (1, dt.datetime(2024, 1, 10, 23, 59), "c1", 1.0, "SUCCESS", "t1"),   # valid on its last day
        (2, dt.datetime(2024, 1, 11, 0, 0), "c1", 1.0, "SUCCESS", "t1"),     # expired
        (3, dt.datetime(2024, 1, 3, 0, 0), "c2", 1.0, "SUCCESS", "t1"),      # blacklist day, midnight: not after
        (4, dt.datetime(2024, 1, 3, 0, 1), "c2", 1.0, "SUCCESS", "t1"),      # blacklist day after midnight
    ])
    got = sorted(r.event_dt for r in bank.fraud_passport(tr, star, bl, "2024-01-01").collect())
    assert got == [dt.datetime(2024, 1, 3, 0, 1), dt.datetime(2024, 1, 11)]


def test_contract_rule(spark):
    star = _star(spark, STAR)
    tr = _trans(spark, [(1, dt.datetime(2024, 1, 20, 12), "c1", 1.0, "SUCCESS", "t"),
                        (2, dt.datetime(2024, 1, 21), "c1", 1.0, "SUCCESS", "t")])
    assert [r.event_dt for r in bank.fraud_contract(tr, star, "2024-01-01").collect()] == [dt.datetime(2024, 1, 21)]


def test_two_cities_rule(spark):
    star = _star(spark, STAR)
    terms = _terms(spark, [("t1", "X"), ("t2", "Y")])
    b = dt.datetime(2024, 1, 2, 10)
    tr = _trans(spark, [
        (1, b, "c1", 1.0, "SUCCESS", "t1"),
        (2, b + dt.timedelta(minutes=60), "c1", 1.0, "SUCCESS", "t2"),     # 60 min, other city: fraud
        (3, b + dt.timedelta(minutes=90), "c1", 1.0, "SUCCESS", "t2"),     # same city: not
        (4, b + dt.timedelta(minutes=151), "c1", 1.0, "SUCCESS", "t1"),    # 61 min later: not
        (5, b + dt.timedelta(minutes=10), "c2", 1.0, "SUCCESS", "t2"),     # other client
    ])
    got = [r.event_dt for r in bank.fraud_two_cities(tr, star, terms, "2024-01-01").collect()]
    assert got == [b + dt.timedelta(minutes=60)]


def test_amount_guessing_rule(spark):
    star = _star(spark, STAR)
    b = dt.datetime(2024, 1, 2, 10)
    m = lambda x: b + dt.timedelta(minutes=x)
    tr = _trans(spark, [
        # positive: 4 ops in 15 minutes, decreasing, R R R S
        (1, m(0), "c1", 100.0, "REJECT", "t"), (2, m(5), "c1", 90.0, "REJECT", "t"),
        (3, m(10), "c1", 80.0, "REJECT", "t"), (4, m(15), "c1", 70.0, "SUCCESS", "t"),
        # counter: 21 minutes
        (5, m(100), "c1", 100.0, "REJECT", "t"), (6, m(105), "c1", 90.0, "REJECT", "t"),
        (7, m(110), "c1", 80.0, "REJECT", "t"), (8, m(121), "c1", 70.0, "SUCCESS", "t"),
        # counter: equal amounts
        (9, m(200), "c1", 100.0, "REJECT", "t"), (10, m(201), "c1", 90.0, "REJECT", "t"),
        (11, m(202), "c1", 90.0, "REJECT", "t"), (12, m(203), "c1", 70.0, "SUCCESS", "t"),
        # counter: final reject; and a chain of 3 only
        (13, m(300), "c1", 100.0, "REJECT", "t"), (14, m(301), "c1", 90.0, "REJECT", "t"),
        (15, m(302), "c1", 80.0, "REJECT", "t"), (16, m(303), "c1", 70.0, "REJECT", "t"),
        (17, m(400), "c1", 100.0, "REJECT", "t"), (18, m(401), "c1", 90.0, "REJECT", "t"),
        (19, m(402), "c1", 80.0, "SUCCESS", "t"),
    ])
    got = [r.event_dt for r in bank.fraud_amount_guessing(tr, star, "2024-01-01").collect()]
    assert got == [m(15)]


def test_rolling_overtime_sweep_equals_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        d = rnd.choice([1, 2, 3])
        start = T0 + dt.timedelta(minutes=rnd.randrange(0, 6 * 24 * 60))
        hours = rnd.choice([0, 1, 4, 8, 9, 30])  # zero length, exactly 8 h, longer than 24 h
        rows.append((d, i, start, start + dt.timedelta(hours=hours, seconds=rnd.choice([0, 1]))))
    df = spark.createDataFrame(rows, "driver long, wid long, s timestamp_ntz, e timestamp_ntz")
    w = 24 * 3600 * 10**6
    got = {r.wid: int(r.worked_us) for r in
           rolling_clipped_sum(df, ["driver"], "s", "e", "wid", w, bucket_seconds=3600).collect()}
    us = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 10**6
    for d, i, s, e in rows:
        x = us(s) + w
        exp = sum(min(us(e2), x) - us(s2) for d2, _, s2, e2 in rows if d2 == d and us(s) <= us(s2) <= x)
        assert got[i] == exp, i


def test_driver_overtime_anchor_and_clip(spark):
    rows = [(1, 1, dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 5, 10)),
            (1, 2, dt.datetime(2024, 1, 5, 20), dt.datetime(2024, 1, 6, 10)),   # clipped at 06:00 next day
            (2, 3, dt.datetime(2024, 1, 5, 1), dt.datetime(2024, 1, 5, 9))]     # exactly 8 h: not over
    df = spark.createDataFrame(rows, "driver_pers_num long, waybill_id long, work_start_dt timestamp_ntz, "
                                     "work_end_dt timestamp_ntz")
    got = [(r.personnel_num, r.working_time_sec) for r in taxi.driver_overtime(df, "2024-01-05").collect()]
    assert got == [(1, 14 * 3600.0)]


def test_driver_payout_formula(spark):
    from decimal import Decimal

    rides = spark.createDataFrame([
        (1, 1, Decimal("100.00"), Decimal("10.00"), dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 9)),
        (2, 1, Decimal("50.00"), Decimal("5.00"), dt.datetime(2024, 1, 1, 11), None),   # cancelled
    ], "ride_id long, driver_pers_num long, price_amt decimal(12,2), distance_val decimal(5,2), "
       "ride_arrival_dt timestamp_ntz, ride_start_dt timestamp_ntz")
    drivers = spark.createDataFrame([(1, "L", "F", None, "0000 0000 0000 0001", T0, OPEN, False)],
                                    "personnel_num long, last_name string, first_name string, middle_name string, "
                                    "card_num string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
                                    "is_deleted boolean")
    r = taxi.driver_payout(rides, drivers).collect()[0]
    # 0.8*100 - 47.26*7*10/100 - 5*10
    assert r.amount == Decimal("80.00") - Decimal("33.082") - Decimal("50")


def test_violation_count_is_running(spark):
    b = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([
        (1, 1, b, 10.0), (1, 2, b + dt.timedelta(minutes=1), 10.0), (1, 3, b + dt.timedelta(minutes=2), 0.1),
        (1, 4, b + dt.timedelta(minutes=3), 10.0), (1, 5, b + dt.timedelta(minutes=3), 1.0),
    ], "personnel_num long, ride long, ts timestamp_ntz, distance_val double")
    got = sorted((r.ride, r.violations_cnt) for r in taxi.driver_violations(taxi.trips(ev)).collect())
    # ride 4 -> 5 takes 0 s: skipped, not a division by zero
    assert got == [(1, 1), (2, 2)]
    assert F is not None


def test_null_keys_keep_their_rows(spark):
    from ebbflow.plans import taxi

    d = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k long, v long")
    assert sorted((r.v, r.n) for r in taxi.partition_count(d, "k", "n").collect()) == [(1, 2), (2, 2), (3, 2), (4, 2)]
    s = spark.createDataFrame([(None, 1), (7, 2)], "driver_pers_num long, h int") \
        .selectExpr("driver_pers_num", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h) AS work_start_dt")
    assert taxi.first_value_anchor(s).where("anchor_dt = work_start_dt").count() == 2
