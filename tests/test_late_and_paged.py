"""Ride events in any order, paged pulls, bad records, daily speeding runs, the overtime waybill, unknown terminals."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
MIN = dt.timedelta(minutes=1)
MOVE = "ride BIGINT, car_plate_num BIGINT, event STRING, dt TIMESTAMP_NTZ"


# ------------------------------------------------------------------ T4
def _drops(spark, path, drops):
    import os
    import time

    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, MOVE).coalesce(1).write.parquet(f"{path}/p{i}")
        for f in os.listdir(f"{path}/p{i}"):  # file sources go by modification time
            os.utime(f"{path}/p{i}/{f}", (time.time() - 1000 + 10 * i,) * 2)


def test_rides_are_whole_in_any_order_of_drops(spark, tmp_dir):
    from ebbflow.streaming import rides

    events = {"READY": T0, "BEGIN": T0 + 5 * MIN, "END": T0 + 30 * MIN}
    orders = list(itertools.permutations(events))
    drops = [[(i, 100 + i, o[k], events[o[k]]) for i, o in enumerate(orders)] for k in range(3)]
    drops[0] += [(50, 1, "READY", T0), (50, 1, "END", T0 + 9 * MIN), (60, 2, "READY", T0), (None, 3, "END", T0)]
    drops[1] += [(70, 2, "BEGIN", T0)]
    drops[2] += [(50, 1, "BEGIN", T0 + 2 * MIN)]
    _drops(spark, f"{tmp_dir}/src", drops)
    out = rides.ride_assembly(spark, f"{tmp_dir}/src/*/*.parquet", f"{tmp_dir}/state", f"{tmp_dir}/ckpt")
    want = [(i, T0, events["BEGIN"], events["END"], 100 + i) for i in range(6)] + [(50, T0, T0 + 2 * MIN, T0 + 9 * MIN, 1)]
    assert sorted(map(tuple, out.collect())) == want
    assert sorted((r.ride, r.ride_arrival_dt, r.ride_start_dt) for r in rides.pending_rides(spark, f"{tmp_dir}/state").collect()) == \
        [(60, T0, None), (70, None, T0)]


def test_rides_after_compaction(spark, tmp_dir):
    from ebbflow.sinks import tables
    from ebbflow.streaming import rides

    r = random.Random(1)
    events = [(i, i, e, T0 + k * MIN) for i in range(40) for k, e in enumerate(["READY", "BEGIN", "END"]) if r.random() < 0.9]
    r.shuffle(events)
    _drops(spark, f"{tmp_dir}/src", [events[k::4] for k in range(4)])
    root = f"{tmp_dir}/state"
    run = lambda: rides.ride_assembly(spark, f"{tmp_dir}/src/*/*.parquet", root, f"{tmp_dir}/ckpt", buckets=3)
    before = sorted(map(tuple, run().collect()))
    for upto in (1, 2, 2):
        rides.compact_rides(spark, root, upto, buckets=3)
        assert sorted(map(tuple, rides.finished_rides(spark, root).collect())) == before
    assert tables.latest_manifest(spark, root)["tables"] == {"rides_base": 2}
    some = rides.rides(spark, root, buckets=[1]).collect()
    assert 0 < len(some) < 40
    assert sorted(map(tuple, run().collect())) == before


# ------------------------------------------------------------------ S11, S12, D30
@pytest.fixture()
def docs(spark):
    rows = [(i, T0 + (i // 40) * MIN, f'{{"name": "n{i}"}}') for i in range(500)] + [(None, T0 + MIN, "{}"), (900, None, "{}")]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, body string")


@pytest.mark.parametrize("size", [None, 7, 40, 1000])
def test_page_size_does_not_change_the_pull(spark, docs, tmp_dir, size):
    from ebbflow.sources.paging import Cursor, drain, pulled

    n = drain(docs, tmp_dir, "docs", "ts", "id", Cursor("2024-01-01 00:00:00"), size)
    got = [r.id for r in pulled(spark, tmp_dir, "docs", "id long, ts timestamp_ntz, body string").collect()]
    assert sorted(got) == list(range(40, 500)) and n == (1 if size in (None, 1000) else -(-460 // size))
    assert drain(docs, tmp_dir, "docs", "ts", "id", Cursor("2024-01-01 00:00:00"), size) == 0


def test_a_stopped_pull_goes_on_inside_a_tie(spark, docs, tmp_dir):
    from ebbflow.sources.paging import Cursor, drain, pulled

    start = Cursor("2023-01-01 00:00:00")
    assert drain(docs, tmp_dir, "docs", "ts", "id", start, 25, max_pages=2) == 2  # 50 rows: ten of the second tie
    schema = "id long, ts timestamp_ntz, body string"
    assert sorted(r.id for r in pulled(spark, tmp_dir, "docs", schema).collect()) == list(range(50))
    drain(docs, tmp_dir, "docs", "ts", "id", start, 25)
    assert sorted(r.id for r in pulled(spark, tmp_dir, "docs", schema).collect()) == list(range(500))


def test_a_changed_document_with_a_known_id_is_taken_up(spark, docs):
    from ebbflow.sources.paging import changed_documents, last_position

    cursor = last_position(docs.filter("id IS NOT NULL"), "ts", "id")
    assert cursor.id == 499
    now = docs.filter("id != 7").unionByName(spark.createDataFrame([(7, T0 + 99 * MIN, '{"name": "new"}')], docs.schema))
    got = changed_documents(now, "ts", "id", cursor, "body", {"name": "$.name"}, ["id"]).collect()
    assert [(r.id, r.name) for r in got] == [(7, "new")]


# ------------------------------------------------------------------ S4, S5, T1
def test_bad_payment_lines_are_rejected_with_a_reason(spark, tmp_dir):
    from ebbflow.sources import files
    from ebbflow.sources.rejects import PAYMENT_FIELDS, read_feed

    lines = ["01.02.2024 10:00:00\t4000 1\t12,50", "", "   \t ", "01.02.2024 10:00:00\t4000", "31.02.2024 10:00:00\tc\t1,0", "01.02.2024 10:00:00\tc\tx",
             "01.02.2024 10:00:00\t \t1,0", "01.02.2024 10:00:00\tc\t1\t2", "02.02.2024 00:00:00\tc2\t7\r"]
    import os

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/payment_1.txt", "w", newline="") as f:
        f.write("\n".join(lines))
    feed, seen = read_feed(spark, f"{tmp_dir}/in", PAYMENT_FIELDS, "\t").observed()
    rows = feed.rows.collect()
    assert [r.reason for r in rows] == [None, "blank", "blank", "fields", "time", "amount", "key", "fields", None]
    assert seen.get == {"lines": 9, "rejected": 7}
    assert {r.file_name for r in feed.rejected.collect()} == {"payment_1.txt"}
    good = files.read_payments(spark, f"{tmp_dir}/in").collect()
    assert sorted((r.card_num, str(r.transaction_amt)) for r in good) == [("4000 1", "12.50"), ("c2", "7.00")]


def test_file_ingest_keeps_bad_lines_apart(spark, tmp_dir):
    import os

    from ebbflow.streaming import jobs

    os.makedirs(f"{tmp_dir}/in")
    head = "trans_id;trans_date;amount;card_num;oper_type;oper_result;terminal"
    for i, body in enumerate([["a1;2024-01-01 10:00:00;1,5;c1;BUY;SUCCESS;T1", "", "a2;bad;1,5;c;BUY;SUCCESS;T1"], ["a3;2024-01-01 10:00:00;x;c;BUY;SUCCESS;T1", "short"]]):
        with open(f"{tmp_dir}/in/transactions_{i}.csv", "w") as f:
            f.write("\n".join([head, *body]) + "\n")
    out = jobs.file_ingest(spark, f"{tmp_dir}/in/*.csv", f"{tmp_dir}/fact", f"{tmp_dir}/ckpt")
    assert [(r.trans_id, str(r.amt)) for r in out.collect()] == [("a1", "1.50")]
    assert sorted(r.reason for r in jobs.rejected_lines(spark, f"{tmp_dir}/fact").collect()) == ["amount", "blank", "fields", "time"]


# ------------------------------------------------------------------ M6
def test_daily_speeding_runs_equal_the_whole_history(spark):
    from ebbflow.plans import speeding, taxi

    r = random.Random(3)
    rows = [(r.randint(1, 6), i, T0 + dt.timedelta(seconds=r.randint(0, 4 * 86_400)), float(r.randint(1, 900))) for i in range(400)]
    rows += [(9, 1000, T0 + dt.timedelta(hours=1), 5000.0), (9, 1001, T0 + dt.timedelta(days=3, hours=1), 1.0)]  # no position for two days
    schema = "personnel_num long, ride long, ts timestamp_ntz, distance_val double"
    events = spark.createDataFrame(rows, schema)
    whole = sorted(map(tuple, taxi.driver_violations(taxi.trips(events)).collect()))
    positions = spark.createDataFrame([], schema)
    counts = spark.createDataFrame([], "personnel_num long, violations_cnt long")
    got = []
    for day in range(5):
        a, b = T0 + dt.timedelta(days=day), T0 + dt.timedelta(days=day + 1)
        run = speeding.speeding_day(events.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz"))), positions, counts)
        got += list(map(tuple, run.violations.select("personnel_num", "ride", "speed", "violations_cnt", "report_dt").collect()))
        positions = spark.createDataFrame(run.positions.select(*events.columns).collect(), schema)
        counts = spark.createDataFrame(run.counts.collect(), counts.schema)
    assert len(whole) > 20 and sorted(got) == whole


# ------------------------------------------------------------------ M7
def _brute_overtime(rows, limit, window):
    out = []
    for d, w, s, _ in rows:
        x, so_far, hit = s + window, dt.timedelta(0), None
        inside = sorted((t, v, e) for q, v, t, e in rows if q == d and s <= t <= x)
        for t, v, e in inside:
            so_far += min(e, x) - t
            if so_far > limit and hit is None:
                hit = v, t
        if hit:
            out.append((d, s, so_far // dt.timedelta(microseconds=1), *hit))
    return sorted(out)


@pytest.mark.parametrize("kind", ["shifts", "overlapping", "long"])
def test_overtime_waybill_against_all_pairs(spark, kind):
    from ebbflow.operators.overtime import first_over_limit

    r = random.Random(kind)
    rows, w = [], 0
    for d in range(4):
        t = T0
        for _ in range(60 if d else 150):  # a busy driver
            hours = {"shifts": r.choice([0, 2, 4, 8]), "overlapping": r.choice([1, 3, 5]), "long": r.choice([1, 6, 30, 50])}[kind]
            t += {"shifts": dt.timedelta(hours=r.choice([hours, 8, 12])), "overlapping": dt.timedelta(hours=r.choice([0, 1, 2])),
                  "long": dt.timedelta(hours=r.choice([2, 9, 24]))}[kind]
            rows.append((d, w, t, t + dt.timedelta(hours=hours)))
            w += 1
    df = spark.createDataFrame([*rows, (None, -1, T0, T0 + MIN), (1, -2, T0, None)],
                               "driver_pers_num long, waybill_id long, work_start_dt timestamp_ntz, work_end_dt timestamp_ntz")
    got = first_over_limit(df, bucket_seconds=7200).select("driver", "period_start", F.col("worked_us").cast("long"), "waybill", "waybill_start").collect()
    want = _brute_overtime(rows, dt.timedelta(hours=8), dt.timedelta(hours=24))
    assert len(want) > 30 and sorted(map(tuple, got)) == want


# ------------------------------------------------------------------ M3
def test_last_known_value_crosses_buckets_and_gaps(spark):
    from ebbflow.operators.windows import last_known_within_key

    r = random.Random(8)
    rows = [(r.choice([1, 1, 1, 2, None]), T0 + dt.timedelta(seconds=37 * i), i, r.choice(["X", "Y", None, None, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, city string")
    got = last_known_within_key(df, ["k"], ["ts", "id"], ["city", "id"], F.col("city").isNotNull(), "p", bucket_seconds=60).collect()
    seen, want = {}, {}
    for k, _, i, c in rows:
        want[i] = seen.get(k, (None, None))
        if c is not None:
            seen[k] = c, i
    assert {x.id: (x.p_city, x.p_id) for x in got} == want


def test_two_cities_across_an_unknown_terminal(spark):
    from tests.test_marts import STAR, _star, _terms, _trans

    from ebbflow.plans import bank

    b = dt.datetime(2024, 1, 2, 10)
    star, terms = _star(spark, STAR), _terms(spark, [("t1", "X"), ("t2", "Y")])
    tr = _trans(spark, [(1, b, "c1", 1.0, "SUCCESS", "t1"), (2, b + 10 * MIN, "c1", 1.0, "SUCCESS", "nowhere"),
                        (3, b + 20 * MIN, "c1", 1.0, "SUCCESS", "t2"), (4, b + 300 * MIN, "c1", 1.0, "SUCCESS", "nowhere")])
    got = [r.event_dt for r in bank.fraud_two_cities(tr, star, terms, "2024-01-01", bucket_seconds=300).collect()]
    assert got == [b + 20 * MIN]
    bl = spark.createDataFrame([], "passport_num string, entry_dt date")
    mart = bank.fraud_mart(tr, star, bl, terms, "2024-01-01", bucket_seconds=300).filter("event_type = 3").collect()
    assert [r.event_dt for r in mart] == [b + 20 * MIN]
