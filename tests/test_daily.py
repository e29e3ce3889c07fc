"""The bank's daily run: three days, repeated runs, failed runs, deletes, watermarks."""

import datetime as dt

import pytest

from ebbflow.plans import daily
from ebbflow.sinks import tables

DAYS = ["2024-01-10", "2024-01-11", "2024-01-12"]
OLD = dt.datetime(2024, 1, 1)


def _source(spark, rows, cols, keys):
    df = spark.createDataFrame([(*r, OLD, None) if len(r) == len(cols.split(",")) else r for r in rows],
                               f"{cols}, create_dt timestamp_ntz, update_dt timestamp_ntz")
    names = [c.split()[0] for c in cols.split(", ")]
    return daily.Source(df, keys, [n for n in names if n not in keys])


def _day(spark, k, clients=None):
    clients = clients or [(1, "Iv", "An", None, "p1", dt.date(2024, 1, 11), "+7"), (2, "Pe", "Ol", "X", "p2", None, "+8")]
    lines = {0: ["t1;2024-01-10 09:00:00;10,00;c1;BUY;SUCCESS;A", "t2;2024-01-10 09:30:00;10,00;c1;BUY;SUCCESS;B", "bad line"],
             1: ["t2;2024-01-10 09:30:00;10,00;c1;BUY;SUCCESS;B", "t3;2024-01-11 00:10:00;5,00;c2;BUY;SUCCESS;A"],
             2: ["t4;2024-01-12 12:00:00;1,00;c1;BUY;SUCCESS;A", "", "t5;2024-01-12 13:00:00;1,00;c2;BUY;SUCCESS;B"]}[k]
    sources = {
        "clients": _source(spark, clients, "client_id long, last_name string, first_name string, patronymic string, passport_num string, "
                           "passport_valid_to date, phone string", ["client_id"]),
        "accounts": _source(spark, [("a1", 1, dt.date(2030, 1, 1)), ("a2", 2, dt.date(2024, 1, 10))], "account_num string, client long, valid_to date", ["account_num"]),
        "cards": _source(spark, [("c1 ", "a1"), ("c2 ", "a2")], "card_num string, account_num string", ["card_num"]),
        "terminals": _source(spark, [("A", "Rome"), ("B", "Oslo")], "terminal_id string, terminal_city string", ["terminal_id"]),
    }
    passports = spark.createDataFrame([(dt.date(2024, 1, 9), "p9"), *([(dt.date(2024, 1, 11), "p2")] if k else [])], "entry_dt date, passport_num string")
    ops = spark.createDataFrame([(x,) for x in lines], "value string")
    return daily.BankDay(DAYS[k], f"{DAYS[k]} 23:59:00", ops, passports, sources)


def _report(spark, root):
    return sorted((str(r.report_dt), r.event_type, r.passport, r.event_dt.isoformat()) for r in daily.fraud_report(spark, root).collect())


WANT = [("2024-01-10", 3, "p1", "2024-01-10T09:30:00"),
        ("2024-01-11", 1, "p2", "2024-01-11T00:10:00"), ("2024-01-11", 2, "p2", "2024-01-11T00:10:00"),
        ("2024-01-12", 1, "p1", "2024-01-12T12:00:00"), ("2024-01-12", 1, "p2", "2024-01-12T13:00:00"), ("2024-01-12", 2, "p2", "2024-01-12T13:00:00")]


def test_three_days_each_in_the_history(spark, tmp_dir):
    for k in range(3):
        assert daily.run(spark, tmp_dir, k + 1, _day(spark, k))
        assert _report(spark, tmp_dir) == [w for w in WANT if w[0] <= DAYS[k]]
    ops = daily.operations(spark, tmp_dir, 4)
    assert sorted(r.trans_id for r in ops.collect()) == ["t1", "t2", "t3", "t4", "t5"]  # t2 came twice
    marks = tables.latest_manifest(spark, tmp_dir)["watermarks"]
    assert set(marks.values()) == {"2024-01-01 00:00:00"}
    for k in range(3):  # repeated runs change nothing
        assert not daily.run(spark, tmp_dir, k + 1, _day(spark, k))
    assert _report(spark, tmp_dir) == WANT
    assert tables.read_appended(spark, f"{tmp_dir}/transactions_rejects", "line STRING, reason STRING").count() == 2


def test_a_run_that_failed_before_its_commit_is_repeated(spark, tmp_dir, monkeypatch):
    daily.run(spark, tmp_dir, 1, _day(spark, 0))
    with monkeypatch.context() as m:
        m.setattr(tables, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            daily.run(spark, tmp_dir, 2, _day(spark, 1))
    assert _report(spark, tmp_dir) == WANT[:1]  # nothing of the failed run is seen
    assert daily.run(spark, tmp_dir, 2, _day(spark, 1))
    assert _report(spark, tmp_dir) == WANT[:3]


def test_changes_and_deletes_reach_the_dimensions(spark, tmp_dir):
    from ebbflow.streaming.dimension import Dimension

    daily.run(spark, tmp_dir, 1, _day(spark, 0))
    first = _day(spark, 0).sources["clients"]
    changed = [(1, "Iv", "An", None, "p1", dt.date(2025, 1, 1), "+7", OLD, dt.datetime(2024, 1, 11, 8))]  # client 2 is gone
    daily.run(spark, tmp_dir, 2, _day(spark, 1, changed))
    schema = first.rows.select(*first.keys, *first.tracked, "create_dt").schema
    dim = Dimension(spark, tmp_dir, "clients", schema, first.keys, first.tracked)
    got = sorted((r.client_id, str(r.effective_from), r.is_deleted) for r in dim.open_versions().collect())
    assert got == [(1, "2024-01-11 08:00:00", False), (2, "2024-01-11 23:59:00", True)]
    assert dim.read().count() == 4
    assert tables.latest_manifest(spark, tmp_dir)["watermarks"]["clients"] == "2024-01-11 08:00:00"
