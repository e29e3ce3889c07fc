"""Readers on real files, sinks (manifest commit, mart partitions) and a
streaming replay."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ebbflow.sinks import tables
from ebbflow.sources import files as srcf
from ebbflow.sources import incremental as inc


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_transactions_csv_with_decimal_comma(spark, tmp_dir):
    _write(tmp_dir, "transactions_01032021.txt",
           "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
           "100;2021-03-01 00:00:01;1234,50;4000 0000 0000 0001 ;PAYMENT;SUCCESS;P1\n")
    df = srcf.read_delimited(spark, tmp_dir, srcf.TRANSACTIONS_SCHEMA)
    r = df.select(srcf.decimal_comma("amount").alias("a"), srcf.file_date("file_name").alias("d"),
                  F.trim("card_num").alias("c"), "transaction_id").collect()[0]
    assert (r.a, r.d, r.c, r.transaction_id) == (Decimal("1234.50"), dt.date(2021, 3, 1), "4000 0000 0000 0001", "100")


def test_payment_tsv_file(spark, tmp_dir):
    _write(tmp_dir, "payment_2023-01-18_10-30.csv", "18.01.2023 10:29:59\t4000000000000001\t250,00\n")
    r = srcf.read_payments(spark, tmp_dir).collect()[0]
    assert (r.transaction_dt, r.card_num, r.transaction_amt) == (
        dt.datetime(2023, 1, 18, 10, 29, 59), "4000000000000001", Decimal("250.00"))


def test_xml_waybill_file_keeps_leading_zeros(spark, tmp_dir):
    _write(tmp_dir, "waybill_000001.xml",
           '<waybills><waybill number="000001" issuedt="2023-01-01T08:00:00"><car>A001AA77</car>'
           "<driver><license>12 34 567890</license></driver>"
           "<period><start>2023-01-01T09:00:00</start><stop>2023-01-01T18:00:00</stop></period></waybill>"
           "<waybill><number>000002</number><issuedt>2023-01-02T08:00:00</issuedt><car>B</car>"
           "<driver><license>L2</license></driver><period><start>2023-01-02T09:00:00</start>"
           "<stop>2023-01-02T10:00:00</stop></period></waybill></waybills>")
    rows = sorted(srcf.read_waybills(spark, tmp_dir).collect())
    assert [r.waybill_num for r in rows] == ["000001", "000002"]
    assert rows[0].work_end_dt == dt.datetime(2023, 1, 1, 18)
    assert rows[1].issue_dt == dt.datetime(2023, 1, 2, 8)


def test_pending_files_sorted_by_date_not_text(spark):
    names = spark.createDataFrame([("transactions_02012021.txt",), ("transactions_31122020.txt",),
                                   ("transactions_01012021.txt",), ("terminals_05012021.xlsx",)], "file_name string")
    got = sorted((r.file_dt, r.is_next) for r in srcf.pending_files(names, "transactions_", "2020-12-31").collect())
    assert got == [(dt.date(2021, 1, 1), True), (dt.date(2021, 1, 2), False)]


def test_list_files_reads_names_only(spark, tmp_dir):
    _write(tmp_dir, "passport_blacklist_01032021.xlsx", "x")
    assert [r.file_name for r in srcf.list_files(spark, tmp_dir).collect()] == ["passport_blacklist_01032021.xlsx"]


def test_batch_pull_includes_ties_at_the_limit(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, t + dt.timedelta(seconds=i // 2)) for i in range(10)], "id long, ts timestamp_ntz")
    got = sorted(r.id for r in inc.batch_pull(df, "ts", "id", "2023-12-31 00:00:00", 3).collect())
    assert got == [0, 1, 2, 3]   # the 3rd row's ts is shared by id 3
    assert inc.batch_pull(df, "ts", "id", "2030-01-01 00:00:00", 3).count() == 0


def test_incremental_filter_reaches_the_scan(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t, None), (2, t, t)], "id long, c timestamp_ntz, u timestamp_ntz").write.parquet(
        f"{tmp_dir}/src")
    df = inc.incremental_scan_coalesced(spark.read.parquet(f"{tmp_dir}/src"), "u", "c", "2023-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert df.count() == 2


def test_manifest_commit_and_replay(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    assert tables.read_table(spark, root, "t", "k long") .count() == 0
    tables.write_version(spark.createDataFrame([(1,)], "k long"), root, "t", 1)
    # data written but not committed: readers still see nothing
    assert tables.read_table(spark, root, "t", "k long").count() == 0
    tables.commit(spark, root, 1, {"t": 1}, {"src": "2024-01-01"})
    tables.write_version(spark.createDataFrame([(1,), (2,)], "k long"), root, "t", 2)
    tables.commit(spark, root, 2, {"t": 2})
    tables.commit(spark, root, 2, {"t": 2})   # replayed commit is harmless
    assert sorted(r.k for r in tables.read_table(spark, root, "t").collect()) == [1, 2]
    assert tables.latest_manifest(spark, root)["version"] == 2


def test_mart_rerun_replaces_only_its_report_dates(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.write_mart(spark.createDataFrame([(1, d1), (2, d2)], "x long, report_dt date"), path)
    tables.write_mart(spark.createDataFrame([(3, d2)], "x long, report_dt date"), path)
    tables.write_mart(spark.createDataFrame([(3, d2)], "x long, report_dt date"), path)  # idempotent re-run
    assert sorted((r.x, r.report_dt) for r in spark.read.parquet(path).collect()) == [(1, d1), (3, d2)]


def test_ride_assembly_stream_completes_late_rides(spark, tmp_dir):
    from ebbflow.streaming import jobs, rides

    t = dt.datetime(2024, 1, 1)
    schema = jobs.MOVE_SCHEMA
    import time

    for i, rows in enumerate([[(1, 7, "READY", t), (2, 8, "READY", t)],
                              [(1, 7, "BEGIN", t + dt.timedelta(minutes=5))],
                              [(1, 7, "END", t + dt.timedelta(minutes=30)), (2, 8, "CANCEL", t + dt.timedelta(minutes=9))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/src/p{i}")
        time.sleep(1.1)
    out = rides.ride_assembly(spark, f"{tmp_dir}/src/*/*.parquet", f"{tmp_dir}/state", f"{tmp_dir}/ckpt")
    got = sorted((r.ride, r.ride_start_dt is not None, r.ride_end_dt) for r in out.collect())
    assert got == [(1, True, t + dt.timedelta(minutes=30)), (2, False, t + dt.timedelta(minutes=9))]
    # running the stream again (nothing new) changes nothing
    again = rides.ride_assembly(spark, f"{tmp_dir}/src/*/*.parquet", f"{tmp_dir}/state", f"{tmp_dir}/ckpt")
    assert again.count() == 2


def test_fact_batch_replay_after_a_failed_attempt(spark, tmp_dir):
    """A batch that crashed after writing its directory is replayed: it must
    not see its own rows as 'already loaded' and must not duplicate them."""
    from ebbflow.operators import facts

    path = f"{tmp_dir}/fact"
    schema = "k long, v string"
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    tables.append_batch(b0, path, 0)
    b1 = spark.createDataFrame([(2, "b"), (3, "c")], schema)
    # first attempt of batch 1 writes its rows, then "crashes" before committing
    tables.append_batch(facts.dedup_append(b1, tables.read_appended(spark, path, schema, before_batch=1), ["k"]),
                        path, 1)
    # replay of batch 1
    tables.append_batch(facts.dedup_append(b1, tables.read_appended(spark, path, schema, before_batch=1), ["k"]),
                        path, 1)
    assert sorted(r.k for r in tables.read_appended(spark, path, schema).collect()) == [1, 2, 3]


def test_file_ingest_archives_consumed_files(spark, tmp_dir):
    """K6: consumed feed files are moved to the archive folder."""
    import glob

    from ebbflow.streaming import jobs

    header = "trans_id;trans_date;amount;card_num;oper_type;oper_result;terminal\n"
    for day in (1, 2, 3):
        _write(f"{tmp_dir}/in", f"transactions_0{day}032021.txt",
               header + f"{day};2021-03-0{day} 10:00:00.000000;1,50;0001;PAY;SUCCESS;T1\n")
    out = jobs.file_ingest(spark, f"{tmp_dir}/in/*.txt", f"{tmp_dir}/fact", f"{tmp_dir}/ckpt",
                           max_files=1, archive_dir=f"{tmp_dir}/archive")
    assert sorted(r.trans_id for r in out.collect()) == ["1", "2", "3"]
    # files of committed batches are moved (the last batch's file moves on the next run)
    archived = glob.glob(f"{tmp_dir}/archive/**/*.txt", recursive=True)
    assert len(archived) >= 2
    assert len(glob.glob(f"{tmp_dir}/in/*.txt")) + len(archived) == 3


def test_dimension_layout_appends_only_closed_versions(spark, tmp_dir):
    """SCD2 storage: a batch writes the versions it closed plus the open set;
    reading history + current equals the full merge."""
    import glob

    from ebbflow.operators import scd2

    root = f"{tmp_dir}/wh"
    OPEN = scd2.open_end()
    dim = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 1))],
                                "k long, a string, effective_from timestamp_ntz").select(
        "k", "a", "effective_from", OPEN.alias("effective_to"), F.lit(False).alias("is_deleted"))
    tables.write_dimension(dim, root, "d", 0)
    tables.commit(spark, root, 0, {"d": 0})
    stg = spark.createDataFrame([(1, "z", dt.datetime(2024, 1, 2))], "k long, a string, change_ts timestamp_ntz")
    cur = tables.read_dimension(spark, root, "d")
    full = scd2.scd2_merge(cur, stg, ["k"], ["a"])
    _, from_open = scd2.scd2_merge(cur, stg, ["k"], ["a"], split=True)
    tables.write_dimension(from_open, root, "d", 1)
    tables.commit(spark, root, 1, {"d": 1})
    got = sorted(map(tuple, tables.read_dimension(spark, root, "d").collect()), key=repr)
    assert got == sorted(map(tuple, full.collect()), key=repr) and len(got) == 3
    hist1 = spark.read.parquet(glob.glob(f"{root}/d/v=000000000001/part=history")[0]).collect()
    assert [(r.k, r.a) for r in hist1] == [(1, "a")]   # only the version closed by batch 1


def test_merge_on_read_upsert_with_compaction(spark, tmp_dir):
    """Deltas + compaction give the same current rows as reading all deltas."""
    from ebbflow.streaming import jobs

    root = f"{tmp_dir}/docs"
    t = dt.datetime(2024, 1, 1)
    batches = [[(1, 7, '{"k": 1}', t), (2, 8, '{"k": 2}', t)],
               [(3, 7, '{"k": 3}', t + dt.timedelta(hours=1))],
               [(4, 8, '{"k": 4}', t + dt.timedelta(hours=2)), (5, 9, '{"k": 5}', t)]]
    for i, rows in enumerate(batches):
        tables.append_batch(spark.createDataFrame(rows, jobs.DOC_SCHEMA), f"{root}/documents", i)
    before = sorted(map(tuple, jobs.read_upserted(spark, root).collect()))
    jobs.compact_upserted(spark, root, 1)
    after = sorted(map(tuple, jobs.read_upserted(spark, root).collect()))
    assert before == after == [(3, 7, '{"k": 3}', t + dt.timedelta(hours=1)),
                               (4, 8, '{"k": 4}', t + dt.timedelta(hours=2)), (5, 9, '{"k": 5}', t)]


def test_file_ingest_keeps_text_ids_and_whole_seconds(spark, tmp_dir):
    import os

    from ebbflow.streaming import jobs

    os.makedirs(f"{tmp_dir}/in2")
    with open(f"{tmp_dir}/in2/a.txt", "w") as f:
        f.write("trans_id;trans_date;amount;card_num;oper_type;oper_result;terminal\n"
                "A1;2021-03-01 00:00:12;1,50;1;PAY;SUCCESS;T1\nA2;2021-03-01 00:00:12.5;2,50;1;PAY;SUCCESS;T1\n")
    out = jobs.file_ingest(spark, f"{tmp_dir}/in2/*.txt", f"{tmp_dir}/fact2", f"{tmp_dir}/ckpt2").collect()
    assert sorted((r.trans_id, str(r.amt)) for r in out) == [("A1", "1.50"), ("A2", "2.50")]
    assert all(r.trans_date is not None for r in out if r.trans_id == "A1")


def test_commit_carries_other_tables_and_watermarks(spark, tmp_dir):
    from ebbflow.sinks import tables

    root = f"{tmp_dir}/wh"
    for v, t in ((1, "t1"), (2, "t2")):
        tables.write_version(spark.range(v), root, t, v)
        tables.commit(spark, root, v, {t: v}, {t: f"w{v}"})
    assert tables.read_table(spark, root, "t1").count() == 1
    assert tables.read_table(spark, root, "t2").count() == 2
    assert dict(tables.latest_manifest(spark, root)["watermarks"]) == {"t1": "w1", "t2": "w2"}


def test_batch_pull_without_a_limit_takes_every_row(spark):
    from ebbflow.sources import incremental as inc

    df = spark.range(30_000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")
    assert inc.batch_pull(df, "ts", "id", "2023-12-31 00:00:00").count() == 30_000
