"""What findings of round 3 asked for: plans and jobs that grow no faster than their input."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)
MIN = dt.timedelta(minutes=1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ F1
@pytest.fixture()
def taxi_tables(spark, tmp_dir):
    """Three cars; car 0 has two waybills over ride (3, 1), of which the earlier one counts; ride (4, 1) has none."""
    orders = [(3, 7, T0), (6, 8, T0 + 2 * DAY), (4, 9, T0 + 40 * DAY)]
    lines = [(3, 1, 0, T0 + 3 * DAY), (3, 2, 0, T0 + 12 * DAY), (4, 1, 1, T0), (5, 1, 1, T0 + 50 * DAY), (5, 2, None, T0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(3).toDF("s_suppkey").write.parquet(f"{tmp_dir}/supplier.parquet")
    return tmp_dir


@pytest.mark.parametrize("name, lost", [("top1_per_key", 0), ("driver_assignment", 2)])
def test_exploded_waybills_are_not_broadcast(spark, taxi_tables, name, lost):
    from ebbflow.plans.catalog import QUERIES

    out = QUERIES[name](spark, taxi_tables)
    assert "SortMergeJoin" in _plan(out) and "Broadcast" not in _plan(out)
    got = [(r.ride_id, r.ride_line, r.waybill_num) for r in out.collect()]
    assert sorted(g for g in got if g[2]) == [(3, 1, "000003"), (3, 2, "000006"), (5, 1, "000004")]
    assert len(got) == 3 + lost


# ------------------------------------------------------------------ F2
def _jobs(spark, fn):
    """The Spark jobs that ``fn`` runs."""
    spark.sparkContext.setJobGroup(group := f"jobs-{id(fn)}", "")
    fn()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


DOCS = "id long, ts timestamp_ntz, body string"


def test_a_pull_of_many_pages_runs_as_many_jobs_as_one_of_few(spark, tmp_dir):
    from ebbflow.sinks import tables
    from ebbflow.sources.paging import Cursor, drain, pulled

    rows = [(i, T0 + (i // 70) * MIN, f"b{i}") for i in range(600)]
    spark.createDataFrame(rows[::-1], DOCS).repartition(5).write.parquet(f"{tmp_dir}/docs")
    docs, start, jobs = spark.read.parquet(f"{tmp_dir}/docs"), Cursor("2023-01-01 00:00:00"), {}
    for size in (300, 7):
        root = f"{tmp_dir}/pull{size}"
        tables.commit(spark, root, 0, {"other": 5}, {"other": "w"})
        jobs[size] = _jobs(spark, lambda: drain(docs, root, "docs", "ts", "id", start, size))  # noqa: B023
        assert spark.read.parquet(f"{root}/docs").columns == ["id", "ts", "body", "batch"]
        pages = {}
        for r in tables.read_appended(spark, f"{root}/docs", DOCS, with_batch=True).collect():
            pages.setdefault(r.batch, []).append(r.id)
        # keyset pages: the rows in (time, id) order, each page full, the last one with the rest
        assert [sorted(pages[n]) for n in sorted(pages)] == [list(range(i, min(i + size, 600))) for i in range(0, 600, size)]
        for n in sorted(pages):  # each committed with its cursor, other tables carried forward
            m = tables.latest_manifest(spark, root, before=n + 1)
            last = rows[min(n * size, 600) - 1]
            assert m["version"] == n and dict(m["tables"]) == {"docs": n, "other": 5}
            assert dict(m["watermarks"]) == {"docs.ts": last[1].isoformat(sep=" "), "docs.id": str(last[0]), "other": "w"}
        assert sorted(map(tuple, pulled(spark, root, "docs", DOCS).collect())) == rows
    assert jobs[7] <= jobs[300] + 12  # 86 pages, not 2


def test_pages_written_but_not_committed_are_taken_again(spark, tmp_dir):
    from ebbflow.sinks import tables
    from ebbflow.sources.paging import Cursor, drain, pulled

    docs, start = spark.createDataFrame([(i, T0 + i * MIN, "b") for i in range(50)], DOCS), Cursor("2023-01-01 00:00:00")
    commit, seen = tables.commit_each, []

    def stopped(spark, root, batches):
        def some():
            for b in batches:
                if b[0] == 3:
                    raise KeyboardInterrupt
                seen.append(b[0])
                yield b
        commit(spark, root, some())

    tables.commit_each = stopped
    try:
        with pytest.raises(KeyboardInterrupt):
            drain(docs, tmp_dir, "docs", "ts", "id", start, 10)
    finally:
        tables.commit_each = commit
    assert seen == [1, 2] and sorted(r.id for r in pulled(spark, tmp_dir, "docs", DOCS).collect()) == list(range(20))
    assert drain(docs, tmp_dir, "docs", "ts", "id", start, 10) == 3
    assert sorted(r.id for r in pulled(spark, tmp_dir, "docs", DOCS).collect()) == list(range(50))


# ------------------------------------------------------------------ F3
def test_drops_of_a_feed_are_written_by_several_tasks(spark, tmp_dir, monkeypatch):
    from ebbflow.plans import catalog

    lines = [(i, n, i % 5, T0 + (i + n) * MIN) for i in range(120) for n in (1, 3, 5)]
    df = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz")
    df.repartition(3).write.parquet(f"{tmp_dir}/lineitem.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_dir}/{name}")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        out = catalog.QUERIES["stream_ride_assembly"](spark, tmp_dir)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = sorted(map(tuple, out.select("ride_id", "ride_arrival_dt", "ride_start_dt", "ride_end_dt", "car_plate_num").collect()))
    assert got == [(i, T0 + (i + 1) * MIN, T0 + (i + 3) * MIN, T0 + (i + 5) * MIN, i % 5) for i in range(120)]
    base = f"{tmp_dir}/stream_ride_assembly"
    drops = [spark.read.parquet(f"{base}/src/part{i:03d}").inputFiles() for i in range(3)]
    assert [len(d) for d in drops] == [3, 3, 3]
    # as before, a micro-batch takes one drop
    batches = [spark.read.parquet(f"{base}/state/ride_parts/batch={i:012d}").select("ride").distinct().count() for i in range(3)]
    assert batches == [spark.read.parquet(*d).select("ride").distinct().count() for d in drops]


# ------------------------------------------------------------------ F4, F5
def test_a_line_is_built_and_its_fields_parsed_once(spark):
    from ebbflow.sources.rejects import PAYMENT_FIELDS, parse_lines

    good, bad = "02.01.2024 00:00:00\tc\t1,50", ["", None, "02.01.2024 00:00:00\tc", "02.01.2024 00:00:00\t \t1", "x\tc\t1", "02.01.2024 00:00:00\tc\tx"]
    src = spark.createDataFrame([(i, v) for i, v in enumerate([good, *bad])], "k long, v string").repartition(2)
    feed = parse_lines(src.select("k", F.reverse(F.reverse("v")).alias("value")), PAYMENT_FIELDS, "\t")
    for df in (feed.good, feed.rejected, feed.rows):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert [plan.count(x) for x in ("reverse(reverse(", "gettimestamp(", "split(", "try_cast(")] == [1, 1, 1, 1], plan
    assert [tuple(r) for r in feed.good.collect()] == [(T0 + DAY, "c", Decimal("1.50"))]
    assert sorted(map(tuple, feed.rejected.collect())) == \
        [(i, v, r) for i, (v, r) in enumerate(zip(bad, ["blank", "blank", "fields", "key", "time", "amount"], strict=True), 1)]
