"""SCD2 merge on hand-made cases (NULL changes, re-delivery, chains,
deletes, resurrection, change + delete in one batch) and invariants."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ebbflow.operators import scd2

OPEN = dt.datetime(2262, 1, 1)
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 2, 12)
NOW = "2024-01-03 00:00:00"
NOW_DT = dt.datetime(2024, 1, 3)
GAP = dt.timedelta(seconds=15)

DIM = "k long, a string, b double, effective_from timestamp_ntz, effective_to timestamp_ntz, is_deleted boolean"
STG = "k long, a string, b double, change_ts timestamp_ntz"


def _dim(spark, rows):
    return spark.createDataFrame(rows, DIM)


def _merge(spark, dim_rows, stg_rows, live=None, **kw):
    dim = _dim(spark, dim_rows)
    stg = spark.createDataFrame(stg_rows, STG)
    live_df = spark.createDataFrame([(k,) for k in live], "k long") if live is not None else None
    out = scd2.scd2_merge(dim, stg, ["k"], ["a", "b"], live_keys=live_df, batch_ts=NOW if live is not None else None, **kw)
    return _sorted(tuple(r) for r in out.collect())


def _sorted(rows):
    return sorted(rows, key=repr)


def test_null_to_value_and_value_to_null(spark):
    got = _merge(spark, [(1, "x", None, T0, OPEN, False), (2, "y", 1.0, T0, OPEN, False)],
                 [(1, "x", 5.0, T1), (2, "y", None, T1)])
    assert got == _sorted([
        (1, "x", None, T0, T1 - GAP, False), (1, "x", 5.0, T1, OPEN, False),
        (2, "y", 1.0, T0, T1 - GAP, False), (2, "y", None, T1, OPEN, False),
    ])


def test_redelivery_is_a_noop(spark):
    rows = [(1, "x", 1.0, T0, OPEN, False)]
    assert _merge(spark, rows, [(1, "x", 1.0, T1)]) == rows
    # an older replay is ignored as well
    assert _merge(spark, [(1, "x", 2.0, T1, OPEN, False)], [(1, "x", 1.0, T0)]) == [(1, "x", 2.0, T1, OPEN, False)]


def test_two_changes_in_one_batch_are_chained(spark):
    got = _merge(spark, [(1, "x", 1.0, T0, OPEN, False)],
                 [(1, "x", 2.0, T1), (1, "x", 3.0, T2), (1, "x", 3.0, T2 + dt.timedelta(hours=1))])
    assert got == _sorted([
        (1, "x", 1.0, T0, T1 - GAP, False),
        (1, "x", 2.0, T1, T2 - GAP, False),
        (1, "x", 3.0, T2, OPEN, False),
    ])


def test_duplicate_staging_rows(spark):
    got = _merge(spark, [], [(5, "n", 1.0, T1), (5, "n", 1.0, T1)])
    assert got == [(5, "n", 1.0, T1, OPEN, False)]


def test_delete_and_new_key(spark):
    got = _merge(spark, [(1, "x", 1.0, T0, OPEN, False), (2, "y", 2.0, T0, OPEN, False)],
                 [(3, "z", 3.0, T1)], live=[1, 3])
    assert got == _sorted([
        (1, "x", 1.0, T0, OPEN, False),
        (2, "y", 2.0, T0, NOW_DT - GAP, False), (2, "y", 2.0, NOW_DT, OPEN, True),
        (3, "z", 3.0, T1, OPEN, False),
    ])


def test_resurrection_reopens_a_tombstoned_key(spark):
    got = _merge(spark, [(1, "x", 1.0, T0, T1 - GAP, False), (1, "x", 1.0, T1, OPEN, True)],
                 [(1, "x", 1.0, T2)], live=[1])
    assert got == _sorted([
        (1, "x", 1.0, T0, T1 - GAP, False),
        (1, "x", 1.0, T1, T2 - GAP, True),
        (1, "x", 1.0, T2, OPEN, False),
    ])


def test_changed_and_deleted_in_one_batch(spark):
    got = _merge(spark, [(1, "x", 1.0, T0, OPEN, False)], [(1, "x", 2.0, T1)], live=[])
    assert got == _sorted([
        (1, "x", 1.0, T0, T1 - GAP, False),
        (1, "x", 2.0, T1, NOW_DT - GAP, False),
        (1, "x", 2.0, NOW_DT, OPEN, True),
    ])


def test_empty_batch_keeps_dimension(spark):
    rows = [(1, "x", 1.0, T0, OPEN, False)]
    assert _merge(spark, rows, []) == rows


def test_surrogate_ids_carry_and_are_dense(spark):
    dim = spark.createDataFrame([(1, "x", 1.0, T0, OPEN, False, 10)], DIM + ", sk long")
    stg = spark.createDataFrame([(1, "x", 2.0, T1), (7, "q", 1.0, T1), (4, "p", 1.0, T1)], STG)
    out = scd2.scd2_merge(dim, stg, ["k"], ["a", "b"], surrogate="sk")
    got = sorted((r.k, r.effective_from, r.sk) for r in out.collect())
    assert got == [(1, T0, 10), (1, T1, 10), (4, T1, 11), (7, T1, 12)]


def test_invariants_on_random_change_logs(spark):
    rnd = random.Random(3)
    dim_rows = [(k, "a", float(k), T0, OPEN, False) for k in range(30)]
    stg_rows = []
    for k in range(40):
        for j in range(rnd.randrange(0, 4)):
            stg_rows.append((k, rnd.choice(["a", "b", None]), float(rnd.randrange(3)),
                             T1 + dt.timedelta(minutes=rnd.randrange(0, 3000))))
    stg_rows = list({(r[0], r[3]): r for r in stg_rows}.values())  # one row per (key, ts)
    live = [k for k in range(40) if rnd.random() < 0.8]
    dim = _dim(spark, dim_rows)
    stg = spark.createDataFrame(stg_rows, STG)
    live_df = spark.createDataFrame([(k,) for k in live], "k long")
    out = scd2.scd2_merge(dim, stg, ["k"], ["a", "b"], live_keys=live_df, batch_ts="2030-01-01 00:00:00").cache()
    rows = out.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    for k, vs in by_key.items():
        vs.sort(key=lambda r: r.effective_from)
        assert sum(1 for r in vs if r.effective_to == OPEN) == 1, k
        for a, b in zip(vs, vs[1:]):
            assert a.effective_to == b.effective_from - GAP
        cur = vs[-1]
        assert cur.is_deleted == (k not in live)
    # re-applying the same batch changes nothing (replay is a no-op)
    again = scd2.scd2_merge(out, stg, ["k"], ["a", "b"], live_keys=live_df, batch_ts="2030-01-01 00:00:00")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_history_from_events(spark):
    ev = spark.createDataFrame([
        (1, "A", T0, 1), (1, "A", T1, 2), (1, "B", T2, 3), (1, "C", T2, 4), (1, "C", NOW_DT, 5),
    ], "c long, v string, t timestamp_ntz, o long")
    got = _sorted(tuple(r) for r in scd2.history_from_events(ev, ["c"], ["v"], "t", "o").collect())
    # at T2 the last value (by tie-breaker) wins: C
    assert got == [(1, "A", T0, T2 - GAP), (1, "C", T2, OPEN)]


def test_current_view_prunes_closed(spark):
    d = _dim(spark, [(1, "x", 1.0, T0, T1 - GAP, False), (1, "x", 2.0, T1, OPEN, False), (2, "q", 1.0, T0, OPEN, True)])
    assert sorted(r.k for r in scd2.current(d).collect()) == [1, 2]
    assert [r.k for r in scd2.current(d, include_deleted=False).collect()] == [1]
    assert d.filter(F.col("k") == 1).count() == 2


def test_ties_and_close_changes_have_no_inverted_intervals(spark):
    soon = T1 + dt.timedelta(seconds=5)
    got = _merge(spark, [(1, "x", 1.0, T0, OPEN, False)], [(1, "p", 2.0, T1), (1, "q", 2.0, T1), (1, "r", 2.0, soon)])
    assert len(got) == 3 and all(r[4] >= r[3] for r in got)
    assert sum(r[3] == T1 for r in got) == 1 and [r for r in got if r[4] == OPEN] == [(1, "r", 2.0, soon, OPEN, False)]


def test_tiebreak_column_decides(spark):
    stg = spark.createDataFrame([(1, "p", 2.0, T1, 9), (1, "q", 2.0, T1, 3)], STG + ", seq int")
    out = scd2.scd2_merge(_dim(spark, []), stg, ["k"], ["a", "b"], tiebreak="seq")
    assert [r.a for r in out.collect()] == ["p"]


def test_open_end_is_a_parameter(spark):
    end = dt.datetime(2999, 12, 31)
    dim = _dim(spark, [(1, "x", 1.0, T0, end, False), (2, "y", 1.0, T0, end, False)])
    stg = spark.createDataFrame([(1, "z", 1.0, T1)], STG)
    live = spark.createDataFrame([(1,)], "k long")
    out = scd2.scd2_merge(dim, stg, ["k"], ["a", "b"], live_keys=live, batch_ts=NOW, end="2999-12-31 00:00:00")
    opened = scd2.current(out, end="2999-12-31 00:00:00").collect()
    assert sorted((r.k, r.a, r.is_deleted) for r in opened) == [(1, "z", False), (2, "y", True)]


def test_late_changes_are_returned(spark):
    dim = _dim(spark, [(1, "x", 1.0, T0, T2 - GAP, False), (1, "y", 1.0, T2, OPEN, False)])
    stg = spark.createDataFrame([(1, "x", 1.0, T0), (1, "y", 1.0, T2), (1, "x", 1.0, T1), (1, "late", 1.0, T1), (2, "new", 1.0, T1)], STG)
    assert [r.a for r in scd2.late_changes(dim, stg, ["k"], ["a", "b"]).collect()] == ["late"]


def test_merge_needs_few_exchanges(spark):
    dim, stg = _dim(spark, [(1, "x", 1.0, T0, OPEN, False)]), spark.createDataFrame([(1, "y", 1.0, T1)], STG)
    live = spark.createDataFrame([(1,)], "k long")
    plan = scd2.scd2_merge(dim, stg, ["k"], ["a", "b"], live_keys=live, batch_ts=NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan


def test_steps_with_another_open_end(spark):
    """H1 to H5 on a dimension whose open versions end in 2999."""
    end = "2999-12-31 00:00:00"
    dim = spark.sql(f"SELECT k, 'x' AS a, TIMESTAMP_NTZ '2024-01-01' AS effective_from, TIMESTAMP_NTZ '{end}' AS effective_to, false AS is_deleted "
                    "FROM VALUES (1L), (2L), (3L) AS t(k)")
    stg = spark.sql("SELECT k, a, TIMESTAMP_NTZ '2024-01-02' AS change_ts FROM VALUES (1L, 'x'), (2L, 'y'), (4L, 'z') AS t(k, a)")
    ends = lambda df: sorted(tuple(r) for r in df.selectExpr("k", "CAST(effective_to AS STRING)").collect())
    assert ends(scd2.new_keys(dim, stg, ["k"], ["a"], end=end)) == [(4, end)]
    assert [r.k for r in scd2.changes(dim, stg, ["k"], ["a"], end=end).collect()] == [2]
    assert ends(scd2.close_changed(dim, stg, ["k"], ["a"], end=end)) == [(2, "2024-01-01 23:59:45")]
    assert ends(scd2.reopen_changed(dim, stg, ["k"], ["a"], end=end)) == [(2, end)]
    gone = scd2.tombstones(dim, stg.select("k"), ["k"], "2024-01-03 00:00:00", end=end)
    assert ends(gone) == [(3, "2024-01-02 23:59:45"), (3, end)]


def test_surrogate_ids_run_no_job_before_they_are_used(spark):
    """Two batches; the plan is built without a job, and numbering again gives the same ids."""
    dim = spark.createDataFrame([(1, "x", 1.0, T0, OPEN, False, 10)], DIM + ", sk long")
    keys = [(k, "q", 1.0, T1) for k in range(1000, 0, -3)]
    spark.sparkContext.setJobGroup("surrogate-plan", "")
    out = scd2.scd2_merge(dim, spark.createDataFrame(keys, STG), ["k"], ["a", "b"], surrogate="sk")
    planned = list(spark.sparkContext.statusTracker().getJobIdsForGroup("surrogate-plan"))
    spark.sparkContext.setJobGroup("surrogate-run", "")
    assert planned == []
    new = sorted({(r.k, r.sk) for r in out.collect() if r.k != 1})
    assert new == [(k, 11 + i) for i, k in enumerate(sorted(k for k, *_ in keys if k != 1))]
    assert sorted({(r.k, r.sk) for r in out.repartition(3).collect() if r.k != 1}) == new
    again = scd2.scd2_merge(out, spark.createDataFrame([(2, "z", 2.0, T1), (5000, "z", 2.0, T1)], STG), ["k"], ["a", "b"], surrogate="sk")
    top = max(sk for _, sk in new)
    assert {r.k: r.sk for r in again.collect() if r.k in (2, 5000)} == {2: top + 1, 5000: top + 2}


def test_surrogate_ids_of_no_keys(spark):
    none = spark.createDataFrame([], "a string, b int")
    assert scd2.assign_surrogate_keys(none, ["a", "b"], "id").collect() == []
    some = spark.createDataFrame([("x", 2), ("x", 1), (None, 3)], "a string, b int")
    got = scd2.assign_surrogate_keys(some, ["a", "b"], "id", base=none.agg({"b": "max"})).collect()
    assert {(r.a, r.b): r.id for r in got} == {(None, 3): 1, ("x", 1): 2, ("x", 2): 3}
