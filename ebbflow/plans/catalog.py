"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query builds its inputs from the shared test tables with
:mod:`ebbflow.plans.fixtures` and runs one operator or mart of the library.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions.expr import open_end, strip_blanks, ts_literal
from ebbflow.operators import facts, scd1, scd2, watermark
from ebbflow.operators.overtime import first_over_limit
from ebbflow.plans import bank, speeding, taxi
from ebbflow.plans import fixtures as fx
from ebbflow.session import ensure_utc, scratch_path
from ebbflow.sinks import tables
from ebbflow.sources import files as srcf
from ebbflow.sources import incremental as inc
from ebbflow.sources import paging
from ebbflow.sources.rejects import PAYMENT_FIELDS, parse_lines
from ebbflow.streaming import dimension, jobs, rides

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REPORT_DT = "2024-01-01"
DOC_PAGE = 10_000


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


# ------------------------------------------------------------------ bank
def _star(spark, d):
    return bank.client_card_star(fx.accounts(spark, d), fx.clients(spark, d), fx.cards(spark, d))


@register("fraud_passport")
def q_fraud_passport(spark, d):
    return bank.fraud_passport(fx.transactions(spark, d), _star(spark, d), fx.blacklist(spark, d), REPORT_DT)


@register("fraud_contract")
def q_fraud_contract(spark, d):
    return bank.fraud_contract(fx.transactions(spark, d), _star(spark, d), REPORT_DT)


@register("fraud_two_cities")
def q_fraud_two_cities(spark, d):
    return bank.fraud_two_cities(fx.transactions(spark, d), _star(spark, d), fx.terminals(spark, d), REPORT_DT)


@register("fraud_amount_guessing")
def q_fraud_amount_guessing(spark, d):
    return bank.fraud_amount_guessing(fx.transactions_with_chains(spark, d), _star(spark, d), REPORT_DT)


@register("fraud_mart")
def q_fraud_mart(spark, d):
    return bank.fraud_mart(fx.transactions_with_chains(spark, d), _star(spark, d), fx.blacklist(spark, d),
                           fx.terminals(spark, d), REPORT_DT)


@register("client_card_star")
def q_client_card_star(spark, d):
    return _star(spark, d)


@register("full_name")
def q_full_name(spark, d):
    return fx.clients(spark, d).select("client_id", fx.full_name_col().alias("fio"))


@register("left_lookup")
def q_left_lookup(spark, d):
    bl = fx.blacklist(spark, d)
    return (fx.transactions(spark, d).join(_star(spark, d), "card_num")
            .join(bl, "passport_num", "left").select("trans_id", "passport_num", "entry_dt"))


@register("lead_default")
def q_lead_default(spark, d):
    return bank.lead_default(fx.transactions(spark, d), _star(spark, d), fx.terminals(spark, d))


@register("lead_chain")
def q_lead_chain(spark, d):
    return bank.lead_chain(fx.transactions(spark, d), _star(spark, d))


# ------------------------------------------------------------------ SCD2

SCD_KEYS = ["c_custkey"]
SCD_TRACKED = ["c_acctbal", "c_mktsegment"]
SCD_STAGED = "c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING, change_ts TIMESTAMP_NTZ"


def _scd_inputs(spark, d):
    return fx.scd2_dim(spark, d), fx.scd2_stg(spark, d), fx.scd2_live_keys(spark, d)


@register("key_snapshot")
def q_key_snapshot(spark, d):
    """S3: full list of live source keys (key-only scan)."""
    return fx.scd2_live_keys(spark, d).distinct()


@register("semi_join_keys")
def q_semi_join_keys(spark, d):
    dim, stg, _ = _scd_inputs(spark, d)
    return dim.join(stg.select(*SCD_KEYS), SCD_KEYS, "left_semi")


@register("scd2_new_keys")
def q_scd2_new_keys(spark, d):
    dim, stg, _ = _scd_inputs(spark, d)
    return scd2.new_keys(dim, stg, SCD_KEYS, SCD_TRACKED)


@register("scd2_changes")
def q_scd2_changes(spark, d):
    dim, stg, _ = _scd_inputs(spark, d)
    return scd2.changes(dim, stg, SCD_KEYS, SCD_TRACKED)


@register("scd2_close")
def q_scd2_close(spark, d):
    dim, stg, _ = _scd_inputs(spark, d)
    return scd2.close_changed(dim, stg, SCD_KEYS, SCD_TRACKED)


@register("scd2_reopen")
def q_scd2_reopen(spark, d):
    dim, stg, _ = _scd_inputs(spark, d)
    return scd2.reopen_changed(dim, stg, SCD_KEYS, SCD_TRACKED)


@register("scd2_tombstone")
def q_scd2_tombstone(spark, d):
    dim, _, live = _scd_inputs(spark, d)
    return scd2.tombstones(dim, live, SCD_KEYS, fx.BATCH_TS)


def _merged(spark, d, surrogate=None):
    dim, stg, live = _scd_inputs(spark, d)
    if surrogate:
        dim = dim.withColumn(surrogate, (F.col("c_custkey") + 1).cast("long"))
    return scd2.scd2_merge(dim, stg, SCD_KEYS, SCD_TRACKED, live_keys=live, batch_ts=fx.BATCH_TS,
                           surrogate=surrogate)


@register("scd2_merge")
def q_scd2_merge(spark, d):
    return _merged(spark, d)


@register("scd2_current")
def q_scd2_current(spark, d):
    return scd2.current(_merged(spark, d))


@register("surrogate_key")
def q_surrogate_key(spark, d):
    return _merged(spark, d, surrogate="sk").select("c_custkey", "sk", "effective_from", "effective_to", "is_deleted")


@register("scd2_from_events")
def q_scd2_from_events(spark, d):
    o = fx.table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return scd2.history_from_events(o, ["o_custkey"], ["o_orderpriority"], "o_orderdate", "o_orderkey")


# ------------------------------------------------------------------ taxi


@register("ride_pivot")
def q_ride_pivot(spark, d):
    return taxi.ride_pivot(fx.rides(spark, d), fx.movement(spark, d))


@register("ride_completed")
def q_ride_completed(spark, d):
    return facts.completed(taxi.ride_pivot(fx.rides(spark, d), fx.movement(spark, d)), "ride_end_dt")


def _waybills(spark, d):
    return fx.waybills(spark, d, fx.scalar_count(spark, d, "supplier"))


@register("driver_assignment")
def q_driver_assignment(spark, d):
    return taxi.driver_assignment(fx.ride_arrivals(spark, d), _waybills(spark, d))


@register("top1_per_key")
def q_top1_per_key(spark, d):
    """Matched (ride, waybill) pairs ranked per ride, keep the first.  The
    pairs come from the (car, day) join of F6, so a hot car is spread over
    its days; the rank is a WindowGroupLimit per ride.  The exploded waybills
    are many times their estimated size, so they are never broadcast."""
    a, w = fx.ride_arrivals(spark, d), _waybills(spark, d)
    wd = w.select("car_plate_num", "work_start_dt", "work_end_dt", "waybill_num", "driver_pers_num",
                  F.explode(F.sequence(F.to_date("work_start_dt"), F.to_date("work_end_dt"))).alias("_day"))
    pairs = a.withColumn("_day", F.to_date("ride_arrival_dt")).join(wd.hint("merge"), ["car_plate_num", "_day"]).filter(
        F.col("ride_arrival_dt").between(F.col("work_start_dt"), F.col("work_end_dt")))
    pairs = pairs.select("ride_id", "ride_line", "car_plate_num", "ride_arrival_dt", "work_start_dt",
                         "waybill_num", "driver_pers_num")
    top = facts.top1_by_rank(pairs, ["ride_id", "ride_line", "car_plate_num", "ride_arrival_dt"],
                             ["work_start_dt", "waybill_num"])
    return top.drop("work_start_dt")


def _waybill_fragments(spark, d):
    w = _waybills(spark, d)
    null_ts = F.lit(None).cast("timestamp_ntz")
    parts = F.array(
        F.struct(F.col("driver_license").alias("driver_license"), F.col("car_plate_num").alias("car_plate_num"),
                 null_ts.alias("work_start_dt"), null_ts.alias("work_end_dt"), F.col("issue_dt").alias("issue_dt")),
        F.struct(F.lit(None).cast("string").alias("driver_license"), F.lit(None).cast("long").alias("car_plate_num"),
                 F.col("work_start_dt").alias("work_start_dt"), null_ts.alias("work_end_dt"), null_ts.alias("issue_dt")),
        F.struct(F.lit(None).cast("string").alias("driver_license"), F.lit(None).cast("long").alias("car_plate_num"),
                 null_ts.alias("work_start_dt"), F.col("work_end_dt").alias("work_end_dt"), null_ts.alias("issue_dt")),
    )
    return w.select("waybill_num", F.inline(parts))


@register("waybill_merge")
def q_waybill_merge(spark, d):
    return taxi.waybill_merge(_waybill_fragments(spark, d), fx.drivers(spark, d))


@register("driver_payout")
def q_driver_payout(spark, d):
    return taxi.driver_payout(fx.fact_rides(spark, d), fx.drivers(spark, d))


@register("driver_violations")
def q_driver_violations(spark, d):
    return taxi.driver_violations(taxi.trips(fx.trip_events(spark, d)))


@register("driver_violations_daily")
def q_driver_violations_daily(spark, d):
    """M6 as a daily run: the day's positions and the state that the runs before it left."""
    e = fx.trip_events(spark, d)
    day = F.lit(fx.SHIFT_REPORT_DT).cast("timestamp_ntz")
    before = e.filter(F.col("ts") < day)
    counts = speeding.last_counts(taxi.driver_violations(taxi.trips(before)))
    today = e.filter((F.col("ts") >= day) & (F.col("ts") < day + F.expr("INTERVAL 1 DAY")))
    return speeding.speeding_day(today, speeding.last_positions(before), counts).violations


@register("partition_count")
def q_partition_count(spark, d):
    v = taxi.driver_violations(taxi.trips(fx.trip_events(spark, d)))
    return taxi.partition_count(v.select("personnel_num", "ride"), "personnel_num", "total_violations")


@register("first_value_anchor")
def q_first_value_anchor(spark, d):
    return taxi.first_value_anchor(fx.shifts(spark, d)).select(
        "waybill_id", "driver_pers_num", "work_start_dt", "anchor_dt")


@register("driver_overtime")
def q_driver_overtime(spark, d):
    return taxi.driver_overtime(fx.shifts(spark, d), fx.SHIFT_REPORT_DT)


@register("driver_overtime_rolling")
def q_driver_overtime_rolling(spark, d):
    return taxi.driver_overtime_rolling(fx.shifts(spark, d))


@register("driver_overtime_waybill")
def q_driver_overtime_waybill(spark, d):
    """M7 by the rule: of each 24 h period over 8 h, the waybill that passes the limit, dated by its own start."""
    return first_over_limit(fx.shifts(spark, d)).select(
        F.col("driver").alias("personnel_num"), F.col("waybill").alias("waybill_id"), F.col("period_start").alias("start_work_dt"),
        (F.col("worked_us").cast("double") / 1e6).alias("working_time_sec"), F.to_date("waybill_start").alias("report_dt"))


@register("having_filter")
def q_having_filter(spark, d):
    return taxi.shift_hours_having(fx.shifts(spark, d))


def _payments(spark, d):
    return fx.payments(spark, d, fx.scalar_count(spark, d, "customer"))


@register("conditional_aggregates")
def q_conditional_aggregates(spark, d):
    return taxi.ride_aggregates(fx.fact_rides(spark, d))


@register("sum_by_key")
def q_sum_by_key(spark, d):
    return taxi.payments_by_card(_payments(spark, d))


@register("client_metrics")
def q_client_metrics(spark, d):
    return taxi.client_metrics(fx.taxi_clients(spark, d), fx.fact_rides(spark, d), _payments(spark, d))


#: Report runs of the metrics history; the last one is after all rides and payments.
HIST_RUNS = ["1997-01-01 00:00:00", "1999-01-01 00:00:00", "2010-01-01 00:00:00"]


def _metrics_as_of(spark, d, ts):
    cut = F.lit(ts).cast("timestamp_ntz")
    return taxi.client_metrics(
        fx.taxi_clients(spark, d),
        fx.fact_rides(spark, d).filter(F.col("ride_arrival_dt") < cut),
        _payments(spark, d).filter(F.col("transaction_dt") < cut),
    )


@register("client_metrics_hist")
def q_client_metrics_hist(spark, d):
    """M8h: SCD2 history over the client metrics, three report runs.  The first
    writes the history table (version 1 + manifest); each later run reads it back,
    merges the new metrics and commits, as the scheduled job would."""

    root, (first, *later) = scratch_path(spark, "client_metrics_hist"), HIST_RUNS
    phones = fx.taxi_clients(spark, d).select("phone_num").distinct()
    hist = _metrics_as_of(spark, d, first).join(scd2.assign_surrogate_keys(phones, ["phone_num"], "client_id"), "phone_num").select(
        "phone_num", *taxi.METRIC_COLS, ts_literal(first).alias("effective_from"),
        open_end().alias("effective_to"), F.lit(False).alias("is_deleted"), "client_id",
    )
    for version, run_ts in enumerate([first, *later], 1):
        if version > 1:
            stored = tables.read_table(spark, root, "client_metrics_hist")
            staged = _metrics_as_of(spark, d, run_ts).withColumn("change_ts", ts_literal(run_ts))
            hist = scd2.scd2_merge(stored, staged, ["phone_num"], taxi.METRIC_COLS, live_keys=phones, batch_ts=run_ts,
                                   surrogate="client_id")
        if version < len(HIST_RUNS):
            tables.write_version(hist, root, "client_metrics_hist", version)
            tables.commit(spark, root, version, {"client_metrics_hist": version})
    return hist.select("client_id", "phone_num", *taxi.METRIC_COLS,
                       F.col("effective_from").alias("start_dt"), F.col("effective_to").alias("end_dt"),
                       F.col("is_deleted").alias("deleted_flag"))


# ------------------------------------------------------------------ sources, control state, upserts

ORDERS_WM = "1997-06-30 00:00:00"


@register("incr_scan_coalesced")
def q_incr_scan_coalesced(spark, d):
    return inc.incremental_scan_coalesced(fx.orders_change_log(spark, d), "update_dt", "create_dt", ORDERS_WM)


@register("incr_scan_column")
def q_incr_scan_column(spark, d):
    return inc.incremental_scan(fx.movement(spark, d), "dt", fx.RIDE_BATCH_BOUNDARY)


@register("watermark_advance")
def q_watermark_advance(spark, d):
    """Four sources, one of them with an empty batch."""
    ctl = watermark.control_table(spark, {
        "orders": ORDERS_WM, "movement": fx.RIDE_BATCH_BOUNDARY,
        "documents": fx.DOC_PULL_WM, "documents_future": "2030-01-01 00:00:00",
    })
    o = inc.incremental_scan_coalesced(fx.orders_change_log(spark, d), "update_dt", "create_dt", ORDERS_WM)
    m = inc.incremental_scan(fx.movement(spark, d), "dt", fx.RIDE_BATCH_BOUNDARY)
    doc = fx.documents(spark, d)
    marks = (
        o.select(F.lit("orders").alias("source"), F.col("change_dt").alias("ts"))
        .unionByName(m.select(F.lit("movement").alias("source"), F.col("dt").alias("ts")))
        .unionByName(inc.incremental_scan(doc, "update_ts", fx.DOC_PULL_WM)
                     .select(F.lit("documents").alias("source"), F.col("update_ts").alias("ts")))
        .unionByName(inc.incremental_scan(doc, "update_ts", "2030-01-01 00:00:00")
                     .select(F.lit("documents_future").alias("source"), F.col("update_ts").alias("ts")))
    )
    return watermark.advance_watermarks(ctl, marks)


@register("settings_checkpoint")
def q_settings_checkpoint(spark, d):
    """Read checkpoints with defaults, load, write the new JSON settings."""
    settings = spark.createDataFrame(
        [("users_stg", '{"last_loaded_ts": "2024-01-15 00:00:00"}')], "workflow_key string, workflow_settings string")
    doc = fx.documents(spark, d)
    last_ts = watermark.read_setting(settings, "users_stg", "last_loaded_ts", "2022-01-01 00:00:00", "timestamp_ntz")
    last_id = watermark.read_setting(settings, "users_mart", "last_loaded_id", -1, "long")
    by_ts = inc.incremental_scan(doc, "update_ts", last_ts.isoformat(sep=" ")).agg(F.max("update_ts").alias("ts"))
    by_id = doc.filter(F.col("id") > F.lit(last_id)).agg(F.max("id").alias("id"))
    fmt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return by_ts.select(*watermark.settings_row(F.lit("users_stg"), last_loaded_ts=fmt)).unionByName(
        by_id.select(*watermark.settings_row(F.lit("users_mart"), last_loaded_id=F.col("id"))))


@register("scd1_upsert")
def q_scd1_upsert(spark, d):
    doc = fx.documents(spark, d)
    cut = F.lit(fx.DOC_PULL_WM).cast("timestamp_ntz")
    target = scd1.latest_per_key(doc.filter(F.col("update_ts") < cut), ["object_id"], ["update_ts", "id"])
    batch = doc.filter(F.col("update_ts") >= cut)
    return scd1.scd1_upsert(target, batch, ["object_id"], ["update_ts", "id"])


@register("doc_batch_pull")
def q_doc_batch_pull(spark, d):
    """Page after page behind the watermark, each committed with its cursor."""
    doc = fx.documents(spark, d)
    root = scratch_path(spark, "doc_batch_pull")
    paging.drain(doc, root, "documents", "update_ts", "id", paging.Cursor(fx.DOC_PULL_WM), DOC_PAGE)
    return paging.pulled(spark, root, "documents", fx.DOCUMENT_SCHEMA)


@register("json_extract_updates")
def q_json_extract_updates(spark, d):
    """S12 with D30: after all documents were taken, every tenth one changes; its id is known, its time is new."""
    doc = fx.documents(spark, d)
    taken = paging.last_position(doc, "update_ts", "id")
    return paging.changed_documents(fx.updated_documents(spark, d), "update_ts", "id", taken, "object_value",
                                    {"user_name": "$.k"}, ["id"])


@register("json_extract_batch")
def q_json_extract_batch(spark, d):
    return inc.json_extract_batch(fx.documents(spark, d), "id", -1, "object_value", {"user_name": "$.k"},
                                  key_col="object_id")


@register("fact_append")
def q_fact_append(spark, d):
    """the operations appended in two batches, the second one twice (a replay overwrites its own directory)."""
    t = fx.transactions(spark, d)
    path = scratch_path(spark, "fact_append")
    for batch, even in ((0, True), (1, False), (1, False)):
        tables.append_batch(t.filter((F.col("trans_id") % 2 == 0) == even), path, batch)
    return tables.read_appended(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema))


@register("fact_dedup_append")
def q_fact_dedup_append(spark, d):
    p = _payments(spark, d).select("card_num", "transaction_amt", "transaction_dt")
    key = ["card_num", "transaction_dt", "transaction_amt"]
    fact = p.filter(F.col("transaction_dt") < F.lit("1998-01-01").cast("timestamp_ntz")).dropDuplicates(key)
    batch = p.filter(F.col("transaction_dt") >= F.lit("1997-06-01").cast("timestamp_ntz"))
    return facts.dedup_append(batch, fact, key)


@register("distinct_rows")
def q_distinct_rows(spark, d):
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@register("normalized_key_join")
def q_normalized_key_join(spark, d):

    o = fx.table(spark, d, "orders").select("o_orderkey", fx.grouped_card_of(F.col("o_custkey")).alias("card_txt"))
    c = fx.table(spark, d, "customer").select("c_custkey", fx.card_of(F.col("c_custkey")).alias("card_num"))
    return o.join(c, strip_blanks("card_txt") == c["card_num"]).select("o_orderkey", "c_custkey")


@register("csv_decimal_comma")
def q_csv_decimal_comma(spark, d):
    o = fx.table(spark, d, "orders")
    text = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                       F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")))
    p = o.select(srcf.parse_delimited(text, "trans_id BIGINT, trans_date STRING, amount STRING", ";").alias("p"))
    return p.select(F.col("p.trans_id").alias("trans_id"), F.to_date("p.trans_date").alias("trans_date"),
                    srcf.decimal_comma("p.amount", 12, 2).alias("amount"))


@register("tsv_payments")
def q_tsv_payments(spark, d):
    p = _payments(spark, d)
    text = F.concat_ws("\t", F.date_format("transaction_dt", srcf.PAYMENT_TS_FORMAT), F.col("card_num"),
                       F.replace(F.col("transaction_amt").cast("string"), F.lit("."), F.lit(",")))
    return srcf.payments_from_text(p.select(text.alias("value")))


@register("tsv_payment_rejects")
def q_tsv_payment_rejects(spark, d):
    """The lines of a payment feed that cannot be read, with the reason."""
    return parse_lines(fx.payment_lines(spark, d), PAYMENT_FIELDS, "\t").rejected


@register("xml_waybill")
def q_xml_waybill(spark, d):
    w = _waybills(spark, d)
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    xml = F.concat(
        F.lit('<waybill number="'), F.col("waybill_num"), F.lit('" issuedt="'), F.date_format("issue_dt", iso),
        F.lit('"><car>'), F.col("car_plate_num").cast("string"), F.lit("</car><driver><license>"),
        F.col("driver_license"), F.lit("</license></driver><period><start>"), F.date_format("work_start_dt", iso),
        F.lit("</start><stop>"), F.date_format("work_end_dt", iso), F.lit("</stop></period></waybill>"),
    )
    # the fixture's plate numbers are numeric stand-ins; the parser keeps text
    parsed = srcf.parse_waybill_xml(w.select(xml.alias("xml")), "xml")
    return parsed.withColumn("car_plate_num", F.col("car_plate_num").cast("long"))


@register("file_date_from_name")
def q_file_date_from_name(spark, d):
    o = fx.table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("transactions_"), F.date_format("o_orderdate", "ddMMyyyy"), F.lit(".txt")).alias("file_name"))
    return o.withColumn("file_dt", srcf.file_date("file_name", "ddMMyyyy"))


@register("pending_files")
def q_pending_files(spark, d):
    days = fx.table(spark, d, "orders").select(F.date_format("o_orderdate", "ddMMyyyy").alias("dt")).distinct()
    names = days.select(F.explode(F.array(*[
        F.concat(F.lit(p), F.col("dt"), F.lit(ext)) for p, ext in
        (("transactions_", ".txt"), ("passport_blacklist_", ".xlsx"), ("terminals_", ".xlsx"))
    ])).alias("file_name"))
    return srcf.pending_files(names, "transactions_", "2001-01-01")


@register("file_slice_dim")
def q_file_slice_dim(spark, d):
    s = fx.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("terminal_id"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("POS")).otherwise(F.lit("ATM")).alias("terminal_type"),
        F.concat(F.lit("City"), F.col("s_nationkey").cast("string")).alias("terminal_city"),
        F.col("s_name").alias("terminal_address"),
        F.lit("terminals_01032024.xlsx").alias("file_name"),
    )
    return srcf.with_file_date(s, "file_name", "ddMMyyyy").drop("file_name")


@register("cumulative_file_delta")
def q_cumulative_file_delta(spark, d):
    bl = fx.blacklist(spark, d)
    loaded = bl.filter(F.col("entry_dt") <= F.lit("2024-01-15").cast("date"))
    return srcf.cumulative_delta(bl, loaded, "entry_dt", "2024-01-15", ["passport_num", "entry_dt"])


# ------------------------------------------------------------------ streaming


def _write_in_order(parts: list[DataFrame], path: str) -> int:
    """Write feed files one part after the other (file sources consume files
    in modification-time order), each part by all its tasks; returns the most
    files of a part, so that a micro-batch of so many takes a part."""
    files = 0
    for i, p in enumerate(parts):
        if i:
            time.sleep(1.1)
        p.write.parquet(f"{path}/part{i:03d}")
        files = max(files, len(p.sparkSession.read.parquet(f"{path}/part{i:03d}").inputFiles()))
    return files


@register("stream_file_ingest")
def q_stream_file_ingest(spark, d):
    base = scratch_path(spark, "stream_file_ingest")
    t = fx.transactions(spark, d)
    text = t.select(
        "trans_id", F.date_format("trans_date", jobs.TRANS_TS_FORMAT).alias("trans_date"),
        F.replace(F.col("amt").cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(",")).alias("amount"),
        "card_num", "oper_type", "oper_result", "terminal", F.to_date("trans_date").alias("day"),
    )
    (text.repartition("day").write.partitionBy("day").option("header", True).option("sep", ";")
     .csv(f"{base}/src"))
    out = jobs.file_ingest(spark, f"{base}/src/*/*.csv", f"{base}/fact", f"{base}/ckpt", max_files=10)
    return out.withColumn("trans_id", F.col("trans_id").cast("bigint"))


@register("stream_scd1_upsert")
def q_stream_scd1_upsert(spark, d):
    base = scratch_path(spark, "stream_scd1_upsert")
    doc = fx.documents(spark, d).withColumn("day", F.to_date("update_ts"))
    (doc.repartition("day").write.partitionBy("day").option("timestampNTZFormat", jobs.JSON_TS_FORMAT)
     .json(f"{base}/src"))
    return jobs.scd1_upsert_stream(spark, f"{base}/src/*/*.json", f"{base}/tables", f"{base}/ckpt", max_files=10)


@register("stream_payment_dedup")
def q_stream_payment_dedup(spark, d):
    base = scratch_path(spark, "stream_payment_dedup")
    p = _payments(spark, d).select("card_num", "transaction_amt", "transaction_dt").withColumn(
        "yr", F.year("transaction_dt"))
    p = p.unionByName(p.filter(F.month("transaction_dt") == 3))  # a feed that repeats the payments of each March
    p.repartition("yr").write.partitionBy("yr").parquet(f"{base}/src")
    return jobs.payment_dedup(spark, f"{base}/src/*/*.parquet", f"{base}/fact", f"{base}/ckpt", max_files=4)


@register("stream_ride_assembly")
def q_stream_ride_assembly(spark, d):
    """T4: the events arrive in three drops, dealt by hash: any order of READY, BEGIN and END."""
    base = scratch_path(spark, "stream_ride_assembly")
    m = fx.movement(spark, d)
    drop = F.pmod(F.xxhash64("ride", "event", "dt"), F.lit(3))
    files = _write_in_order([m.filter(drop == i) for i in range(3)], f"{base}/src")
    out = rides.ride_assembly(spark, f"{base}/src/*/*.parquet", f"{base}/state", f"{base}/ckpt", max_files=files)
    return out.withColumnRenamed("ride", "ride_id")


@register("stream_scd2")
def q_stream_scd2(spark, d):
    """T5: the staged customer changes arrive in two drops (even/odd keys)."""
    base = scratch_path(spark, "stream_scd2")
    dim, stg, _ = _scd_inputs(spark, d)
    kept = dimension.Dimension(spark, f"{base}/tables", "dim", SCD_STAGED, SCD_KEYS, SCD_TRACKED)
    kept.load(dim)
    files = _write_in_order([stg.filter(F.col("c_custkey") % 2 == r) for r in (0, 1)], f"{base}/src")
    return dimension.scd2_stream(spark, f"{base}/src/*/*.parquet", kept, f"{base}/ckpt", SCD_STAGED, max_files=files)


@register("stream_scd2_deletes")
def q_stream_scd2_deletes(spark, d):
    """T5 from an empty start: the first load and the changes arrive as files, then a key snapshot is announced."""
    base = scratch_path(spark, "stream_scd2_deletes")
    dim, stg, live = _scd_inputs(spark, d)
    kept = dimension.Dimension(spark, f"{base}/tables", "dim", SCD_STAGED, SCD_KEYS, SCD_TRACKED)
    first = dim.select(*SCD_KEYS, *SCD_TRACKED, F.col("effective_from").alias("change_ts"))
    files = _write_in_order([first, stg], f"{base}/src")
    feeds = (f"{base}/src/*/*.parquet", kept, f"{base}/ckpt", SCD_STAGED, f"{base}/said/*/*.json")
    dimension.scd2_stream(spark, *feeds, max_files=files)
    live.write.parquet(f"{base}/keys")
    spark.createDataFrame([(f"{base}/keys", fx.BATCH_TS)], "snapshot_path string, snapshot_ts string").coalesce(1) \
        .write.json(f"{base}/said/part000")
    return dimension.scd2_stream(spark, *feeds, max_files=files)
