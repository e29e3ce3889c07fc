"""The bank's daily run: sources, dimensions, facts and the fraud report of a day, published by one commit.

A run reads what changed since the watermarks of the last committed run, merges the dimensions (with deletes from the
key snapshots), appends the day's operations and passport entries, writes the day's fraud report and commits: table
versions and watermarks become visible together.  A run that failed before its commit is repeated under the same number and
overwrites what it had written; a committed run is not repeated.

Tables below ``root``: the dimensions ``clients accounts cards terminals`` (:class:`ebbflow.streaming.dimension.Dimension`), the
facts ``transactions`` and ``passports`` (a directory for each run), ``transactions_rejects``, and the report
``rep_fraud`` (a directory for each report date, which a repeated run replaces).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators import facts
from ebbflow.plans import bank
from ebbflow.sinks import tables
from ebbflow.sources import incremental
from ebbflow.sources.rejects import TRANSACTION_FIELDS, parse_lines
from ebbflow.streaming.dimension import Dimension

#: A watermark before any change.
NEVER = "1900-01-01 00:00:00"
TRANS_SCHEMA = ("trans_id STRING, trans_date TIMESTAMP_NTZ, amt DECIMAL(10,2), card_num STRING, oper_type STRING, "
                "oper_result STRING, terminal STRING")
PASSPORT_SCHEMA = "entry_dt DATE, passport_num STRING"
REPORT_SCHEMA = "event_dt TIMESTAMP_NTZ, passport STRING, fio STRING, phone STRING, event_type INT, report_dt DATE"


@dataclass(frozen=True)
class Source:
    """A source table of a dimension: all its rows, with ``create_dt`` and ``update_dt`` (null: never updated)."""

    rows: DataFrame
    keys: list[str]
    tracked: list[str]
    #: Rows that are there but out of use: their keys count as deleted.
    retired: Column | None = None


@dataclass(frozen=True)
class BankDay:
    """What a daily run is given."""

    report_dt: str
    #: Time of the run, that of logical deletes.
    run_ts: str
    #: Lines (``value``) of the day's operations, ``;`` between the fields.
    operations: DataFrame
    #: The cumulative file of blacklisted passports: ``entry_dt, passport_num``.
    passports: DataFrame
    sources: dict[str, Source] = field(default_factory=dict)


def stage_dimensions(spark: SparkSession, root: str, version: int, sources: dict[str, Source], marks: dict[str, str],
                     run_ts: str) -> tuple[dict[str, int], dict[str, str], dict[str, Dimension]]:
    """Merge what changed in the sources since their watermarks; table versions and watermarks to commit, and the dimensions."""
    staged, new_marks, dims = {}, {}, {}
    for name, s in sources.items():
        changed = incremental.incremental_scan_coalesced(s.rows, "update_dt", "create_dt", marks.get(name, NEVER))
        changes = changed.select(*s.keys, *s.tracked, F.col("change_dt").cast("timestamp_ntz").alias("change_ts"))
        dim = dims[name] = Dimension(spark, root, name, changes.schema, s.keys, s.tracked)
        dim.stage(changes, version, incremental.key_snapshot(s.rows, s.keys, s.retired), run_ts)
        staged |= dim.staged
        last = changes.agg(F.max("change_ts")).first()[0]  # an empty batch keeps the mark
        new_marks[name] = marks.get(name, NEVER) if last is None else max(marks.get(name, NEVER), last.isoformat(sep=" "))
    return staged, new_marks, dims


def run(spark: SparkSession, root: str, version: int, day: BankDay) -> bool:
    """Run ``version`` for ``day``; False if that run is committed already."""
    if tables.has_manifest(spark, root, version):
        return False
    m = tables.latest_manifest(spark, root, before=version)
    marks = dict(m["watermarks"] or {}) if m is not None else {}
    staged, new_marks, dims = stage_dimensions(spark, root, version, day.sources, marks, day.run_ts)

    feed = parse_lines(day.operations, TRANSACTION_FIELDS, ";")
    loaded = operations(spark, root, version)
    tables.append_batch(facts.dedup_append(feed.good, loaded, ["trans_id"]), f"{root}/transactions", version)
    tables.append_batch(feed.rejected.select("line", "reason"), f"{root}/transactions_rejects", version)
    known = tables.read_appended(spark, f"{root}/passports", PASSPORT_SCHEMA, before_batch=version)
    tables.append_batch(facts.dedup_append(day.passports, known, ["passport_num", "entry_dt"]), f"{root}/passports", version)

    star = bank.client_card_star(*(dims[n].read() for n in ("accounts", "clients", "cards")))
    entries = tables.read_appended(spark, f"{root}/passports", PASSPORT_SCHEMA, before_batch=version + 1)
    report = bank.fraud_mart(operations(spark, root, version + 1), star, entries, dims["terminals"].read(), day.report_dt)
    date = F.lit(day.report_dt).cast("date")
    report = report.filter((F.col("event_dt") < F.date_add(date, 1).cast("timestamp_ntz")))
    report.filter(F.col("report_dt") == date).drop("report_dt").write.mode("overwrite") \
        .parquet(f"{root}/rep_fraud/version={version:012d}/report_dt={day.report_dt}")
    tables.commit(spark, root, version, staged | {"transactions": version, "passports": version, f"rep_fraud.{day.report_dt}": version}, new_marks)
    return True


def operations(spark: SparkSession, root: str, before: int) -> DataFrame:
    """The operations of the runs before ``before``."""
    return tables.read_appended(spark, f"{root}/transactions", TRANS_SCHEMA, before_batch=before)


def fraud_report(spark: SparkSession, root: str) -> DataFrame:
    """The reports of all committed report dates, each from the run that made it last."""
    m = tables.latest_manifest(spark, root)
    keep = F.lit(False)
    for name, v in sorted((m["tables"] or {}).items()) if m is not None else []:
        if name.startswith("rep_fraud."):
            keep = keep | ((F.col("version") == v) & (F.col("report_dt") == F.lit(name.split(".", 1)[1]).cast("date")))
    try:
        stored = spark.read.schema(f"{REPORT_SCHEMA}, version BIGINT").parquet(f"{root}/rep_fraud")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], REPORT_SCHEMA)
    return stored.filter(keep).select("event_dt", "passport", "fio", "phone", "event_type", "report_dt")
